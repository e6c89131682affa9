"""Parent-child links to full hierarchies: roots, depths, paths, descendants and cycles, also where a node has several parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.session import Scratch

#: Levels that one pass over the tree goes down.
STRIDE = 8


def links(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct links without null ends."""
    return df.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(F.col(child).alias("child"), F.col(parent).alias("parent")).distinct()


# --- ancestor pairs -----------------------------------------------------------------------------------------------------


def _closure(edges: DataFrame, stride: int | None, scratch: Scratch, paths: bool, merges: bool = True) -> DataFrame:
    """(anc, desc, dist[, via]): every pair at most ``stride`` levels apart, or every pair, with its shortest distance.

    ``stride`` is a power of two. A shortest way longer than ``reach`` has a node at exactly that distance, so pairs double
    their reach with each join. ``via`` is the smallest of the shortest ways; without ``merges`` there is one way only and
    nothing to choose from. The links above which a root stands must hold no cycle.
    """
    pairs = edges.select(F.col("parent").alias("anc"), F.col("child").alias("desc"), F.lit(1).alias("dist"), *([F.array("child").alias("via")] if paths else []))
    reach = 1
    while stride is None or reach < stride:
        upper = pairs.where(F.col("dist") == reach)
        lower = pairs.select(F.col("anc").alias("_mid"), F.col("desc").alias("_low"), F.col("dist").alias("_d"), *([F.col("via").alias("_via")] if paths else []))
        longer = upper.join(lower, F.col("desc") == F.col("_mid")).select(
            "anc", F.col("_low").alias("desc"), (F.col("dist") + F.col("_d")).alias("dist"), *([F.concat("via", "_via").alias("via")] if paths else [])
        )
        pairs = pairs.unionByName(longer)
        if merges:
            both = pairs.groupBy("anc", "desc")
            pairs = both.agg(F.min(F.struct("dist", "via")).alias("m")).select("anc", "desc", "m.dist", "m.via") if paths else both.agg(F.min("dist").alias("dist"))
        reach *= 2
        pairs, far = scratch.counted("closure", pairs, F.col("dist") >= reach)
        if not far:
            break
    return pairs


def within(edges: DataFrame, stride: int, scratch: Scratch) -> DataFrame:
    """(anc, desc, dist): every pair at most ``stride`` levels apart (a power of two), with its shortest distance."""
    return _closure(edges, stride, scratch, False)


def descendants(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(ancestor, descendant, distance): every pair over links without cycles, through all parents, with the shortest distance."""
    return _closure(edges, None, scratch, False).select(F.col("anc").alias("ancestor"), F.col("desc").alias("descendant"), F.col("dist").alias("distance"))


def _descend(start: DataFrame, closure: DataFrame, stride: int, scratch: Scratch, paths: bool, merges: bool) -> DataFrame:
    """All (node, root, depth[, path]) reached from ``start``, in strides. All levels are parts of one table.

    With ``merges`` a node may be reached several times: the least depth counts, then the smallest root and path, and a
    node of an earlier stride is not reached again.
    """
    name, k = "levels", 0
    frontier, _ = scratch.append(name, k, start)
    while True:
        low = frontier.alias("f").join(closure.alias("c"), F.col("f.node") == F.col("c.anc")).select(
            F.col("c.desc").alias("node"), F.col("f.root").alias("root"), (F.col("f.depth") + F.col("c.dist")).alias("depth"), *([F.concat("f.path", "c.via").alias("path")] if paths else [])
        )
        if merges:
            low = low.groupBy("node").agg(F.min(F.struct("depth", "root", *(["path"] if paths else []))).alias("m")).select("node", "m.root", "m.depth", *(["m.path"] if paths else []))
            low = low.join(scratch.appended(name, start.schema).select("node"), "node", "left_anti")
        k += 1
        low, left = scratch.append(name, k, low, F.col("depth") == k * stride)
        if not left:
            return scratch.appended(name, start.schema)
        frontier = low.where(F.col("depth") == k * stride)


# --- cycles -------------------------------------------------------------------------------------------------------------


class Pointers:
    """Nodes with a single parent and the way up from each to its anchor: a root or a node with several parents.

    Pointers are joined with themselves, so each round doubles their reach. A node that is still under way once the reach
    exceeds all that are is on a cycle of single parents or below one.
    """

    def __init__(self, edges: DataFrame, scratch: Scratch) -> None:
        self.scratch = scratch
        per = edges.groupBy("child").agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
        single = scratch.table("single", per.where("n = 1 and child <> parent").select(F.col("child").alias("node"), F.col("parent").alias("to"), F.col("child").alias("low")))
        self.levels: list[DataFrame] = [single]
        inner = single.select(F.col("node").alias("to"))
        done = [single.join(inner, "to", "left_anti").select("node", "to", "low")]
        under_way, left = scratch.counted("under_way", single.join(inner, "to", "left_semi").select("node", "to", "low"))
        reach = 1
        limit = left + 1
        while left and reach < limit:
            settled = done[0]
            for d in done[1:]:
                settled = settled.unionByName(d)
            far = lambda df: df.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("low").alias("_low"))
            step = lambda df: under_way.join(far(df), "to").select("node", F.col("_to").alias("to"), F.least("low", "_low").alias("low"))  # noqa: B023, E731
            done.append(scratch.table("settled", step(settled)))
            under_way, left = scratch.counted("under_way", step(under_way))
            self.levels.append(under_way)
            reach *= 2
            limit = min(limit, reach + left)
        self.anchored = done[0]
        for d in done[1:]:
            self.anchored = self.anchored.unionByName(d)
        self.endless, self.any_endless = under_way, left > 0

    def cycle_of(self) -> DataFrame:
        """(node, root): nodes on or below a cycle of single parents, with the smallest id on it."""
        return self.endless.select("node", "to").join(self.endless.select(F.col("node").alias("to"), F.col("low").alias("root")), "to").select("node", "root")

    def on_cycle(self) -> DataFrame:
        """(node, root): nodes on a cycle of single parents. Whoever goes up far enough comes onto the cycle and past all of it."""
        return self.cycle_of().join(self.endless.select(F.col("to").alias("node")).distinct(), "node", "left_semi")

    def above(self, nodes: DataFrame) -> DataFrame:
        """(node, tag): ``nodes`` (node, tag) and all nodes on their ways up to their anchors, these left out."""
        known = self.scratch.table("above", nodes.join(self.levels[0].select("node"), "node", "left_semi").distinct())
        for level in reversed(self.levels):
            more = known.join(level.select("node", "to"), "node").select(F.col("to").alias("node"), "tag").join(self.levels[0].select("node"), "node", "left_semi")
            known = self.scratch.table("above", known.unionByName(more).distinct())
        return known


def _propagate(labels: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest label that reaches each node along (child, parent), downwards, until none changes."""
    best = scratch.table("labels", labels.groupBy("node").agg(F.min("label").alias("label")))
    fresh = best
    while True:
        come = fresh.join(edges.select(F.col("parent").alias("node"), "child"), "node").groupBy(F.col("child").alias("node")).agg(F.min("label").alias("_new"))
        come = come.join(best, "node", "left").where(F.col("label").isNull() | (F.col("_new") < F.col("label"))).select("node", F.col("_new").alias("label"))
        fresh, n = scratch.counted("fresh", come)
        if not n:
            return best
        best = scratch.table("labels", best.unionByName(fresh).groupBy("node").agg(F.min("label").alias("label")))


def strong_parts(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, part): nodes of (child, parent) that lie on a cycle of two or more, with the smallest node of their strongly connected part.

    Nodes without a parent or without a child are cut off until none is left. Then each node takes the smallest one that
    reaches it; those that reach that one back, with the same mark all the way, are its part, and the rest goes round again.
    """
    live, n = scratch.counted("live", edges.where("child <> parent").select("child", "parent").distinct())
    out = live.select(F.col("child").alias("node"), F.col("parent").alias("part")).limit(0)
    while True:
        while n:
            kept = live.join(live.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi").join(live.select(F.col("parent").alias("child")).distinct(), "child", "left_semi")
            before = n
            live, n = scratch.counted("live", kept.select("child", "parent"))
            if n == before:
                break
        if not n:
            return out
        nodes = live.select(F.col("child").alias("node")).union(live.select("parent")).distinct()
        mark = _propagate(nodes.withColumn("label", F.col("node")), live, scratch)
        same = live.join(mark.select(F.col("node").alias("child"), F.col("label").alias("_c")), "child").join(mark.select(F.col("node").alias("parent"), F.col("label").alias("_p")), "parent").where("_c = _p").select("child", "parent")
        same = scratch.table("same", same)
        seeds = mark.where("node = label").select("node", "label")
        back = _propagate(seeds, same.select(F.col("parent").alias("child"), F.col("child").alias("parent")), scratch)
        part = scratch.table("part", back.select("node", F.col("label").alias("part")))
        several = part.groupBy("part").agg(F.count("*").alias("_n")).where("_n > 1").select("part")
        out = scratch.table("parts", out.unionByName(part.join(several, "part", "left_semi").select("node", "part")))
        live = live.join(part.select(F.col("node").alias("child")), "child", "left_anti").join(part.select(F.col("node").alias("parent")), "parent", "left_anti").select("child", "parent")
        live, n = scratch.counted("live", live)


class Cycles:
    """Cycles of the links (child, parent), over all parents of every node.

    Ways through nodes with a single parent are drawn together to one link first, so what is searched link by link is only
    the graph of the nodes with several parents.
    """

    def __init__(self, edges: DataFrame, scratch: Scratch) -> None:
        self.scratch, self.edges = scratch, edges
        self.ways = Pointers(edges, scratch)
        per = edges.groupBy("child").agg(F.count("*").alias("n"), F.max(F.col("child") == F.col("parent")).alias("own"))
        self.merge, n = scratch.counted("merges", per.where("n > 1 or own").select(F.col("child").alias("node")))
        merge, self.any_merge = self.merge, n > 0
        if not self.any_merge:
            return
        into = edges.join(merge.select(F.col("node").alias("child")), "child", "left_semi")
        via = self.ways.anchored.select(F.col("node").alias("parent"), "to", "low")
        drawn = into.join(via, "parent", "left").select("child", F.col("parent").alias("first"), F.coalesce("to", "parent").alias("parent"), F.least(F.coalesce("low", "parent"), F.coalesce("to", "parent")).alias("low"))
        self.drawn = scratch.table("drawn", drawn.join(merge.select(F.col("node").alias("parent")), "parent", "left_semi").select("child", "parent", "first", "low"))
        own = self.drawn.where("child = parent").select(F.col("child").alias("node"), F.col("child").alias("part"))
        parts = strong_parts(self.drawn, scratch)
        self.parts = scratch.table("merge_parts", parts.unionByName(own.join(parts.select("node"), "node", "left_anti").distinct()))
        inner = self.drawn.join(self.parts.select(F.col("node").alias("child"), F.col("part").alias("tag")), "child").join(self.parts.select(F.col("node").alias("parent"), F.col("part").alias("_p")), "parent").where("tag = _p")
        self.inner = scratch.table("inner", inner.select("child", "parent", "first", "low", "tag"))
        self.least = scratch.table("least", self.inner.groupBy(F.col("tag").alias("part")).agg(F.min(F.least("low", "child")).alias("root")))

    def below(self) -> DataFrame:
        """(node, root): every node on or below a cycle; of several cycles at or above it the smallest id counts."""
        bad = self.ways.cycle_of() if self.ways.any_endless else None
        if not self.any_merge:
            return bad if bad is not None else self.ways.endless.select("node", F.col("low").alias("root"))
        labels = self.parts.join(self.least, "part").select("node", F.col("root").alias("label"))
        if bad is not None:
            endless = self.edges.join(bad.select(F.col("node").alias("parent"), F.col("root").alias("label")), "parent").select(F.col("child").alias("node"), "label")
            labels = labels.unionByName(endless.join(self.merge, "node", "left_semi"))
        marked = _propagate(labels, self.drawn.select("child", "parent").distinct(), self.scratch)
        under = self.ways.anchored.join(marked.select(F.col("node").alias("to"), F.col("label").alias("root")), "to").select("node", "root")
        out = marked.select("node", F.col("label").alias("root")).unionByName(under)
        return self.scratch.table("below", out.unionByName(bad) if bad is not None else out)

    def on(self) -> DataFrame:
        """(node, root): every node that lies on a cycle, with the smallest node of all cycles that hang together with it."""
        out = self.ways.on_cycle() if self.ways.any_endless else self.ways.endless.select("node", F.col("low").alias("root"))
        if not self.any_merge:
            return out
        tagged = self.ways.above(self.inner.select(F.col("first").alias("node"), "tag")).unionByName(self.parts.select("node", F.col("part").alias("tag")))
        return out.unionByName(tagged.join(self.least.withColumnRenamed("part", "tag"), "tag").select("node", "root").distinct())


# --- hierarchies --------------------------------------------------------------------------------------------------------


class Tree:
    """The hierarchy of the links (child, parent); every step is written once to ``scratch`` and shared by the results.

    A frontier join from the roots extends depths (and paths) level by level; a closure over ``stride`` levels lets one
    pass take that many levels, so a chain of 1000 links takes 125 passes over shrinking frontiers, not 1000. Nodes that no
    root reaches are on a cycle or below one, and so may be nodes that have further parents; they have depth -1, the smallest
    id of the cycle (of several, the smallest of all) as root and no path. A link to itself is a cycle. All parents count:
    of several ways to a node the shortest gives its one row, then the smallest root and path, while ``descendants`` follows
    every link. Repeated links count once; an empty table gives none.
    """

    def __init__(self, edges: DataFrame, scratch: Scratch, stride: int = STRIDE, paths: bool = False) -> None:
        self.scratch, self.paths = scratch, paths
        self.edges = scratch.table("edges", edges.select("child", "parent").distinct())
        nodes = self.edges.select(F.col("child").alias("node")).union(self.edges.select("parent")).distinct()
        roots = self.edges.select(F.col("parent").alias("node")).distinct().join(self.edges.select(F.col("child").alias("node")), "node", "left_anti")
        merges = not self.edges.groupBy("child").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        self.bad: DataFrame | None = None
        self.good = self.edges.where("child <> parent")
        if merges:
            self._search()
        start = roots.select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), *([F.array("node").alias("path")] if paths else []))
        self.reached = _descend(start, _closure(self.good, stride, scratch, paths, merges), stride, scratch, paths, merges)
        if not merges and not nodes.join(self.reached.select("node"), "node", "left_anti").isEmpty():
            self._search()

    def _search(self) -> None:
        self.bad = Cycles(self.edges, self.scratch).below()
        self.good = self.scratch.table("good", self.edges.join(self.bad.select(F.col("node").alias("child")), "child", "left_anti").select("child", "parent"))

    def rows(self) -> DataFrame:
        """(concept_id, root_id, depth[, path]): one row per node."""
        out = self.reached.select(F.col("node").alias("concept_id"), F.col("root").alias("root_id"), "depth", *(["path"] if self.paths else []))
        if self.bad is None:
            return out
        return out.unionByName(self.bad.select(F.col("node").alias("concept_id"), F.col("root").alias("root_id"), F.lit(-1).alias("depth")), allowMissingColumns=True)

    def descendants(self) -> DataFrame:
        """(ancestor, descendant, distance) of all nodes that are not on or below a cycle."""
        return descendants(self.good, self.scratch)


def hierarchy(edges: DataFrame, scratch: Scratch, stride: int = STRIDE, paths: bool = False) -> DataFrame:
    """Every node of the links (child, parent) with ``root_id``, ``depth`` and, if asked for, ``path``; see ``Tree``."""
    return Tree(edges, scratch, stride, paths).rows()


def cycles(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(concept_id, cycle_id): the nodes on cycles, those of cycles that share nodes under the smallest one of them all."""
    edges = scratch.table("edges", edges.select("child", "parent").distinct())
    return Cycles(edges, scratch).on().select(F.col("node").alias("concept_id"), F.col("root").alias("cycle_id"))
