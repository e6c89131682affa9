"""Concepts: names, bindings, candidates, similarity, alias groups and the hierarchy of direct links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import ngrams, normalize_text
from tracewright.operators import hierarchy
from tracewright.session import Scratch

#: Links of one strongly connected part that are folded in one task.
FOLD = 200_000

#: Links that are reduced in one task; more are reduced by distributed walks.
REDUCE = 2_000_000

#: Words of 64 places that a sweep of the reduction holds at once.
WORDS = 1 << 24


def names_of(concepts: DataFrame) -> DataFrame:
    """(concept_id, term, method, raw): the normalised canonical name and aliases of each concept, each term once."""
    forms = F.concat(
        F.array(F.struct(F.col("canonical_name").alias("raw"), F.lit("exact_canonical").alias("method"))),
        F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(a.alias("raw"), F.lit("exact_alias").alias("method"))),
    )
    each = concepts.select("concept_id", F.explode(forms).alias("f")).select("concept_id", normalize_text(F.col("f.raw")).alias("term"), "f.method", "f.raw")
    return each.where("term <> ''").groupBy("concept_id", "term").agg(F.max("method").alias("method"), F.min("raw").alias("raw"))


def bind_exact(values: DataFrame, names: DataFrame) -> DataFrame:
    """(value, term, status, concept_id, method): matched if one concept bears the name, ambiguous if several do.

    Distinct values only, so a value that fills a third of a table is one row. ``method`` prefers the canonical name.
    """
    v = values.select("value", normalize_text(F.col("value")).alias("term")).distinct()
    owners = names.groupBy("term").agg(F.countDistinct("concept_id").alias("n"), F.min("concept_id").alias("one"), F.max("method").alias("method"))
    status = F.when(F.col("n").isNull(), "unmatched").when(F.col("n") > 1, "ambiguous").otherwise("matched")
    return v.join(owners, "term", "left").select("value", "term", status.alias("status"), F.when(F.col("n") == 1, F.col("one")).alias("concept_id"), F.when(F.col("n") == 1, F.col("method")).alias("method"))


def tfidf(docs: DataFrame) -> DataFrame:
    """(id, gram, w): L2-normalised weights (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1) of character 2- and 3-grams."""
    grams = docs.select("id", F.explode(ngrams(F.col("text"))).alias("gram")).groupBy("id", "gram").agg(F.count("*").alias("tf"))
    n = docs.agg(F.countDistinct("id").alias("n"))
    df = grams.groupBy("gram").agg(F.count("*").alias("df"))
    raw = grams.join(df, "gram").crossJoin(F.broadcast(n)).withColumn("w", (1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))  # one row
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "id").select("id", "gram", (F.col("w") / F.col("norm")).alias("w"), F.col("w").alias("idf_w"), "df")


def similar(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` documents of greatest cosine for each query of (id, text).

    An inverted join over the grams; grams that the index lacks add to a query's norm with the weight of a gram that no
    document has. Scores are rounded to six decimals, ties go to the smaller id.
    """
    from pyspark.sql import Window

    grams = queries.select(F.col("id").alias("query_id"), F.explode(ngrams(F.col("text"))).alias("gram")).groupBy("query_id", "gram").agg(F.count("*").alias("qtf"))
    stats = index.groupBy("gram").agg(F.first("df").alias("df"))
    n = index.agg(F.countDistinct("id").alias("n"))
    q = grams.join(stats, "gram", "left").crossJoin(F.broadcast(n))  # one row
    q = q.withColumn("qw", (1 + F.log("qtf")) * F.when(F.col("df").isNull(), 1.0).otherwise(F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = q.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    score = q.join(index.select("id", "gram", "w"), "gram").groupBy("query_id", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("s")).join(norm, "query_id")
    score = score.select("query_id", "id", F.round(F.col("s") / F.col("qnorm"), 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return score.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def contained(texts: DataFrame, words: DataFrame, seed: int = 2) -> DataFrame:
    """The columns of ``texts`` (text_id, text, ...; one row per id) with ``term`` and ``hits``: words (term), all distinct, that occur in them.

    The substring join becomes an equi-join on the word's first ``seed`` characters, which every text lists once. Only ids meet
    the words there; the text itself is joined to the pairs found, not sent once per seed, and by merging: the planner takes
    the packed size of the texts for their real one and might broadcast them by way of the driver. Give ``words`` as a written
    table: its size tells the planner whether the seeds of the texts have to be shuffled at all.
    """
    w = words.where(F.length("term") >= seed).select("term", F.substring("term", 1, seed).alias("_g"))
    seeds = F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?s)(?=({'.' * seed}))"), F.lit(1)))
    pairs = texts.select(F.col("text_id").alias("_id"), F.explode(seeds).alias("_g")).join(w, "_g").select("_id", "term")
    n = (F.length("text") - F.length(F.replace("text", "term", F.lit("")))) / F.length("term")
    return pairs.hint("merge").join(texts, F.col("_id") == F.col("text_id")).where(F.contains("text", "term")).select(*texts.columns, "term", n.cast("int").alias("hits"))


def contained_terms(texts: DataFrame, terms: DataFrame, seed: int = 2) -> DataFrame:
    """(text_id, term_id, term, hits): terms (term_id, term) that occur in texts (text_id, text); a word of several terms is looked for once."""
    hits = contained(texts.select("text_id", "text"), terms.select("term").distinct(), seed)
    return hits.join(terms.select("term_id", "term"), "term").select("text_id", "term_id", "term", "hits")


def coverage(texts: DataFrame, terms: DataFrame, seed: int = 2) -> DataFrame:
    """(text_id, covered, n_chars): how many characters of each text some term covers; overlaps count once."""
    t = terms.where(F.length("term") >= seed).select("term", F.substring("term", 1, seed).alias("_g")).distinct()
    places = texts.select("text_id", "text", F.posexplode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("text") - (seed - 1), F.lit(1))), lambda i: F.substring(F.col("text"), i, F.lit(seed)))).alias("_at", "_g"))
    spans = places.join(t, "_g").where(F.substring("text", F.col("_at") + 1, F.length("term")) == F.col("term")).select("text_id", F.explode(F.sequence(F.col("_at"), F.col("_at") + F.length("term") - 1)).alias("c"))
    n = spans.groupBy("text_id").agg(F.countDistinct("c").alias("covered"))
    return texts.select("text_id", F.length("text").alias("n_chars")).join(n, "text_id", "left").select("text_id", F.coalesce("covered", F.lit(0)).alias("covered"), "n_chars")


def rank_bands(counted: DataFrame, n: Column, name: Column) -> DataFrame:
    """Add ``rank``, ``population``, ``confidence`` and ``band``: ranks by count, then name; bands in the ratio 1:5:25."""
    # ranks of distinct names: a bucket by count and first characters keeps each window small
    from tracewright.operators.sequence import ranked

    df = ranked(counted.withColumn("_one", F.lit(1)), ["_one"], F.struct((-n).alias("n"), F.substring(name, 1, 2).alias("p")), [name], "_rank").drop("_one")
    total = counted.agg(F.count("*").alias("population"))
    df = df.crossJoin(F.broadcast(total)).withColumn("rank", F.col("_rank") + 1)  # one row
    band = F.when(F.col("rank") <= F.ceil(F.col("population") / 31), "HIGH").when(F.col("rank") <= F.ceil(6 * F.col("population") / 31), "MEDIUM").otherwise("LOW")
    return df.withColumn("confidence", F.round(1 - (F.col("rank") - 1) / F.col("population"), 4)).withColumn("band", band).drop("_rank")


def cycle_free(edges: DataFrame, scratch: Scratch, most: int = FOLD) -> DataFrame:
    """Links (child, parent) of an acyclic graph: taken in sorted order, one that would close a cycle is left out.

    Only links within a strongly connected part lie on cycles, so all others stay, and the parts are folded independently.
    A part of more than ``most`` links is no task of its own: its order is cut by distributed searches for the longest
    prefix without a cycle. Links of a node to itself are left out; repeated ones count once.
    """
    edges = scratch.table("links", edges.where("child <> parent").select("child", "parent").distinct())
    on = scratch.table("on_cycles", hierarchy.cycles(edges, scratch))
    placed = edges.join(on.select(F.col("concept_id").alias("child"), F.col("cycle_id").alias("_g")), "child").join(on.select(F.col("concept_id").alias("parent"), F.col("cycle_id").alias("_h")), "parent")
    placed = scratch.table("suspects", placed.where("_g = _h").select("child", "parent", "_g"))
    sizes = scratch.table("sizes", placed.groupBy("_g").agg(F.count("*").alias("_n")))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        up: dict[str, list[str]] = {}
        keep = []
        for child, parent in sorted(zip(pdf["child"], pdf["parent"], strict=True)):
            stack, seen = [parent], set()
            while stack:
                x = stack.pop()
                if x == child:
                    break
                if x not in seen:
                    seen.add(x)
                    stack += up.get(x, [])
            else:
                up.setdefault(child, []).append(parent)
                keep.append((child, parent))
        return pd.DataFrame(keep, columns=["child", "parent"])

    small = placed.join(sizes.where(F.col("_n") <= most).select("_g"), "_g", "left_semi").groupBy("_g").applyInPandas(fold, "child string, parent string")
    out = edges.join(placed.select("child", "parent"), ["child", "parent"], "left_anti").unionByName(small)
    large = placed.join(sizes.where(F.col("_n") > most).select("_g"), "_g", "left_semi").select("child", "parent")
    return out if large.isEmpty() else out.unionByName(_longest_prefixes(large, scratch))


def _longest_prefixes(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """What ``cycle_free`` keeps of links of any number, by distributed tests of sorted prefixes for cycles."""
    parts = scratch.table("ranges", edges.repartitionByRange("child", "parent").withColumn("_p", F.spark_partition_id()))
    before = parts.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = parts.join(before.select("_p", "_off"), "_p").withColumn("_r", F.col("_off") + F.row_number().over(Window.partitionBy("_p").orderBy("child", "parent")))
    ranked = scratch.table("ranked_links", ranked.select("child", "parent", "_r"))
    total, done, kept = ranked.count(), 0, edges.limit(0)
    while done < total:
        good, bad = done, total + 1
        while bad - good > 1:
            middle = total if bad == total + 1 else (good + bad) // 2
            trial = kept.unionByName(ranked.where((F.col("_r") > done) & (F.col("_r") <= middle)).select("child", "parent"))
            if hierarchy.strong_parts(trial, scratch).isEmpty():
                good = middle
            else:
                bad = middle
        kept = scratch.table("kept", kept.unionByName(ranked.where((F.col("_r") > done) & (F.col("_r") <= good)).select("child", "parent")))
        done = good + 1
    return kept


def _levels(to: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Longest distance of each node from those that no arc enters, -1 on or behind a cycle; ``to[start[x]:start[x + 1]]`` are the arcs from x."""
    left, level = np.bincount(to, minlength=n), np.full(n, -1)
    now, depth = np.flatnonzero(left == 0), 0
    while len(now):
        level[now] = depth
        counts = start[now + 1] - start[now]
        into, times = np.unique(to[np.repeat(start[now] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())], return_counts=True)
        left[into] -= times
        now, depth = into[left[into] == 0], depth + 1
    return level


def _replaced(c: np.ndarray, p: np.ndarray, n: int, words: int = WORDS) -> np.ndarray | None:
    """Which links (c[i], p[i]) of the nodes 0 to n - 1 a longer path replaces; None if they hold a cycle.

    A longer path from c to p needs two levels more between them, counted from the top and from the bottom alike; the other
    links stay. Of the rest the parents are the targets: sweeps down the levels carry one bit for each of them, in sets of
    targets of neighbouring levels, and a link is replaced if its target lies above another parent of the child.
    """
    if not len(c):
        return np.zeros(0, bool)
    arcs = lambda frm, to: (to[np.argsort(frm, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(frm, minlength=n))]))
    top = _levels(*arcs(p, c), n)
    if top.min() < 0:
        return None
    bottom = _levels(*arcs(c, p), n)
    order = np.lexsort((c, top[c]))
    c, p = c[order], p[order]
    several = np.bincount(c, minlength=n) > 1
    asked = np.flatnonzero(several[c] & (top[c] >= top[p] + 2) & (bottom[p] >= bottom[c] + 2))
    out = np.zeros(len(c), bool)
    targets = np.unique(p[asked])
    targets = targets[np.argsort(top[targets], kind="stable")]
    by_level = np.argsort(top, kind="stable")  # places of the nodes: those of a level lie together
    place = np.empty(n, np.int64)
    place[by_level] = np.arange(n)
    first = np.concatenate([[0], np.cumsum(np.bincount(top))])  # of each level among the places
    arc = np.searchsorted(top[c], np.arange(len(first)))  # of each level among the links
    width = int(np.clip(words // n, 1, 64))
    bit = np.full(n, -1)
    for k in range(0, len(targets), 64 * width):
        block = targets[k : k + 64 * width]
        bit[block] = np.arange(len(block))
        own = asked[bit[p[asked]] >= 0]
        low, high = top[block[0]], top[c[own]].max()
        base = first[low]
        above = np.zeros((first[high + 1] - base + 1, width), np.uint64)  # targets above each place, none in the last row: higher levels
        own_at = np.searchsorted(own, arc)
        for level in range(low + 1, high + 1):
            here = slice(arc[level], arc[level + 1])
            up = p[here]
            at = np.maximum(place[up] - base, -1)
            new = np.concatenate([[True], c[here][1:] != c[here][:-1]])
            row = np.cumsum(new) - 1
            got = np.bitwise_or.reduceat(above[at], np.flatnonzero(new), axis=0)
            mine = own[own_at[level] : own_at[level + 1]]
            b = bit[p[mine]]
            out[order[mine]] = got[row[mine - arc[level]], b // 64] >> (b % 64).astype(np.uint64) & np.uint64(1)
            hit = np.flatnonzero(bit[up] >= 0)
            b = bit[up[hit]]
            np.bitwise_or.at(got, (row[hit], b // 64), np.uint64(1) << (b % 64).astype(np.uint64))
            above[place[c[here][new]] - base] = got
        bit[block] = -1
    return out


def _replaced_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (child, parent) that a longer path replaces; one row of nulls if they hold a cycle."""
    held = list(batches)
    if not held:
        return
    links = pa.Table.from_batches(held)
    ids = pc.unique(pa.chunked_array([*links["child"].chunks, *links["parent"].chunks]))
    c, p = (pc.index_in(links[k], value_set=ids).to_numpy().astype(np.int64) for k in ("child", "parent"))
    gone = _replaced(c, p, len(ids))
    out = pa.table({k: pa.nulls(1, links[k].type) for k in ("child", "parent")}) if gone is None else links.filter(pa.array(gone))
    yield from out.to_batches()


def reduce_transitive(edges: DataFrame, scratch: Scratch, most: int = REDUCE) -> DataFrame:
    """Edges (child, parent) of an acyclic graph that no longer path replaces.

    The places above all children are far more than the links, so up to ``most`` links are swept in one task that keeps
    bits, and only those replaced are written. More links, or links with a cycle, are walked.
    """
    edges, n = scratch.counted("edges", edges.select("child", "parent").distinct())
    if n <= most:
        swept = edges.where("child is not null and parent is not null").repartition(1).mapInArrow(_replaced_links, edges.schema)
        gone, cycle = scratch.append("replaced", 0, swept, F.col("child").isNull())
        if not cycle:
            return edges.join(gone, ["child", "parent"], "left_anti")
    return _reduce_by_walks(edges, scratch)


def _reduce_by_walks(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``reduce_transitive`` of links of any number.

    Only a child with several parents can have a replaceable link, so walks go up from the parents of these, ``STRIDE`` levels
    in each round: a closure over so many levels is made once, and what lies exactly that far is where the next round starts.
    A place is entered once for each child, so the walks end on any graph; a walk that comes back to its child is a cycle, an error.
    """
    several = edges.groupBy("child").agg(F.count("*").alias("n")).where("n > 1").select("child")
    above = hierarchy.within(edges, hierarchy.STRIDE, scratch)
    walk = scratch.table("walk", edges.join(several, "child", "left_semi").select("child", F.col("parent").alias("at"), F.lit(0).alias("dist")))
    k, schema, n = 0, walk.schema, 1
    scratch.append("seen", k, walk.limit(0))
    while n:
        k += 1
        step = walk.select("child", F.col("at").alias("desc")).join(above, "desc").groupBy("child", F.col("anc").alias("at")).agg(F.min("dist").alias("dist"))
        fresh = step.join(scratch.appended("seen", schema).select("child", "at"), ["child", "at"], "left_anti").select("child", "at", "dist")
        fresh, n = scratch.append("seen", k, fresh, F.col("dist") == hierarchy.STRIDE)
        walk = fresh.where(F.col("dist") == hierarchy.STRIDE)
    longer = scratch.appended("seen", schema)
    if not longer.where("child = at").isEmpty():
        raise ValueError("the links hold a cycle")
    return edges.join(longer.select("child", F.col("at").alias("parent")), ["child", "parent"], "left_anti")


def pack_bins(cases: DataFrame, most: int, budget: int) -> DataFrame:
    """(tier, id, bin): cases (tier, frequency, id, size) packed greedily in order of frequency, at most ``most`` and ``budget``.

    A bin is closed when the next case would break a limit. Where a bin begins depends on all before, so a tier is one fold;
    it is fed in order, batch by batch, and holds only the state of the open bin.
    """
    ordered = cases.repartition("tier").sortWithinPartitions("tier", F.desc("frequency"), "id")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tier, bin_no, held, size = None, 0, 0, 0
        for pdf in batches:
            out = []
            for t, i, s in zip(pdf["tier"], pdf["id"], pdf["size"], strict=True):
                if t != tier:
                    tier, bin_no, held, size = t, 0, 0, 0
                if held and (held >= most or size + s > budget):
                    bin_no, held, size = bin_no + 1, 0, 0
                held, size = held + 1, size + s
                out.append((t, i, bin_no))
            yield pd.DataFrame(out, columns=["tier", "id", "bin"])

    return ordered.select("tier", "id", "size").mapInPandas(fold, "tier string, id string, bin long")
