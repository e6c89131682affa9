"""Consolidating pairwise matches into groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import Scratch

#: Rate of the exponential start times: a higher one gives smaller clusters of lower diameter.
BETA = 0.4
#: Growth steps per level before clusters contract.
STEPS = 4
SEED = 20240801
#: Bits of a vertex number, and time units of one edge. Times up to 128 edges fit the bits that are left.
NUMBER, EDGE = 40, 1 << 16


def numbered(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, v): the distinct ``ids`` with numbers from 0 up. Only the rows of each part are counted together."""
    parts = scratch.table("vertices", ids.distinct().select("id", F.monotonically_increasing_id().alias("_m")))
    part = F.shiftright("_m", 33)
    before = parts.groupBy(part.alias("_p")).agg(F.count("*").alias("_n")).withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per part of the table, so it is a bounded table to send
    return scratch.table("numbered", parts.withColumn("_p", part).join(F.broadcast(before.select("_p", "_off")), "_p").select("id", (F.col("_off") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).alias("v")))


def _start(vertex: Column, level: int, beta: float) -> Column:
    """The time at which a vertex may start a cluster, above its number: an exponentially distributed head start, from a hash,
    so a recomputed task draws the same. One long holds both, so that the earliest is a plain minimum."""
    uniform = (F.pmod(F.xxhash64(vertex, F.lit(SEED + level)), F.lit(2**52)).cast("double") + 0.5) / float(2**52)
    time = F.greatest(F.lit(0), ((100 + F.log(uniform) / beta) * EDGE).cast("long"))
    return F.shiftleft(time, NUMBER).bitwiseOR(vertex)


def _cluster(edges: DataFrame, level: int, beta: float, steps: int, scratch: Scratch) -> DataFrame:
    """(v, c): every vertex of the symmetric ``edges`` (a, b, w) with the cluster that reached it first.

    Each vertex may start a cluster of its own at its start time; a cluster takes one time unit per edge. After ``steps``
    steps a vertex belongs to the earliest cluster that came by; every cluster is connected whatever the number of steps,
    so contracting clusters never joins or parts groups wrongly. Edges of a vertex to itself, of no length, carry the state
    on, so each step reads it once.
    """
    state = edges.where("w = 0").select(F.col("a").alias("v"), _start(F.col("a"), level, beta).alias("s"))
    for _ in range(steps):
        come = edges.join(state.withColumnRenamed("v", "a"), "a").select(F.col("b").alias("v"), (F.col("s") + F.col("w") * F.lit(EDGE << NUMBER)).alias("s"))
        state = come.groupBy("v").agg(F.min("s").alias("s"))
    return scratch.table("clusters", state.select("v", F.col("s").bitwiseAND(F.lit((1 << NUMBER) - 1)).alias("c")))


def match_groups(pairs: DataFrame, left: str, right: str, scratch: Scratch, beta: float = BETA, steps: int = STEPS) -> DataFrame:
    """(id, group_id) for every id in a group of two or more; ``group_id`` is the smallest id of the group.

    Low-diameter decomposition: clusters grow from exponentially shifted start times, contract to super-vertices, and the
    edges between clusters are treated the same way until none is left; the assignments of all levels are composed. Each
    level leaves a constant share of its edges, so the levels grow with the logarithm of the pairs, and one level is a few
    equi-joins and hash aggregates of numbers that combine before the shuffle: a vertex with a third of all pairs meets its
    state in a join that adaptive execution may split, and its offers are reduced on the map side.

    Pairs with a null end and pairs of an id with itself link nothing; repeated pairs count once; an empty table gives none.
    """
    ends = scratch.table("ends", pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null and a <> b").distinct())
    ids = numbered(ends.select(F.col("a").alias("id")).union(ends.select("b")), scratch)
    at = lambda c: ids.select(F.col("id").alias(c), F.col("v").alias(f"_{c}"))
    numbers = ends.join(at("a"), "a").join(at("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    members: list[DataFrame] = []
    while True:
        both = numbers.union(numbers.select("b", "a")).distinct()
        edges, n = scratch.counted("edges", both.withColumn("w", F.lit(1)).union(both.select("a", "a", F.lit(0)).distinct()))
        if not n:
            break
        clusters = _cluster(edges, len(members), beta, steps, scratch)
        members.append(clusters)
        ca, cb = clusters.select(F.col("v").alias("a"), F.col("c").alias("_a")), clusters.select(F.col("v").alias("b"), F.col("c").alias("_b"))
        numbers = edges.where("w = 1 and a < b").join(ca, "a").join(cb, "b").where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    if not members:
        return ends.select(F.col("a").alias("id"), F.col("b").alias("group_id")).limit(0)
    # compose from the last level down: what a cluster became on the next level, or itself where it has no edge left
    top = members[-1]
    for lower in reversed(members[:-1]):
        top = scratch.table("composed", lower.join(top.select(F.col("v").alias("c"), F.col("c").alias("_top")), "c", "left").select("v", F.coalesce("_top", "c").alias("c")))
    named = scratch.table("named", top.join(ids, "v").select("c", "id"))
    return named.join(named.groupBy("c").agg(F.min("id").alias("group_id")), "c").select("id", "group_id")
