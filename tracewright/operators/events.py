"""Stateful tables kept by merging: upserts, last-wins views, folds of event logs and state machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators import hierarchy
from tracewright.session import Scratch

def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], merged: dict[str, Column]) -> DataFrame:
    """A full outer merge of two tables with unique keys; ``merged`` says how columns (``o_``/``n_`` prefixed) combine."""
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns])
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns])
    joined = o.join(n, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys], "full")
    return joined.select(*[F.coalesce(f"n_{k}", f"o_{k}").alias(k) for k in keys], *[c.alias(name) for name, c in merged.items()])


def last_wins(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``: one candidate per key and task, not a sorted group."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in rest])


def first_wins_union(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of ``first``, and those of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def _followed(merged: DataFrame, scratch: Scratch) -> DataFrame:
    """(concept_id, into): merges (concept_id, into, at) followed to their ends.

    Merges that lead in a circle have no end: the latest one of each circle is taken back, so its concept is the end. Pointers
    are joined with themselves until none moves, so a chain of n merges takes about log2(n) rounds.
    """
    merged = scratch.table("merged", merged)
    round_about = hierarchy.cycles(merged.select(F.col("concept_id").alias("child"), F.col("into").alias("parent")), scratch)
    last = merged.join(round_about, "concept_id").groupBy("cycle_id").agg(F.max_by("concept_id", F.struct("at", "concept_id")).alias("concept_id")).select("concept_id")
    hop, moved = scratch.table("hops", merged.join(last, "concept_id", "left_anti").select("concept_id", "into")), 1
    while moved:
        far = hop.select(F.col("concept_id").alias("into"), F.col("into").alias("_next"))
        hop, moved = scratch.counted("hops", hop.join(far, "into", "left").select("concept_id", F.coalesce("_next", "into").alias("into"), F.col("_next").isNotNull().alias("_moved")), F.col("_moved"))
        hop = hop.select("concept_id", "into")
    return hop


def fold_memory(events: DataFrame, scratch: Scratch) -> DataFrame:
    """(concept_id, status, name, aliases, merged_into) after replaying events (seq, kind, concept_id, target_id, name).

    ``approve`` makes a concept registered, ``alias`` adds a name to it, ``reject`` takes it out, ``merge`` moves it and its
    names into another. The last approval or rejection of a concept decides; of merges the last one counts, chains are
    followed to their ends and the latest merge of a circle is taken back. Each is an aggregate or a join, so the log may be
    of any length.
    """
    decided = events.where("kind in ('approve', 'reject')").groupBy("concept_id").agg(F.max_by("kind", "seq").alias("last"), F.max_by("name", F.when(F.col("kind") == "approve", F.col("seq"))).alias("name"))
    merged = events.where("kind = 'merge' and target_id is not null and target_id <> concept_id").groupBy("concept_id").agg(F.max_by("target_id", "seq").alias("into"), F.max("seq").alias("at"))
    merged = _followed(merged, scratch)
    names = events.where("kind = 'alias' and name is not null").select("concept_id", "name").unionByName(decided.where("name is not null").select("concept_id", "name"))
    owner = names.join(merged.select("concept_id", "into"), "concept_id", "left").select(F.coalesce("into", "concept_id").alias("concept_id"), "name")
    aliases = owner.groupBy("concept_id").agg(F.array_sort(F.collect_set("name")).alias("aliases"))
    out = decided.join(merged.select("concept_id", "into"), "concept_id", "left").join(aliases, "concept_id", "left")
    status = F.when(F.col("into").isNotNull(), "MERGED").when(F.col("last") == "approve", "REGISTERED").otherwise("REJECTED")
    return out.select("concept_id", status.alias("status"), "name", F.when(F.col("into").isNull(), F.coalesce("aliases", F.array().cast("array<string>"))).alias("aliases"), F.col("into").alias("merged_into"))


def cache_misses(inputs: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inputs whose key and fingerprint no cached row has."""
    return inputs.join(cache.select(*keys).distinct(), list(keys), "left_anti")
