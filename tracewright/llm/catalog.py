"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bpe, canonical, groups, leaks, lookalikes, quality, scans
from tracewright.session import Scratch
from tracewright.tables import table


def approved_names(spark: SparkSession, sf: str) -> DataFrame:
    """(entry_id, name) of the reference list: canonical names and aliases of APPROVED concepts."""
    concepts = table(spark, sf, "concepts").where(F.upper(F.trim("registration_status")) == "APPROVED")
    names = F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return concepts.select(F.col("concept_id").alias("entry_id"), names.alias("name"))


def _mapped_objects(spark: SparkSession, sf: str) -> DataFrame:
    states = table(spark, sf, "rule_states").select("state_id", F.col("object").alias("value"))
    scratch = Scratch(spark, "canonical")
    mapping = scratch.table("mapping", canonical.map_to_list(states, approved_names(spark, sf), scratch))
    return states.join(mapping, "value", "left")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every row whose object means an entry of the reference list."""
    return _mapped_objects(spark, sf).where("entry_id is not null").select("state_id", F.col("entry_id").alias("concept_id")).distinct()


def p1_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Objects that mean no entry, with the number of states that hold them."""
    return _mapped_objects(spark, sf).where("entry_id is null").groupBy(F.col("value").alias("object")).agg(F.countDistinct("state_id").alias("n_states"))


def _kind(column: str = "type") -> F.Column:
    return F.regexp_replace(F.upper(column), r"[^\p{L}]", "")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """One identifier per group of ids linked by SAME_AS rows."""
    pairs = table(spark, sf, "concept_relations").where(_kind() == "SAMEAS")
    found = groups.match_groups(pairs, "child_concept_id", "parent_concept_id", Scratch(spark, "groups"))
    return found.select(F.col("id").alias("concept_id"), "group_id")


_P4_SQL = """
WITH RECURSIVE e AS (
  SELECT DISTINCT child_concept_id AS a, parent_concept_id AS b FROM concept_relations
  WHERE regexp_replace(upper(type), '[^\\p{L}]', '', 'g') = 'SAMEAS' AND child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL AND child_concept_id <> parent_concept_id),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS id, a AS r FROM s UNION SELECT reach.id, s.b FROM reach JOIN s ON reach.r = s.a)
SELECT id AS concept_id, min(r) AS group_id FROM reach GROUP BY 1
"""


def text_fields(spark: SparkSession, sf: str) -> DataFrame:
    """(ref_table, record_id, ref_field, text) of the texts whose look-alikes matter."""
    states, units = table(spark, sf, "rule_states"), table(spark, sf, "units")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("ref_field"), F.col(c).alias("text")) for c in ("object", "raw_state")])).alias("x")
    of_states = states.select(F.lit("rule_states").alias("ref_table"), F.col("state_id").alias("record_id"), pairs).select("ref_table", "record_id", "x.ref_field", "x.text")
    of_units = units.select(F.lit("units").alias("ref_table"), F.col("id").alias("record_id"), F.lit("content").alias("ref_field"), F.col("content").alias("text"))
    return of_states.unionByName(of_units).where("text is not null")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every text that is not in the standard form."""
    return lookalikes.nonstandard(text_fields(spark, sf)).select("ref_table", "record_id", "ref_field").distinct()


def p6_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical form of every text that is not in it."""
    return lookalikes.nonstandard(text_fields(spark, sf))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document."""
    return table(spark, sf, "documents").select("doc_id", bpe.encode_column(F.col("text")).alias("ids"))


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "eval_items").select("item_id", "text"), Scratch(spark, "leaks"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold about half or more of an evaluation item, with the item."""
    return _leaks(spark, sf).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation items that leaked, with the number of documents that hold them."""
    return _leaks(spark, sf).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max("held").alias("most_held"))


def _reading(spark: SparkSession, sf: str) -> scans.Reading:
    return scans.Reading(table(spark, sf, "units"), Scratch(spark, "scans"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of scan noise in each passage."""
    return _reading(spark, sf).noise()


def p3_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous readable text of each passage."""
    return _reading(spark, sf).repaired()


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    stats = quality.statistics(table(spark, sf, "documents").select("doc_id", "lang", "text"), table(spark, sf, "common_words"))
    return Scratch(spark, "quality").table("stats", stats)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents most of whose text is no prose."""
    stats = _quality(spark, sf)
    return quality.kinds(quality.scored(stats, quality.distributions(stats))).distinct()


def p10_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics of every document with their robust z-scores by language."""
    stats = _quality(spark, sf)
    return quality.scored(stats, quality.distributions(stats))


QUERIES = {"p3_found": p3_found, "p3_repaired": p3_repaired, "p9_found": p9_found, "p9_items": p9_items, "p10_found": p10_found, "p10_statistics": p10_statistics, "p1_found": p1_found, "p1_unmatched": p1_unmatched, "p4_found": p4_found, "p6_found": p6_found, "p6_canonical": p6_canonical, "p8_ids": p8_ids}
SQL = {"p4_found": _P4_SQL}
