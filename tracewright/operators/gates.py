"""Gates: checks of stored rows and of model answers. A check is a filter that yields violations, never a loop over rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relation kinds a concept graph may hold.
KINDS = ("ISA", "PARTOF", "INCLUDES", "SAMEAS", "NOTSAMEAS", "DIFFERENTFROM", "RELATEDTO")


def violations(df: DataFrame, key: Column, checks: dict[str, Column]) -> DataFrame:
    """(id, check) for every row and check whose condition does not hold; an unknown condition does not hold."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return df.select(key.cast("string").alias("id"), F.explode(failed).alias("check"))


def repeated(df: DataFrame, key: Column, same: Column, name: str) -> DataFrame:
    """(id, check) for keys under which different things are stored."""
    return df.groupBy(key.cast("string").alias("id")).agg(F.countDistinct(same).alias("_n")).where("_n > 1").select("id", F.lit(name).alias("check"))


def graph_integrity(rules: DataFrame, states: DataFrame, relations: DataFrame, concepts: DataFrame, kind: Column) -> DataFrame:
    """(entity, id, check): what a graph import would refuse: missing ids and ends, unknown kinds, one id for two things."""
    parts = [
        violations(rules, F.col("id"), {"rule_has_package": F.col("context_package_id").isNotNull(), "rule_has_expression": F.col("raw_expression").rlike(r"\S")}).withColumn("entity", F.lit("rule")),
        violations(states, F.col("state_id"), {"state_has_object": F.col("object").rlike(r"\S"), "state_has_value": F.col("raw_state").rlike(r"\S"), "state_side": F.col("side").isin("condition", "antecedent", "consequent")}).withColumn("entity", F.lit("state")),
        violations(relations, F.col("relation_id"), {"relation_has_ends": F.col("child_concept_id").isNotNull() & F.col("parent_concept_id").isNotNull(), "relation_kind": kind.isin(*KINDS), "relation_no_loop": F.coalesce(F.col("child_concept_id") != F.col("parent_concept_id"), F.lit(True))}).withColumn("entity", F.lit("relation")),
        repeated(states, F.col("state_id"), F.struct(F.coalesce("object", F.lit("")), F.coalesce("raw_state", F.lit(""))), "state_identity").withColumn("entity", F.lit("state")),
    ]
    ends = relations.select("relation_id", F.explode(F.array("child_concept_id", "parent_concept_id")).alias("concept_id")).where("concept_id is not null")
    lacking = ends.join(concepts.select("concept_id"), "concept_id", "left_anti").select(F.col("relation_id").alias("id"), F.lit("end_exists").alias("check"), F.lit("relation").alias("entity"))
    return reduce(DataFrame.unionByName, [*parts, lacking]).select("entity", "id", "check").distinct()


def answers(cases: DataFrame, replies: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """(case_id, check): replies (case_id, decision, target_ids, evidence_ids) against their cases (case_id, candidates, evidence).

    Each case has exactly one reply; ``BIND`` names one candidate, ``REWRITE`` one to four, ``CREATE`` none, ``DISCARD`` none;
    targets are candidates of the case and evidence was supplied with it.
    """
    one = replies.groupBy("case_id").agg(F.count("*").alias("n"), F.first("decision").alias("decision"), F.first("target_ids").alias("targets"), F.first("evidence_ids").alias("given"))
    df = cases.join(one, "case_id", "left")
    empty = F.array().cast("array<string>")
    t, g = F.coalesce("targets", empty), F.coalesce("given", empty)
    size = F.size(t)
    counts = F.when(F.col("decision") == "BIND", size == 1).when(F.col("decision") == "REWRITE", size.between(1, 4)).otherwise(size == 0)
    checks = {"one_reply": F.col("n") == 1, "known_decision": F.col("decision").isin(*allowed), "target_count": counts, "targets_are_candidates": F.size(F.array_except(t, F.coalesce("candidates", empty))) == 0, "evidence_was_given": F.size(F.array_except(g, F.coalesce("evidence", empty))) == 0}
    return violations(df, F.col("case_id"), checks).withColumnRenamed("id", "case_id")


def admitted(cases: DataFrame, terms: DataFrame) -> DataFrame:
    """Add ``accepted`` and ``reason`` to candidates (concept_id, name, band, decision, checks array<boolean>).

    In order: rejected or deferred by the reviewer, outside the HIGH band, a check that failed, a name that another concept
    (term, concept_id) already bears; what is left is accepted.
    """
    owner = terms.groupBy("term").agg(F.min("concept_id").alias("_owner"))
    df = cases.join(owner, F.lower(F.col("name")) == F.col("term"), "left")
    reason = (
        F.when(F.col("decision") == "REJECT", "rejected")
        .when(F.col("decision") == "DEFER", "deferred")
        .when(F.col("band") != "HIGH", "band")
        .when(~F.coalesce(F.forall("checks", lambda c: F.coalesce(c, F.lit(False))), F.lit(False)), "checks")
        .when(F.col("_owner").isNotNull() & (F.col("_owner") != F.col("concept_id")), "name_taken")
    )
    return df.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull()).drop("term", "_owner")


def gold_metrics(gold: DataFrame, predicted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(n_gold, n_found, n_right, accuracy): gold rows joined null-safely with predictions; a missing one is wrong."""
    p = predicted.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(value).alias("_p_value"), F.lit(1).alias("_hit"))
    joined = gold.join(p, [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys], "left")
    return joined.agg(F.count("*").alias("n_gold"), F.count("_hit").alias("n_found"), F.count_if(F.col("_hit").isNotNull() & F.col(value).eqNullSafe(F.col("_p_value"))).alias("n_right")).withColumn("accuracy", F.round(F.coalesce(F.try_divide("n_right", "n_gold"), F.lit(1.0)), 4))
