"""Sinks: tables written as a whole, one file per key, reports and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; it appears as a whole when the job commits."""
    df.write.mode(mode).format(form).save(path)


def write_by_key(df: DataFrame, key: str, path: str, form: str = "json") -> None:
    """One folder per key; rows of a key are brought together first, so a key is few files."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).format(form).save(path)


def export_results(packages: DataFrame, results: DataFrame, path: str) -> DataFrame:
    """Packages with a successful result, their rules flattened, and a report of one row, which is also returned."""
    joined = packages.join(results, "context_package_id")
    good = joined.where("status in ('success', 'completed')")
    write_table(joined.drop("rules"), f"{path}/packages")
    write_table(good.select("context_package_id", F.explode("rules").alias("rule")).select("context_package_id", "rule.*"), f"{path}/rules")
    report = joined.agg(F.count("*").alias("n_packages"), F.count_if(F.col("status").isin("success", "completed")).alias("n_success"), F.coalesce(F.sum(F.when(F.col("status").isin("success", "completed"), F.size("rules"))), F.lit(0)).alias("n_rules"))
    write_table(report, f"{path}/report", "json")
    return report


def property_graph(rules: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes merged by the hash of what identifies them, and edges by position."""
    identity = F.sha2(F.concat_ws("\x1f", F.coalesce("object", F.lit("")), F.coalesce("raw_state", F.lit(""))), 256)
    s = states.withColumn("identity_hash", identity)
    nodes = s.select("identity_hash", "object", "raw_state").dropDuplicates(["identity_hash"])
    edges = rules.select(F.col("id").alias("rule_id")).join(s.select("rule_id", "side", "pos", "identity_hash"), "rule_id")
    return nodes, edges
