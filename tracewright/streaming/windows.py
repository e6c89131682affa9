"""Windowed and stateful aggregates as structured streams, run over the available data to their end."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import Scratch


def run(spark: SparkSession, path: str, build: Callable[[DataFrame], DataFrame], mode: str = "complete") -> DataFrame:
    """Stream the parquet files at ``path`` through ``build`` until all are read; the result as a table in the shared folder.

    Each micro-batch replaces (``complete``) or adds to (``append``) the table; a batch that is run again writes the same.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") and _is_file(spark, path) else spark.readStream.schema(schema).parquet(path)
    scratch = Scratch(spark, "stream")
    out = f"{scratch.root}/out"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    result = build(stream)
    query = result.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{scratch.root}/state-{uuid.uuid4().hex[:8]}").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def _utc(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(spark: SparkSession, path: str, width: str) -> DataFrame:
    """(window_start, event_type, n, total) per window and type."""
    out = run(spark, path, lambda s: _utc(s).withWatermark("ts", "1 hour").groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


def sliding(spark: SparkSession, path: str, width: str, every: str) -> DataFrame:
    """(window_start, n) per sliding window."""
    out = run(spark, path, lambda s: _utc(s).groupBy(F.window("ts", width, every)).agg(F.count("*").alias("n")))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n")


def sessions(spark: SparkSession, path: str, gap: str) -> DataFrame:
    """(user_id, session_start, n) per session: a session ends when a user is silent for the gap."""
    out = run(spark, path, lambda s: _utc(s).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")))
    return out.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("session_start"), "n")


def deduplicated(spark: SparkSession, path: str) -> DataFrame:
    """(event_type, n_users): users seen per type, counted after the stream dropped repeated pairs."""
    out = run(spark, path, lambda s: s.select("event_type", "user_id").dropDuplicates(["event_type", "user_id"]), "append")
    return out.groupBy("event_type").agg(F.count("*").alias("n_users"))
