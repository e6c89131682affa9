"""Table access and delivery clean-up shared by operators and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def first_delivery(df: DataFrame, keys: list[str], **extra: Column) -> DataFrame:
    """One row per key with its earliest ``ingested_at`` as ``first_ingested`` and further aggregates.

    A hash aggregate with map-side combine, so a key with a third of all rows costs one partial row per input task.
    """
    return df.groupBy(*keys).agg(F.min("ingested_at").alias("first_ingested"), *[c.alias(n) for n, c in extra.items()])


def latest(df: DataFrame, keys: list[str], order: str = "ingested_at") -> DataFrame:
    """One row per key: the one with the greatest ``order``; equal ones are told apart by the row's values.

    ``max_by`` over a struct keeps a single candidate per key and map task, unlike a window over the whole key.
    """
    rest = [c for c in df.columns if c not in keys]
    comparable = [c for c in rest if df.schema[c].dataType.typeName() not in ("map", "variant")]
    rank = F.struct(F.col(order), *[F.col(c) for c in comparable if c != order])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
