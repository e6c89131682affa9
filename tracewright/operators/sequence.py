"""Windows over long sequences that never put a whole sequence into one task.

A sequence (a book, a user's history) may hold a third of all rows. Rows are cut into blocks by rank; a window runs
within each block, and what comes from earlier blocks is carried by one row per block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a sequence that one task handles together.
BLOCK = 4096


def ranked(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Add the rank (from 0) of each row in its sequence. ``bucket`` is a coarse, order-preserving part of the order.

    Rows are numbered within (keys, bucket); the buckets' sizes are summed up and added. Nulls in ``bucket`` come first.
    """
    df = df.withColumn("_bucket", bucket)
    sizes = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = df.withColumn("_at", F.row_number().over(inner) - 1)
    on = [numbered[k].eqNullSafe(offsets[k]) for k in keys] + [numbered["_bucket"].eqNullSafe(offsets["_bucket"])]
    joined = numbered.join(offsets, on, "left").select(*[numbered[c] for c in df.columns if c != "_bucket"], (F.col("_before") + F.col("_at")).cast("long").alias(name))
    return joined


def carried(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], pos: str = "pos", reverse: bool = False, inclusive: bool = False, block: int = BLOCK) -> DataFrame:
    """Add for each named value the last non-null one before each row (after it if ``reverse``; at it too if ``inclusive``).

    ``pos`` is the rank within ``keys``. Equal to ``last(value, ignoreNulls)`` over the whole sequence.
    """
    df = df.withColumn("_blk", F.floor(F.col(pos) / block)).withColumns({f"_v_{n}": c for n, c in values.items()})
    direction = F.col(pos).desc() if reverse else F.col(pos).asc()
    inner = Window.partitionBy(*keys, "_blk").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    df = df.withColumns({f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inner) for n in values})
    edge = F.min_by if reverse else F.max_by
    per_block = df.groupBy(*keys, "_blk").agg(*[edge(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(pos))).alias(f"_e_{n}") for n in values])
    outer = Window.partitionBy(*keys).orderBy(F.col("_blk").desc() if reverse else F.col("_blk").asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(*keys, "_blk", *[F.last(f"_e_{n}", ignorenulls=True).over(outer).alias(f"_c_{n}") for n in values])
    joined = df.join(carry, [*keys, "_blk"], "left").withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in values})
    return joined.drop("_blk", *[f"{p}{n}" for p in ("_v_", "_l_", "_c_") for n in values])


def running(df: DataFrame, keys: Sequence[str], name: str, value: Column, pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Add the running sum of ``value`` up to and including each row."""
    df = df.withColumn("_blk", F.floor(F.col(pos) / block)).withColumn("_v", value)
    inner = Window.partitionBy(*keys, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_s", F.sum("_v").over(inner))
    outer = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*keys, "_blk").agg(F.sum("_v").alias("_t")).select(*keys, "_blk", F.sum("_t").over(outer).alias("_c"))
    return df.join(carry, [*keys, "_blk"], "left").withColumn(name, F.coalesce("_s", F.lit(0)) + F.coalesce("_c", F.lit(0))).drop("_blk", "_v", "_s", "_c")


def shifted(df: DataFrame, keys: Sequence[str], columns: Sequence[str], by: int, suffix: str, pos: str = "pos", how: str = "left") -> DataFrame:
    """Add columns of the row ``by`` ranks further on (before if negative), by an equi-join on (keys, rank)."""
    other = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], (F.col(pos) - by).alias("_p"), *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col(pos) == F.col("_p")]
    return df.join(other, on, how).drop("_p", *[f"_k_{k}" for k in keys])
