"""References to records that do not exist."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = ("simple", "partial", "full")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def reference_status(
    refs: DataFrame,
    targets: DataFrame,
    on: Sequence[tuple[str, str]],
    match: str = "simple",
    attributes: Sequence[str] = (),
    nullable: Sequence[str] | None = None,
) -> DataFrame:
    """Every reference with ``found`` and the attributes of its target.

    ``on`` pairs reference columns with target columns. References are grouped by their null mask, and each mask is joined
    on its non-null columns only. ``match`` says what a mask with nulls means, as in SQL's referential constraints:
    ``simple``: such a reference is satisfied; ``partial``: it needs a target that agrees on the non-null columns, or none at
    all if every column is null; ``full``: it is not satisfied unless every column is null.

    ``nullable`` names the reference columns that can be null (default: all); only their masks are planned. Targets are
    made distinct per mask before the join, so no reference is multiplied; ``attributes`` of several targets that agree on
    a partial key are their minima. Repeated references stay repeated, empty tables give empty results, and columns of the
    references keep their names (target columns are renamed first), except that those named as results are replaced. Both sides hash-aggregate before the shuffle, and the
    join is a plain equi-join that adaptive execution may split where one key is hot.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    refs = refs.drop("found", *attributes)
    nullable = list(nullable if nullable is not None else [r for r, _ in on])
    own = "_t"
    while any(c.startswith(own) for c in refs.columns):
        own = "_" + own
    parts = []
    for mask in product(*[(False, True) if r in nullable else (False,) for r, _ in on]):
        here = reduce(Column.__and__, [F.col(r).isNull() if m else F.col(r).isNotNull() for (r, _), m in zip(on, mask, strict=True)])
        part = refs.where(here)
        keys = [(r, t) for (r, t), m in zip(on, mask, strict=True) if not m]
        unsatisfied = match == "full" and keys and any(mask)
        if any(mask) and (match != "partial" or not keys):
            part = part.withColumn("found", F.lit(not unsatisfied))
            for a in attributes:
                part = part.withColumn(a, F.lit(None).cast(targets.schema[a].dataType))
        else:
            known = targets.groupBy(*[F.col(t).alias(f"{own}{i}") for i, (_, t) in enumerate(keys)]).agg(
                F.lit(True).alias(f"{own}_found"), *[F.min(a).alias(f"{own}_{a}") for a in attributes]
            )
            joined = part.join(known, [F.col(r) == F.col(f"{own}{i}") for i, (r, _) in enumerate(keys)], "left")
            part = joined.select(*[F.col(c) for c in refs.columns], F.coalesce(f"{own}_found", F.lit(False)).alias("found"), *[F.col(f"{own}_{a}").alias(a) for a in attributes])
        parts.append(part)
    return _union(parts)


def orphans(refs: DataFrame, targets: DataFrame, on: Sequence[tuple[str, str]], match: str = "simple", nullable: Sequence[str] | None = None) -> DataFrame:
    """The references without a target under the declared match semantics; see ``reference_status``."""
    return reference_status(refs, targets, on, match, (), nullable).where(~F.col("found")).drop("found")


def timed_orphans(refs: DataFrame, targets: DataFrame, on: Sequence[tuple[str, str]], nullable: Sequence[str] | None = None) -> DataFrame:
    """References whose target is missing, not yet there, or deleted, each with ``reason`` and ``period``.

    ``refs`` has ``seen``, the time at which the referring record was first there; ``targets`` has one row per key with
    ``first_ingested`` and ``first_deleted``. ``missing``: no target has the key; ``late``: the target arrived after
    ``seen``; ``deleted``: it was deleted at or before ``seen``. A null ``seen`` can only be ``missing``, with a null period.
    """
    status = reference_status(refs, targets, on, "simple", ("first_ingested", "first_deleted"), nullable)
    reason = (
        F.when(~F.col("found"), "missing")
        .when(F.col("first_ingested") > F.col("seen"), "late")
        .when(F.col("first_deleted") <= F.col("seen"), "deleted")
    )
    return status.withColumn("reason", reason).where(F.col("reason").isNotNull()).withColumn("period", F.date_format("seen", "yyyy-MM")).drop("found", "first_ingested", "first_deleted")


def orphans_per_period(found: DataFrame) -> DataFrame:
    """The report: orphans per table, field, reason and period."""
    return found.groupBy("ref_table", "ref_field", "reason", "period").agg(F.count("*").alias("n_orphans"), F.countDistinct("record_id").alias("n_records"))


def json_ids(text: Column) -> Column:
    """The elements of a JSON array in a text column; null for a text that is not a valid JSON array."""
    parsed = F.try_parse_json(text)
    return F.when(F.schema_of_variant(parsed).startswith("ARRAY"), F.try_variant_get(parsed, "$", "array<string>"))
