"""Functions of the engine under SQL names: ``register(spark)`` makes them known to a session."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracewright.functions import dsl, glyphs, quantity, text


class ParseRules:
    """Table function ``parse_rules(text, package)``: one row per rule; a malformed text is one row with ``error``."""

    def eval(self, body: str, package: str) -> Iterator[tuple]:
        try:
            for r in dsl.parse(body, package or ""):
                sides = ([f"{s['object']}|{s['raw_state']}" for s in r[k]] for k in ("conditions", "antecedents", "consequents"))
                yield (r["rule_id"], r["group"], r["idx"], *sides, r["relation"], None)
        except dsl.RuleError as e:
            yield (None, None, None, None, None, None, None, str(e))


def register(spark: SparkSession) -> None:
    """``standard_text``, ``difflib_ratio``, ``parse_quantity``, ``apply_patch`` and the table function ``parse_rules``."""

    @F.pandas_udf("string")
    def standard_text(texts: pd.Series) -> pd.Series:
        return texts.map(glyphs.standard, na_action="ignore")

    @F.pandas_udf("common_unit string, lower_value string, upper_value string")
    def parse_quantity(raws: pd.Series, normals: pd.Series) -> pd.DataFrame:
        rows = [quantity.quantity(r, n) or (None, None, None) for r, n in zip(raws, normals, strict=True)]
        return pd.DataFrame(rows, columns=["common_unit", "lower_value", "upper_value"])

    @F.pandas_udf("text string, error string")
    def apply_patch(drafts: pd.Series, patches: pd.Series) -> pd.DataFrame:
        return dsl.patched(drafts, patches)

    for name, function in (("standard_text", standard_text), ("difflib_ratio", text.similarity_ratio), ("parse_quantity", parse_quantity), ("apply_patch", apply_patch)):
        spark.udf.register(name, function)
    spark.udtf.register("parse_rules", F.udtf(ParseRules, returnType="rule_id string, rule_group string, idx int, conditions array<string>, antecedents array<string>, consequents array<string>, relation string, error string"))
