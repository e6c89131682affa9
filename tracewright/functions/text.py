"""Scalar functions over names, ids and texts, as column expressions."""

from __future__ import annotations

import difflib
import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

SEPARATOR = "\x1f"


def normalize_name(name: Column) -> Column:
    """Letters A-Z, digits and Chinese characters only, in lower case."""
    return F.lower(F.regexp_replace(name, r"[^0-9A-Za-z\x{4e00}-\x{9fff}]+", ""))


def normalize_text(text: Column) -> Column:
    """Without any Unicode white space, in lower case."""
    return F.lower(F.regexp_replace(text, r"(?U)\s+", ""))


def normalize_caption(text: Column) -> Column:
    """Letters and digits without the words for figure, table and formula, in lower case."""
    return F.lower(F.regexp_replace(text, r"(?U)[\W_图表式]+", ""))


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` and 16 hexadecimal digits of the hash of the parts; null parts count as empty."""
    joined = F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 16))


def hashed_id(prefix: str, *parts: str) -> str:
    """``stable_id`` of plain strings, for functions that read text row by row."""
    return f"{prefix}_{hashlib.sha256(SEPARATOR.join(parts).encode()).hexdigest()[:16]}"


def fingerprint(*parts: Column) -> Column:
    """The full hash of canonical JSON of the parts, nulls kept."""
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def ngrams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """Character n-grams; a text shorter than the least size is its own."""
    parts = [_grams(text, n) for n in sizes]
    return F.when(F.length(text) >= min(sizes), F.concat(*parts)).when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))


def _grams(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def labels(text: Column) -> Column:
    """Numbers of cited figures, tables and formulas (n-m), dashes made plain."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, "–—－", "---"), F.lit("([0-9]+-[0-9]+)"), 1))


def occurrences(text: Column, term: Column) -> Column:
    """How often a term occurs without overlap; 0 for an empty term."""
    n = F.length(term)
    return F.when(n > 0, ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / n).cast("int")).otherwise(0)


@F.pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp likeness of two texts (Arrow batches); null if either is."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])

