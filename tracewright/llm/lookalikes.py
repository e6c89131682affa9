"""Visually identical text with different characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.glyphs import is_plain, standard_column

#: Accent- and case-sensitive Unicode collation: canonically equivalent strings are equal, width and accents are not ignored.
COLLATION = "UNICODE"


def _letters(text: Column) -> Column:
    """A hash of the letters and figures alone, which are the same in all texts that are equal under the collation."""
    return F.xxhash64(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def canonical_forms(texts: DataFrame, text: str = "text") -> DataFrame:
    """(text, standard, canonical) of all distinct texts: those of ``unusual_classes``, and all others, each a class of its own."""
    known = unusual_classes(texts, text)
    others = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct().join(known.select("text"), "text", "left_anti")
    return known.unionByName(others.select("text", F.col("text").alias("standard"), F.col("text").alias("canonical")))


def unusual_classes(texts: DataFrame, text: str = "text") -> DataFrame:
    """The distinct texts of every class with an unusual one, with ``standard`` (look-alikes mapped) and ``canonical`` (the
    member that stands for the class).

    Texts whose look-alike-mapped forms are equal under the collation form one class, so signs that the mapping does not know
    and the collation ignores make no difference either. Its canonical member is one that is written in its own mapped form,
    the shortest and then the smallest in byte order; if there is none, the smallest such form of its members.
    Plain characters differ from each other under the collation (a test compares all), so a class of plain texts only has one
    member and is its own; of the plain texts only those with the letters of an unusual one are looked at. Unusual texts
    are mapped in Arrow batches, all others are their own mapped form. Null texts are left out; empty ones are their own.
    """
    distinct = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct()
    odd = distinct.where(~is_plain(F.col("text"))).withColumn("standard", standard_column(F.col("text"))).withColumn("_l", _letters(F.col("standard")))
    plain = distinct.where(is_plain(F.col("text"))).withColumn("standard", F.col("text")).withColumn("_l", _letters(F.col("text"))).join(odd.select("_l").distinct(), "_l", "left_semi")
    mapped = odd.unionByName(plain).drop("_l").withColumn("_key", F.collate("standard", COLLATION))
    order = F.struct((F.col("text") != F.col("standard")).alias("made"), F.length("standard").alias("n"), F.col("standard").alias("form"))
    members = mapped.groupBy("_key").agg(F.min(order).alias("m")).select("_key", F.col("m.form").alias("canonical"))
    return mapped.join(members, "_key").select("text", "standard", "canonical")


def nonstandard(fields: DataFrame) -> DataFrame:
    """(ref_table, record_id, ref_field, text) rows whose text is not the canonical member of its class, with ``canonical``.

    Classes are made of all texts. Repeated rows come out once; null texts are no case.
    """
    fields = fields.select("ref_table", "record_id", "ref_field", "text").where(F.col("text").isNotNull())
    forms = unusual_classes(fields).where(F.col("text") != F.col("canonical")).select("text", "canonical")
    return fields.where(~is_plain(F.col("text"))).distinct().join(forms, "text").select("ref_table", "record_id", "ref_field", "text", "canonical")
