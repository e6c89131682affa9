"""Sources: layout block lists, strict and lenient JSON lines, rule sets, logs, bundles with a manifest, models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Raw block types and the unit types they become; any other is a passage.
BLOCK_TYPES = {"text": "passage", "list": "passage", "title": "title", "image": "figure", "figure": "figure", "table": "table", "equation": "formula", "interline_equation": "formula", "formula": "formula", "code": "passage"}


def content_list(spark: SparkSession, path: str) -> DataFrame:
    """Units from layout block lists: one JSON array per file, blocks of uneven shape.

    Blocks that are no objects or have no type are skipped but keep their place in the numbering. A file that holds no
    array is an error. Contents are the table's body, the image's first caption or path, list items by line, else the text
    or the equation.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), F.parse_json("value").alias("v"))
    files = files.withColumn("v", F.when(F.schema_of_variant("v").startswith("ARRAY"), F.col("v")).otherwise(F.raise_error(F.concat(F.lit("no array in "), F.col("doc_id")))))
    files.createOrReplaceTempView("_content_list")
    blocks = spark.sql("SELECT doc_id, pos AS source_index, value AS b FROM _content_list, LATERAL variant_explode(v)")
    get = lambda p, t: F.try_variant_get("b", p, t)
    kind = get("$.type", "string")
    items = F.array_join(get("$.list_items", "array<string>"), "\n")
    text = F.coalesce(F.nullif(get("$.text", "string"), F.lit("")), F.nullif(get("$.equation", "string"), F.lit("")), F.lit(""))
    content = (
        F.when(kind == "table", F.coalesce(F.nullif(get("$.table_body", "string"), F.lit("")), text))
        .when(kind.isin("image", "figure"), F.coalesce(F.nullif(F.array_join(get("$.image_caption", "array<string>"), "\n"), F.lit("")), get("$.img_path", "string"), F.lit("")))
        .when(items != "", items)
        .otherwise(text)
    )
    source = F.struct(get("$.page_idx", "int").alias("page"), get("$.bbox", "array<double>").alias("bbox"), F.concat_ws(":", F.col("doc_id"), F.col("source_index").cast("string")).alias("original_block_id"), get("$.img_path", "string").alias("asset_path"))
    mapped = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in BLOCK_TYPES.items() for x in kv]), kind), F.lit("passage"))
    out = blocks.where(F.schema_of_variant("b").startswith("OBJECT") & kind.isNotNull())
    return out.select(F.format_string("unit_%06d", F.col("source_index").cast("int") + 1).alias("id"), "doc_id", F.col("source_index").cast("int").alias("source_index"), mapped.alias("type"), content.alias("content"), source.alias("source"), get("$.text_level", "int").alias("text_level"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True, required: Sequence[str] = ()) -> DataFrame:
    """JSON lines by a schema, blank lines skipped. ``strict``: a malformed line or a missing required field is an error; else such lines are dropped."""
    if strict:
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        for r in required:
            df = df.withColumn(r, F.when(F.col(r).isNotNull(), F.col(r)).otherwise(F.raise_error(F.lit(f"{r} is missing"))))
        return df
    ok = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    for r in required:
        ok = ok.where(F.col(r).isNotNull())
    return ok


def rulesets(spark: SparkSession, flat: str, cache: str, schema: StructType | str) -> DataFrame:
    """Rules from the flat file if it is there, else from the folder of files by package; neither is an error."""
    for path in (flat, f"{cache}/*.json"):
        try:
            return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        except Exception as e:  # noqa: BLE001 - only a missing path falls through
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"neither {flat} nor {cache}")


def limited(rules: DataFrame, order: Sequence[str], limit: int | None, ids: Sequence[str] = ()) -> DataFrame:
    """Rules of the given ids (all if none), at most ``limit`` in order."""
    df = rules.where(F.col("id").isin(*ids)) if ids else rules
    return df if limit is None else df.orderBy(*order).limit(limit)


def bundle_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, sha256) of the files of a bundle."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length", F.sha2("content", 256).alias("sha256"))


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, media_type, data_url) of image files; unknown formats have a null media type and no data."""
    kind = F.when(F.substring("content", 1, 4) == F.lit(bytearray(b"\x89PNG")), "image/png").when(F.substring("content", 1, 2) == F.lit(bytearray(b"\xff\xd8")), "image/jpeg").when(F.substring("content", 1, 3) == F.lit(bytearray(b"GIF")), "image/gif")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).withColumn("media_type", kind)
    return df.select("path", "media_type", F.when(F.col("media_type").isNotNull(), F.concat(F.lit("data:"), "media_type", F.lit(";base64,"), F.base64("content"))).alias("data_url"))


def last_of_log(log: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row per key of an append-only log; rows without a key are left out."""
    rest = [c for c in log.columns if c != key]
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def call_model(requests: DataFrame, client: Callable[[str], str], attempts: int = 3) -> DataFrame:
    """(id, response, attempts, error): each request's payload sent to an injected client, tried up to ``attempts`` times.

    The client runs on the executors, batch by batch; one that keeps failing gives an error, not a failed job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, payload in zip(pdf["id"], pdf["payload"], strict=True):
                response, error, n = None, None, 0
                while response is None and n < attempts:
                    n += 1
                    try:
                        response, error = client(payload), None
                    except Exception as e:  # noqa: BLE001 - reported in the row
                        error = f"{type(e).__name__}: {e}"
                rows.append((i, response, n, error))
            yield pd.DataFrame(rows, columns=["id", "response", "attempts", "error"])

    return requests.select("id", "payload").mapInPandas(run, "id string, response string, attempts int, error string")
