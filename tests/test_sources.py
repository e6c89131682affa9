"""Sources and sinks on literal files."""

import json

import pytest
from pyspark.sql import functions as F

from tracewright import sinks
from tracewright.sources import documents


def test_content_list(spark, tmp_path):
    blocks = [{"type": "text", "text": "a", "page_idx": 1, "bbox": [1, 2, 3, 4]}, "noise", {"text": "no type"}, {"type": "image", "image_caption": ["Fig 1"], "img_path": "x.png"}, {"type": "list", "list_items": ["i", "j"]}, {"type": "equation", "text": "", "equation": "E=1"}, {"type": "other", "text": "z"}]
    (tmp_path / "book.json").write_text(json.dumps(blocks), encoding="utf-8")
    got = [(r.id, r.doc_id, r.type, r.content) for r in documents.content_list(spark, str(tmp_path / "book.json")).orderBy("source_index").collect()]
    assert got == [("unit_000001", "book", "passage", "a"), ("unit_000004", "book", "figure", "Fig 1"), ("unit_000005", "book", "passage", "i\nj"), ("unit_000006", "book", "formula", "E=1"), ("unit_000007", "book", "passage", "z")]
    (tmp_path / "bad.json").write_text("{}", encoding="utf-8")
    with pytest.raises(Exception, match="no array"):
        documents.content_list(spark, str(tmp_path / "bad.json")).collect()


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1"}\n\n{"id": null}\n', encoding="utf-8")
    (tmp_path / "b.jsonl").write_text('{"id": "1"}\nnot json\n', encoding="utf-8")
    assert documents.json_lines(spark, str(tmp_path / "a.jsonl"), "id string").count() == 2
    with pytest.raises(Exception, match="missing"):
        documents.json_lines(spark, str(tmp_path / "a.jsonl"), "id string", required=["id"]).collect()
    with pytest.raises(Exception):  # noqa: B017
        documents.json_lines(spark, str(tmp_path / "b.jsonl"), "id string").collect()
    assert [r.id for r in documents.json_lines(spark, str(tmp_path / "b.jsonl"), "id string", strict=False, required=["id"]).collect()] == ["1"]


def test_rulesets_fall_back(spark, tmp_path):
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache/p.json").write_text('{"id": "r1"}\n', encoding="utf-8")
    assert documents.rulesets(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "cache"), "id string").count() == 1
    with pytest.raises(FileNotFoundError):
        documents.rulesets(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "nowhere"), "id string")


def test_model_calls_are_retried(spark):
    def client(payload):
        if payload == "bad":
            raise ValueError("no")
        return payload.upper()

    df = spark.createDataFrame([("1", "a"), ("2", "bad")], "id string, payload string")
    got = {r.id: (r.response, r.attempts, r.error) for r in documents.call_model(df, client).collect()}
    assert got == {"1": ("A", 1, None), "2": (None, 3, "ValueError: no")}


def test_manifest_and_export(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"abc")
    assert documents.bundle_manifest(spark, str(tmp_path / "f.txt")).first().sha256.startswith("ba7816bf")
    p = spark.createDataFrame([("p1",), ("p2",)], "context_package_id string")
    r = spark.createDataFrame([("p1", "success", [("r1",)]), ("p2", "failed", [])], "context_package_id string, status string, rules array<struct<id:string>>")
    assert tuple(sinks.export_results(p, r, str(tmp_path / "out")).first()) == (2, 1, 1)
    assert spark.read.parquet(str(tmp_path / "out/rules")).count() == 1
    sinks.write_by_key(p.withColumn("x", F.lit(1)), "context_package_id", str(tmp_path / "keys"))
    assert (tmp_path / "keys/context_package_id=p1").is_dir()
