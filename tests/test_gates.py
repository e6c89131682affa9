"""Gates and the stateful package stream."""

from pyspark.sql import functions as F

from tracewright.operators import gates
from tracewright.streaming.states import package_states


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_violations_of_unknowns(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", -1)], "id string, n int")
    assert rows(gates.violations(df, F.col("id"), {"positive": F.col("n") > 0})) == [("b", "positive"), ("c", "positive")]


def test_answers(spark):
    cases = spark.createDataFrame([(c, ["x", "y"], ["u1"]) for c in "abcdef"], "case_id string, candidates array<string>, evidence array<string>")
    replies = spark.createDataFrame(
        [("a", "BIND", ["x"], ["u1"]), ("b", "BIND", ["x", "y"], []), ("c", "CREATE", [], ["u9"]), ("d", "BIND", ["z"], None), ("e", "BIND", ["x"], []), ("e", "BIND", ["x"], [])],
        "case_id string, decision string, target_ids array<string>, evidence_ids array<string>",
    )
    got = rows(gates.answers(cases, replies, ("BIND", "REWRITE", "CREATE", "DISCARD")))
    assert got == [("b", "target_count"), ("c", "evidence_was_given"), ("d", "targets_are_candidates"), ("e", "one_reply"), ("f", "known_decision"), ("f", "one_reply")]


def test_admission_ladder(spark):
    cases = spark.createDataFrame([("1", "Arc", "HIGH", "ACCEPT", [True]), ("2", "arc", "HIGH", "ACCEPT", [True]), ("3", "b", "LOW", "ACCEPT", [True]), ("4", "c", "HIGH", "ACCEPT", [True, None]), ("5", "d", "HIGH", "REJECT", [True])], "concept_id string, name string, band string, decision string, checks array<boolean>")
    terms = spark.createDataFrame([("arc", "1")], "term string, concept_id string")
    got = {r.concept_id: r.reason for r in gates.admitted(cases, terms).collect()}
    assert got == {"1": None, "2": "name_taken", "3": "band", "4": "checks", "5": "rejected"}


def test_gold(spark):
    gold = spark.createDataFrame([("s1", None, "A"), ("s2", "r", "B"), ("s3", "r", "C")], "id string, role string, v string")
    predicted = spark.createDataFrame([("s1", None, "A"), ("s2", "r", "X")], "id string, role string, v string")
    assert tuple(gates.gold_metrics(gold, predicted, ["id", "role"], "v").first()) == (3, 2, 1, 0.3333)
    assert gates.gold_metrics(gold.limit(0), predicted, ["id"], "v").first().accuracy == 1.0


def test_package_states(spark, tmp_path):
    steps = [("p", s) for s in ("queued", "generating", "reflecting", "parsing", "success", "failed", "queued")] + [("q", s) for s in ("generating", "queued", "failed")]
    spark.createDataFrame([(p, i, s) for i, (p, s) in enumerate(steps)], "package_id string, seq long, status string").coalesce(1).write.parquet(str(tmp_path / "log"))
    got = rows(package_states(spark, str(tmp_path / "log")).select("package_id", "status", "attempts", "refused"))
    assert got == [("p", "queued", 2, 1), ("q", "failed", 1, 1)]
