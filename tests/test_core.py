"""Operators of the core against brute force, on small fixtures with nulls, ties, repeats and empty tables."""

import random
from datetime import datetime
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.functions import dsl, glyphs, quantity
from tracewright.operators import changepoints, concepts, events, hierarchy, references, sequence, structure
from tracewright.session import Scratch


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- references ---------------------------------------------------------------------------------------------------------


def brute(refs, targets, match):
    out = []
    for a, b in refs:
        given = [(i, v) for i, v in enumerate((a, b)) if v is not None]
        if len(given) == 2:
            ok = (a, b) in targets
        elif match == "simple":
            ok = True
        elif match == "full":
            ok = not given
        else:
            ok = not given or any(all(t[i] == v for i, v in given) for t in targets)
        if not ok:
            out.append((a, b))
    return sorted(out, key=repr)


@pytest.mark.parametrize("match", references.MATCHES)
def test_orphans_by_null_mask(spark, match):
    refs = [("a", 1), ("a", 2), ("a", None), ("c", None), (None, 1), (None, 9), (None, None), ("z", 9), ("z", 9)]
    targets = [("a", 1), ("a", 1), ("b", 9), ("b", None)]
    r = spark.createDataFrame(refs, "k string, n int").withColumn("found", F.lit(5)).withColumn("_t0", F.lit(1))
    t = spark.createDataFrame(targets, "tk string, tn int")
    got = references.orphans(r, t, [("k", "tk"), ("n", "tn")], match).select("k", "n")
    assert rows(got) == brute(refs, targets, match)


def test_orphans_empty(spark):
    r = spark.createDataFrame([], "k string")
    t = spark.createDataFrame([], "tk string")
    assert rows(references.orphans(r, t, [("k", "tk")])) == []
    assert rows(references.orphans(spark.createDataFrame([("a",)], "k string"), t, [("k", "tk")])) == [("a",)]


def test_timed_orphans(spark):
    at = lambda d: datetime(2024, 1, d)
    r = spark.createDataFrame([("missing", at(5)), ("late", at(5)), ("deleted", at(5)), ("fine", at(5)), (None, at(5)), ("", at(5))], "k string, seen timestamp_ntz")
    t = spark.createDataFrame([("late", at(6), None), ("deleted", at(1), at(5)), ("fine", at(5), at(6))], "tk string, first_ingested timestamp_ntz, first_deleted timestamp_ntz")
    got = references.timed_orphans(r, t, [("k", "tk")]).select("k", "reason", "period")
    assert rows(got) == [("", "missing", "2024-01"), ("deleted", "deleted", "2024-01"), ("late", "late", "2024-01"), ("missing", "missing", "2024-01")]


def test_json_ids(spark):
    texts = ['["a","b"]', ' [ "a" , null ] ', "[]", '["a"', "", None, '{"a":1}', '"a"', "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(references.json_ids(F.col("t")).alias("ids"))
    assert [r.ids for r in df.collect()] == [["a", "b"], ["a", None], [], None, None, None, None, None, None]


# --- hierarchy ----------------------------------------------------------------------------------------------------------


def climb(parent):
    out = {}
    for x in set(parent) | set(parent.values()):
        seen, y = [], x
        while y in parent and y not in seen:
            seen.append(y)
            y = parent[y]
        if y in seen:
            out[x] = (min(seen[seen.index(y) :]), -1)
        else:
            out[x] = (y, len(seen))
    return sorted((k, *v) for k, v in out.items())


@pytest.mark.parametrize("stride", [4])
def test_hierarchy(spark, stride):
    rng = random.Random(3)
    parent = {f"n{i}": f"n{rng.randrange(i)}" for i in range(1, 30)}
    parent |= {f"c{i}": f"c{(i + 1) % 5}" for i in range(5)} | {"t1": "c3", "t2": "t1", "self": "self", "below": "self"} | {f"l{i}": f"l{i + 1}" for i in range(21)}
    edges = spark.createDataFrame([*parent.items(), *list(parent.items())[:3]], "child string, parent string")
    got = hierarchy.hierarchy(edges, Scratch(spark, "t"), stride=stride, paths=True)
    assert rows(got.select("concept_id", "root_id", "depth")) == climb(parent)
    line = got.where("concept_id = 'l0'").first()
    assert line.path == [f"l{i}" for i in range(21, -1, -1)]
    below = hierarchy.Tree(edges, Scratch(spark, "t"), stride).descendants().where("ancestor = 'l21'").count()
    assert below == 21


def graph_truth(links):
    """(tree rows, ancestor pairs, cycles) of distinct links, by following every way."""
    up = {}
    for c, p in set(links):
        up.setdefault(c, set()).add(p)
    nodes = set(up) | {p for ps in up.values() for p in ps}

    def reach(x):
        seen, stack = set(), list(up.get(x, ()))
        while stack:
            y = stack.pop()
            if y not in seen:
                seen.add(y)
                stack += up.get(y, ())
        return seen

    above = {x: reach(x) for x in nodes}
    on = {x for x in nodes if x in above[x]}
    rows_, pairs = [], []
    for x in nodes:
        cyclic = [y for y in above[x] | {x} if y in on]
        if cyclic:
            rows_.append((x, min(cyclic), -1))
            continue
        level, depth = {x}, 0
        found = set()
        while level:
            for y in level:
                if y not in up:
                    found.add((depth, y))
                if depth and (y, x) not in {(a, d) for a, d, _ in pairs}:
                    pairs.append((y, x, depth))
            level, depth = {p for y in level for p in up.get(y, ())}, depth + 1
        d, r = min(found)
        rows_.append((x, r, d))
    return sorted(rows_), sorted(pairs), sorted((x, min(y for y in above[x] if x in above[y])) for x in on)


@pytest.mark.parametrize("seed", [3])
def test_several_parents_and_cycles(spark, seed):
    rng = random.Random(seed)
    n = 40
    links = [(f"n{i:02d}", f"n{rng.randrange(i):02d}") for i in range(1, n) for _ in range(rng.choice([1, 1, 1, 2]))]
    links += [(f"n{rng.randrange(n // 2, n):02d}", f"n{rng.randrange(n):02d}") for _ in range(seed)] + [("x1", "x2"), ("x2", "x3"), ("x3", "x1"), ("y", "x2"), ("y", "n00"), ("z", "y"), ("s", "s"), ("s", "n01")]
    tree, pairs, cyc = graph_truth(links)
    df = spark.createDataFrame(links, "child string, parent string")
    got = hierarchy.Tree(df, Scratch(spark, "t"), 4, paths=True)
    assert rows(got.rows().select("concept_id", "root_id", "depth")) == tree
    assert rows(got.descendants()) == pairs
    assert rows(hierarchy.cycles(df, Scratch(spark, "t"))) == cyc


def test_cycle_through_a_larger_parent(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "a")], "child string, parent string")
    assert rows(hierarchy.hierarchy(df, Scratch(spark, "t"))) == [("a", "a", -1), ("b", "b", 0), ("c", "a", -1)]
    assert rows(concepts.cycle_free(df, Scratch(spark, "t"))) == [("a", "b"), ("a", "c")]
    with pytest.raises(ValueError, match="cycle"):
        concepts.reduce_transitive(df, Scratch(spark, "t"))


def test_hierarchy_empty_and_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("b", None)], "c string, p string")
    assert rows(hierarchy.hierarchy(hierarchy.links(df, "c", "p"), Scratch(spark, "t"))) == []


# --- quantities ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("raw", "normal", "want"),
    [
        ("≥53,000 ms", None, ("s", "53", "53")), ("0,1千安", None, ("A", "100", "100")), ("830±10°C", None, ("K", "1093.15", "1113.15")), ("1 125‰", None, ("%", "112.5", "112.5")),
        ("4.6e3 bis 6 900 seconds", None, ("s", "4600", "6900")), ("707 华氏度", None, ("K", "648.15", "648.15")), ("9,000", ">9,000 mL/min", ("L/min", "9", "9")), ("二百二十八安", None, ("A", "228", "228")),
        ("between 36 and 54 V", None, ("V", "36", "54")), ("12.6—18,9cm", None, ("mm", "126", "189")), ("5次以上", None, None), ("第3层", None, None), ("5083-H116", None, None), ("1G", None, None), ("30", None, None), (None, "3 A", None), ("", "3 A", None),
        ("1/3", None, None), ("x" * 5000 + " 3 A", None, ("A", "3", "3")), ("0.0000005 mm", None, ("mm", "0", "0")), ("0.0000015 mm", None, ("mm", "0.000002", "0.000002")), ("ｋеpt at ４６ А", None, ("A", "46", "46")),
    ],
)
def test_quantity(raw, normal, want):
    assert quantity.quantity(raw, normal) == want


def test_plain_rounds_half_even():
    assert [quantity.plain(Fraction(n, 2 * 10**6)) for n in (1, 3, 5, -1)] == ["0", "0.000002", "0.000002", "0"]


def test_quantity_column(spark):
    df = spark.createDataFrame([("3 A", None), (None, None), ("无", "无")], "r string, n string")
    assert [r.q and tuple(r.q) for r in df.select(quantity.quantity_column(F.col("r"), F.col("n")).alias("q")).collect()][0] == ("A", "3", "3")


def test_pelt_is_exact():
    rng = random.Random(5)
    for _ in range(30):
        x = [rng.gauss(rng.choice((0, 3)), 0.3) for _ in range(rng.randrange(2, 12))]
        cost = lambda a, b, x=x: sum((v - sum(x[a:b]) / (b - a)) ** 2 for v in x[a:b])
        n = len(x)
        best = min((sum(cost(a, b) for a, b in zip([0, *c], [*c, n], strict=True)) + 0.5 * len(c), c) for c in ([i for i in range(1, n) if m >> i & 1] for m in range(0, 1 << n, 2)))
        assert changepoints.pelt(x, 0.5) == best[1]


def test_unit_shifts(spark):
    data = [("s", "A", datetime(2024, 1, 1 + i // 4, i % 4), f"r{i:03d}", (0.1 if i < 40 else 100.0) * (1 + 0.01 * (i % 3))) for i in range(80)]
    df = spark.createDataFrame([*data, ("s", "A", None, "x", 1.0), ("s", "A", datetime(2024, 1, 1), "y", -1.0)], "source string, kind string, at timestamp_ntz, id string, value double")
    assert [(r.id, r.factor) for r in changepoints.unit_shifts(df).collect()] == [("r040", 0.001)]


@pytest.mark.parametrize("at", [19, 20, 21, 40])
def test_unit_shifts_at_the_edge_of_a_run(spark, at):
    data = [("s", "A", datetime(2024, 1, 1 + i // 4, i % 4), f"r{i:03d}", (0.1 if i < at else 100.0) * (1 + 0.01 * (i % 3))) for i in range(70)]
    df = spark.createDataFrame(data, "source string, kind string, at timestamp_ntz, id string, value double")
    assert [(r.id, r.factor) for r in changepoints.unit_shifts(df, 20).collect()] == [(f"r{at:03d}", 0.001)]


def test_shifts_of_unconverted_numbers(spark, tmp_path):
    from tracewright.queries import problems

    texts = [f"{20 + i % 2} mm" if i < 20 else f"0.0{20 + i % 2} m" for i in range(40)]
    data = [(f"r{i:03d}", "plate", t, datetime(2024, 1, 1, i // 2, 30 * (i % 2))) for i, t in enumerate(texts)]
    data += [(f"b{i:03d}", "rod", str(5 + i % 2) if i < 20 else str(5000 + 1000 * (i % 2)), datetime(2024, 1, 1, i // 2, 30 * (i % 2))) for i in range(40)]
    df = spark.createDataFrame(data, "state_id string, object string, raw_state string, ingested_at timestamp_ntz").withColumn("normalized_state", F.lit(None).cast("string"))
    df.write.parquet(f"{tmp_path}/rule_states.parquet")
    got = {r.id: round(r.factor, 6) for r in problems.p7_shifts(spark, str(tmp_path)).collect()}
    assert got == {"r020": 1000.0, "b020": 0.001}
    back = {r.id: r.reversed for r in problems.p7_reversed(spark, str(tmp_path)).collect()}
    assert len(back) == 80 and abs(back["r039"] - 21) < 1e-6 and abs(back["b038"] - 5) < 1e-6 and back["b000"] == 5


# --- sequences ----------------------------------------------------------------------------------------------------------


def test_carried_equals_one_window(spark):
    rng = random.Random(1)
    data = [(k, i, rng.choice([None, i])) for k in "ab" for i in range(40)]
    df = spark.createDataFrame(data, "k string, pos long, v long")
    got = {(r.k, r.pos): (r.before, r.after) for r in sequence.carried(sequence.carried(df, ["k"], {"before": F.col("v")}, block=7), ["k"], {"after": F.col("v")}, reverse=True, block=7).collect()}
    for k, i, _ in data:
        before = [v for kk, p, v in data if kk == k and p < i and v is not None]
        after = [v for kk, p, v in data if kk == k and p > i and v is not None]
        assert got[k, i] == (before[-1] if before else None, after[0] if after else None)
    total = {(r.k, r.pos): r.s for r in sequence.running(df, ["k"], "s", F.coalesce("v", F.lit(0)), block=7).collect()}
    assert total["a", 39] == sum(v or 0 for k, _, v in data if k == "a")


# --- text, rules, concepts, events --------------------------------------------------------------------------------------


def test_standard_form():
    cases = {"ｗｅlding": "welding", "⽓﻿体": "气体", "112℃": "112°C", "650 µm": "650 μm", "ﬂux": "flux", "Νahtü": "Nahtü", "α相，": "α相，", "I²/(8·π)": "I²/(8·π)", "ü": "ü", "a b": "a b", "": "", "привет": "привет", "干伸⻓": "干伸长"}
    assert {k: glyphs.standard(k) for k in cases} == cases
    assert glyphs.standard(None) is None
    assert all(glyphs.standard(v) == v for v in cases.values())


def test_plain_texts_are_standard(spark):
    texts = ["abc", "焊接电流，", "ｗ", "а", "é", "ü", "", "x\ny", "​", "αφ", "°C ½"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", glyphs.is_plain(F.col("t")).alias("p"))
    assert all(glyphs.standard(r.t) == r.t for r in df.collect() if r.p)


def sides(r):
    pair = lambda v: [(x["object"], x["raw_state"]) for x in v]
    return pair(r["conditions"]), pair(r["antecedents"]), r["relation"], pair(r["consequents"])


def test_rule_language():
    text = """```dsl
规则组1
C: 电阻R|忽略
* **R: 焊接回路|燃弧 —[U=[R+B]I]→ 电压平衡关系|成立**
依据：第 3 页
R: 电流|小 + 保护气体成分|He 90% + Ar 7.5% -> 电流|大 +
  电压=高
---
Rule group b，C: 板厚|3 mm，R: 弧光辐射强烈
R: 板厚|3 mm → 少量气孔
C: 电流|大 ⇒ 熔深|大
```"""
    got = dsl.parse(text, "p")
    assert [(r["group"], r["idx"]) for r in got] == [("group_1", 1), ("group_1", 2), ("group_b", 3), ("group_b", 4), ("group_b", 5)]
    assert [sides(r) for r in got] == [
        ([("电阻R", "忽略")], [("焊接回路", "燃弧")], "U=[R+B]I", [("电压平衡关系", "成立")]),
        ([("电阻R", "忽略")], [("电流", "小"), ("保护气体成分", "He 90% + Ar 7.5%")], None, [("电流", "大"), ("电压", "高")]),
        ([("板厚", "3 mm")], [("板厚", "3 mm")], "陈述", [("弧光辐射强烈", "提及")]),
        ([], [("板厚", "3 mm")], None, [("气孔", "少量")]),
        ([("板厚", "3 mm")], [("电流", "大")], None, [("熔深", "大")]),
    ]
    assert [len(r["transitions"]) for r in got] == [0, 1, 0, 0, 0]
    assert [sides(r)[1:] for r in dsl.parse("规则组\nR: 熔深|大")] == [([("原文上下文", "存在")], "陈述", [("熔深", "大")])]
    assert dsl.parse("无规则") == [] and dsl.parse("R: a|1 =提高=> b|2")[0]["relation"] == "提高"
    for bad in (None, "", "C: a|1", "R: 150 A → 熔深|大", "R: 大 → 熔深|大", "R: |大 → 熔深|大"):
        with pytest.raises(dsl.RuleError):
            dsl.parse(bad)
    assert dsl.display("不低于 20mm") == "≥ 20 mm" and dsl.display("3~5  A") == "3–5 A"


def test_patches():
    draft = "规则组1\nC: a|1\nR: b|1 → c|1\nR: d|1 → e|1\n规则组2\nR: f|1 → g|1"
    full = draft.replace("规则组2\n", "规则组2\nC: 无\n")
    assert dsl.apply_patch(draft, "NO_CHANGES") == full
    assert dsl.addressed(draft).split("\n")[2:4] == ["[1/1] R: b|1 → c|1", "[1/2] R: d|1 → e|1"]
    assert dsl.apply_patch(draft, "DELETE_R 1/1\nSET_C 2\nC: x|1\nADD_R 2\nR: h|1 → i|1") == "规则组1\nC: a|1\nR: d|1 → e|1\n规则组2\nC: x|1\nR: f|1 → g|1\nR: h|1 → i|1"
    assert dsl.apply_patch(draft, "DELETE_R 1/1\nREPLACE_R 1/2\nR: x|1 → y|1\nDELETE_C 1") == full.replace("R: b|1 → c|1\n", "").replace("R: d|1 → e|1", "R: x|1 → y|1").replace("C: a|1", "C: 无")
    assert dsl.apply_patch(draft, "DELETE_R 2/1") == full.split("\n规则组2")[0]
    assert dsl.apply_patch(draft, "DELETE_GROUP 1\nADD_GROUP\n规则组1\nR: n|1 → m|1\nEND_GROUP") == "规则组2\nC: 无\nR: f|1 → g|1\n规则组1\nC: 无\nR: n|1 → m|1"
    assert dsl.apply_patch(draft, "REPLACE_GROUP 2\n规则组2\nC: q|1\nR: n|1 → m|1\nEND_GROUP").endswith("规则组2\nC: q|1\nR: n|1 → m|1")
    assert dsl.apply_patch(draft, "REPLACE_ALL\n无规则\nEND_ALL") == dsl.apply_patch(draft, "DELETE_GROUP 1\nDELETE_GROUP 2") == "无规则"
    for bad in (
        "", "DELETE_R 1/9", "DELETE_R 1", "SET_C 7\nC: x|1", "SET_C 1", "REPLACE_R 1/1\nR: x|1 → y|1\nDELETE_R 1/1", "HELLO", "ADD_GROUP 3\n规则组3\nR: a|1\nEND_GROUP", "ADD_GROUP\n规则组1\nR: a|1\nEND_GROUP", "ADD_GROUP\n规则组3\nR: a|1",
        "REPLACE_ALL\n无规则\nEND_ALL\nDELETE_C 1", "DELETE_GROUP 1\nDELETE_R 1/1", "REPLACE_GROUP 2\n规则组1\nR: a|1\nEND_GROUP",
    ):
        with pytest.raises(dsl.RuleError):
            dsl.apply_patch(draft, bad)
    for broken in ("规则组1\nR: a|1\nC: b|1", "规则组1\n规则组1\nR: a|1", "R: a|1", "规则组1\nC: a|1", "规则组1\nR: a|1\nfree text"):
        with pytest.raises(dsl.RuleError):
            dsl.apply_patch(broken, "NO_CHANGES")


def test_bindings_tell_ambiguity(spark):
    c = spark.createDataFrame([("c1", "气体保护焊", ["GMAW", None]), ("c2", "x", ["共享名"]), ("c3", "y", ["共享 名"])], "concept_id string, canonical_name string, aliases array<string>")
    v = spark.createDataFrame([("gmaw",), ("共享名",), ("数值",), (None,), ("气体保护焊",), ("gmaw",)], "value string")
    got = {r.value: (r.status, r.concept_id, r.method) for r in concepts.bind_exact(v, concepts.names_of(c)).collect()}
    assert got == {"gmaw": ("matched", "c1", "exact_alias"), "共享名": ("ambiguous", None, None), "数值": ("unmatched", None, None), None: ("unmatched", None, None), "气体保护焊": ("matched", "c1", "exact_canonical")}


def test_rank_bands(spark):
    df = spark.createDataFrame([(f"n{i:02d}", 31 - i) for i in range(31)], "name string, n int")
    got = concepts.rank_bands(df, F.col("n"), F.col("name")).groupBy("band").count()
    assert rows(got) == [("HIGH", 1), ("LOW", 25), ("MEDIUM", 5)]


@pytest.mark.parametrize("most", [1000, 0])
def test_cycles_and_reduction(spark, most):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("d", "a"), ("d", "c"), ("e", "f"), ("f", "e")], "child string, parent string")
    acyclic = concepts.cycle_free(e, Scratch(spark, "t"), most)
    assert rows(acyclic) == [("a", "b"), ("a", "c"), ("b", "c"), ("d", "a"), ("d", "c"), ("e", "f")]
    assert rows(concepts.reduce_transitive(acyclic, Scratch(spark, "t"))) == [("a", "b"), ("b", "c"), ("d", "a"), ("e", "f")]


def test_reduction_goes_up_in_strides(spark, monkeypatch):
    # a chain of 41 nodes; the links from n00 to each ninth node and one across are replaced by the chain
    chain = [(f"n{k:02d}", f"n{k + 1:02d}") for k in range(40)]
    extra = [("n00", f"n{k:02d}") for k in (9, 18, 27, 36, 40)] + [("n05", "n23")]
    rounds = []
    append = Scratch.append
    monkeypatch.setattr(Scratch, "append", lambda self, name, part, *rest: rounds.append(part) or append(self, name, part, *rest))
    df = spark.createDataFrame([*chain, *extra], "child string, parent string")
    assert rows(concepts.reduce_transitive(df, Scratch(spark, "t"))) == chain
    assert max(rounds) <= 40 / hierarchy.STRIDE + 1

    rng = random.Random(5)
    links = {(f"v{a:02d}", f"v{b:02d}") for a, b in (sorted(rng.sample(range(60), 2)) for _ in range(110))}
    up = {}
    for c, p in links:
        up.setdefault(c, set()).add(p)

    def reach(x):
        return {p for q in up.get(x, ()) for p in {q, *reach(q)}}

    want = sorted((c, p) for c, p in links if not any(p in reach(q) for q in up[c]))
    assert rows(concepts.reduce_transitive(spark.createDataFrame(sorted(links), "child string, parent string"), Scratch(spark, "t"))) == want


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_reduction_keeps_no_places_above_a_child(spark, most):
    # 400 children hang with two parents each below a chain of 300: 240 000 places above them, of which one link each is replaced
    chain = [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(299)]
    hung = [(f"c{k:03d}", p) for k in range(400) for p in ("n000", "n299")]
    scratch = Scratch(spark, "t")
    got = concepts.reduce_transitive(spark.createDataFrame([*chain, *hung], "child string, parent string"), scratch, most)
    assert rows(got) == sorted([*((c, p) for c, p in hung if p == "n000"), *chain])
    if most:
        written = sum(spark.read.parquet(str(p)).count() for p in Path(scratch.root.removeprefix("file://")).rglob("*.parquet"))
        assert written <= len(chain) + 1.5 * len(hung)


def test_sweeps_against_brute_force():
    for seed in range(60):
        rng = random.Random(seed)
        n = rng.choice([4, 40, 200])
        names = rng.sample(range(n), n)
        links = list({tuple(names[x] for x in sorted(rng.sample(range(n), 2))) for _ in range(rng.choice([3, 100, 600]))})
        up = {}
        for c, p in links:
            up.setdefault(c, set()).add(p)
        known = {}

        def reach(x):
            if x not in known:  # noqa: B023
                known[x] = {p for q in up.get(x, ()) for p in {q, *reach(q)}}  # noqa: B023
            return known[x]  # noqa: B023

        c, p = map(np.array, zip(*links))
        # one word, a few, or all targets at once
        assert concepts._replaced(c, p, n, rng.choice([1, 3 * n, 1 << 24])).tolist() == [any(p in reach(q) for q in up[c]) for c, p in links]
    assert concepts._replaced(np.array([0, 1, 2]), np.array([1, 2, 0]), 3) is None


def test_reduction_of_nothing_and_nulls(spark):
    empty = spark.createDataFrame([], "child string, parent string")
    assert rows(concepts.reduce_transitive(empty, Scratch(spark, "t"))) == []
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c"), ("a", "c"), (None, "a"), ("c", None)], "child string, parent string")
    assert rows(concepts.reduce_transitive(df, Scratch(spark, "t"))) == rows(concepts.reduce_transitive(df, Scratch(spark, "t"), 0)) == sorted([("a", "b"), ("b", "c"), (None, "a"), ("c", None)], key=repr)


def walk(node):
    yield node
    for i in range(node.children().size()):
        yield from walk(node.children().apply(i))


def names(node):
    return {node.output().apply(i).name() for i in range(node.output().size())}


def test_contained_terms_send_no_text_with_its_seeds(spark):
    texts = spark.createDataFrame([("t1", "焊接\n焊接 𠀀𠀁 weld"), ("t2", "w"), ("t3", ""), ("t4", "el")], "text_id string, text string")
    terms = spark.createDataFrame([("a", "焊接"), ("b", "焊接"), ("c", "𠀀𠀁"), ("d", "接\n"), ("e", "el"), ("f", "w"), ("g", "elx")], "term_id string, term string")
    got = concepts.contained_terms(texts, terms)
    assert rows(got) == [("t1", "a", "焊接", 2), ("t1", "b", "焊接", 2), ("t1", "c", "𠀀𠀁", 1), ("t1", "d", "接\n", 1), ("t1", "e", "el", 1), ("t4", "e", "el", 1)]

    seeded = [n for n in walk(got._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join" and all("_g" in names(n.children().apply(i)) for i in range(2))]
    assert seeded
    assert all("text" not in names(n) for n in seeded)
    sent = [n for n in walk(got._jdf.queryExecution().sparkPlan()) if "BroadcastHashJoin" in n.nodeName() and "text" in names(n.children().apply(1))]
    assert not sent


def test_evidence_ranks_each_name_once_and_broadcasts_no_text(spark, tmp_path):
    from tracewright.queries import knowledge

    at = datetime(2024, 1, 1)
    units = [(f"u{k:02d}", "title" if k == 29 else "passage", "焊缝包括 weld" if k == 28 else "a weld", at, None) for k in range(30)]
    spark.createDataFrame(units, "id string, type string, content string, ingested_at timestamp, deleted_at timestamp").write.parquet(f"{tmp_path}/units.parquet")
    spark.createDataFrame([("c1", "weld", "APPROVED", at), ("c2", "weld", "Approved", at), ("c3", "weld", None, at)], "concept_id string, canonical_name string, registration_status string, ingested_at timestamp").write.parquet(f"{tmp_path}/concepts.parquet")
    got = knowledge.evidence_topk(spark, str(tmp_path))
    order = [("u28", 70), ("u29", 65), *[(f"u{k:02d}", 45) for k in range(22)]]
    assert rows(got) == [(c, u, n, rank) for c in ("c1", "c2") for u, n, rank in sorted((u, n, k + 1) for k, (u, n) in enumerate(order))]
    plan = list(walk(got._jdf.queryExecution().sparkPlan()))
    assert not [n for n in plan if "BroadcastHashJoin" in n.nodeName() and "text" in names(n.children().apply(1))]
    ranked = [n for n in plan if n.nodeName() == "Window"]
    assert ranked
    assert all("term_id" not in names(n) for n in ranked)


def test_memory_fold(spark):
    log = spark.createDataFrame([(1, "approve", "t", None, "电弧"), (2, "approve", "s", None, "弧光"), (3, "merge", "s", "t", None), (4, "reject", "x", None, None)], "seq long, kind string, concept_id string, target_id string, name string")
    got = {r.concept_id: (r.status, r.aliases, r.merged_into) for r in events.fold_memory(log, Scratch(spark, "t")).collect()}
    assert got == {"t": ("REGISTERED", ["弧光", "电弧"], None), "s": ("MERGED", None, "t"), "x": ("REJECTED", [], None)}


def test_memory_follows_chains_and_cuts_circles(spark):
    names = [f"m{k:03d}" for k in range(91)]
    log = [(k, "merge", a, b, None) for k, (a, b) in enumerate(zip(names, names[1:], strict=False), 200)] + [(k, "approve", n, None, n) for k, n in enumerate([*names, "x", "y"])] + [(500, "merge", "x", "y", None), (501, "merge", "y", "x", None)]
    df = spark.createDataFrame(log, "seq long, kind string, concept_id string, target_id string, name string")
    got = {r.concept_id: (r.merged_into, r.aliases) for r in events.fold_memory(df, Scratch(spark, "t")).collect()}
    assert {got[n][0] for n in names[:-1]} == {"m090"} and got["m090"] == (None, names) and got["x"][0] == "y" and got["y"] == (None, ["x", "y"])


def test_sections_of_any_depth(spark):
    titles = ["第1章 a", "1.1 b", "1.1.1 c", "1.1.1.1 d", "1.1.1.1.1 e", "text", "1.1.2 f", "text"]
    df = spark.createDataFrame([("d", k, f"u{k}", t) for k, t in enumerate(titles)], "doc_id string, pos long, id string, content string")
    got = structure.section_path(df, structure.heading_level(F.col("content")), F.col("content")).orderBy("pos").collect()
    assert got[5].section_path == titles[:5] and got[7].section_path == ["第1章 a", "1.1 b", "1.1.2 f"]


def test_a_pack_of_many_patterns(spark):
    units = spark.createDataFrame([("u", "passage", "a b c")], "id string, type string, content string")
    rows_ = [(f"p{k}", "g", "keyword", "b" if k % 500 == 0 else "zzz", 1, 99, []) for k in range(1200)]
    pack = spark.createDataFrame(rows_, "pattern_id string, `group` string, kind string, expr string, min_length int, max_length int, types array<string>")
    assert [r.pattern_id for r in structure.pattern_matches(units, pack).orderBy("pattern_id").collect()] == ["p0", "p1000", "p500"]


def test_dyadic_blocks_cover_intervals_once(spark):
    rng = random.Random(4)
    spans = [(a, a + rng.randrange(200)) for a in (rng.randrange(300) for _ in range(40))] + [(0, 0), (5, 4)]
    df = spark.createDataFrame(spans, "s long, e long").select("s", "e", structure.blocks_of(F.col("s"), F.col("e")).alias("b"))
    for r in df.collect():
        assert sorted(p for x in r.b for p in range(x.b << x.k, (x.b + 1) << x.k)) == list(range(r.s, r.e + 1))
        assert len(r.b) <= 18


def test_bins(spark):
    df = spark.createDataFrame([("HIGH", 9 - i, f"c{i}", 10) for i in range(5)], "tier string, frequency int, id string, size int")
    assert [r.bin for r in concepts.pack_bins(df, 3, 25).orderBy("id").collect()] == [0, 0, 1, 1, 2]
