"""Operators for training data against brute force, on small fixtures with nulls, ties, repeats and empty tables."""

import random
import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.functions import glyphs
from tracewright.functions.glyphs import standard
from tracewright.llm import boost, bpe, canonical, groups, leaks, lookalikes, quality, scans
from tracewright.session import Scratch


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- canonical list -----------------------------------------------------------------------------------------------------

ENTRIES = [("c1", "焊接电流"), ("c1", "welding current"), ("c1", "Schweißstrom"), ("c2", "焊缝熔深"), ("c2", "penetration depth"), ("c3", "post weld heat treatment"), ("c3", "PWHT"), ("c4", "plate"), ("c4", " plate "), ("c5", None), ("c6", "钝边高度"), ("c7", "twin name"), ("c8", "twin name")]
VALUES = {
    "焊接电流": "c1", "  焊接电流。": "c1", "捍接电流": "c1", "焊接流电": "c1", "焊接电流值": "c1", "该焊接电流": "c1", "welding-current": "c1", "wel​ding current": "c1", "ｗelding curent": "c1", "current, welding": "c1", "weld. current": "c1", "welding cu rrent": "c1",
    "the Schweisstrom No.1": "c1", "焊接电流(welding current)": "c1", "焊接电流/Schweißstrom": "c1", "Pwht": "c3", "pwth": "c3", "penetration depth*": "c2", "焊 缝熔深": "c2",
    "welding current transformer": None, "焊接电流 plate": None, "it": None, "": None, "  ": None, None: None, "???": None, "轻载标尺4号": None, "welding": None, "twin name": None, "x" * 3000: None,
}


def test_map_to_list(spark):
    values = spark.createDataFrame([(v,) for v in [*VALUES, "焊接电流"]], "value string").withColumn("name", F.lit("clash"))
    entries = spark.createDataFrame(ENTRIES, "entry_id string, name string").withColumn("value", F.lit(1))
    got = {r.value: r.entry_id for r in canonical.map_to_list(values, entries, Scratch(spark, "t")).collect()}
    assert got == {k: v for k, v in VALUES.items() if k is not None}


def test_map_to_list_keeps_figures_and_exact_names(spark):
    entries = spark.createDataFrame([("t2", "type 2 weld"), ("t3", "type 3 weld"), ("arc", "the arc"), ("p", "plate")], "entry_id string, name string")
    want = {"type 2 weld": "t2", "type 3 weld": "t3", "TYPE 3 wedl": "t3", "the arc": "arc", "arc": "arc", "plate 7": None, "plate No.7": "p", "the": None, "type weld": None}
    got = {r.value: r.entry_id for r in canonical.map_to_list(spark.createDataFrame([(v,) for v in want], "value string"), entries, Scratch(spark, "t")).collect()}
    assert got == want


def test_incomplete_names_are_ranked(spark):
    entries = spark.createDataFrame([("a", "tungsten arc torch"), ("b", "plasma arc torch"), ("c", "arc length")], "entry_id string, name string")
    values = spark.createDataFrame([("tungsten torch",), ("arc torch",), ("plasma arc",)], "value string")
    got = {r.value: r.entry_id for r in canonical.map_to_list(values, entries, Scratch(spark, "t"), cover=0.6).collect()}
    assert got == {"tungsten torch": "a", "arc torch": None, "plasma arc": "b"}


def test_map_to_list_empty(spark):
    none = spark.createDataFrame([], "value string")
    entries = spark.createDataFrame(ENTRIES, "entry_id string, name string")
    assert rows(canonical.map_to_list(none, entries, Scratch(spark, "t"))) == []
    one = spark.createDataFrame([("a word",)], "value string")
    assert [r.entry_id for r in canonical.map_to_list(one, entries.limit(0), Scratch(spark, "t")).collect()] == [None]


def edits(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_near_terms_lose_none(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(3, 9))) for _ in range(25)]
    terms = ["".join(rng.choice("abc") for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    w = spark.createDataFrame([(x,) for x in words], "word string")
    got = {r.term for r in canonical.near_terms(spark.createDataFrame([(x,) for x in terms], "term string"), w, Scratch(spark, "t")).collect()}
    assert got == {t for t in terms if any(edits(t, x) <= 1 for x in words)}


# --- groups -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_groups(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"a{rng.randrange(60):02d}", f"a{rng.randrange(60):02d}") for _ in range(45)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)] + [("hub", f"s{i}") for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted((x, find(x)) for x in root)
    df = spark.createDataFrame([*pairs, *pairs[:5], ("z", None), (None, "z"), ("y", "y")], "l string, r string").withColumn("v", F.lit(1)).withColumn("c", F.lit(1))
    assert rows(groups.match_groups(df, "l", "r", Scratch(spark, "t"))) == want


def test_groups_empty(spark):
    assert rows(groups.match_groups(spark.createDataFrame([(None, "a")], "l string, r string"), "l", "r", Scratch(spark, "t"))) == []


# --- look-alikes --------------------------------------------------------------------------------------------------------


def test_nonstandard(spark):
    texts = ["abc", "ａbc", "abс", "é", "é", None, "", "a​b", "ab", "干伸⻓", "x" * 5000 + "ﬂ"]
    df = spark.createDataFrame([("t", str(i), "f", x, 1) for i, x in enumerate([*texts, "ａbc"])], "ref_table string, record_id string, ref_field string, text string, canonical int")
    got = {(r.record_id, r.canonical) for r in lookalikes.nonstandard(df).collect()}
    assert got == {(str(i), standard(x)) for i, x in enumerate([*texts, "ａbc"]) if x is not None and standard(x) != x}
    classes = {r.text: r.canonical for r in lookalikes.canonical_forms(df.select("text")).collect()}
    assert classes["ａbc"] == classes["abc"] == classes["abс"] == "abc"
    assert classes["é"] == "é" and "e" not in classes


def test_plain_characters_differ_under_the_collation(spark):
    chars = [chr(c) for c in range(0x9, 0x10000) if not 0xD800 <= c < 0xE000 and re.match(glyphs.PLAIN, chr(c))]
    df = spark.createDataFrame([(c,) for c in chars], "c string").select(F.collate("c", lookalikes.COLLATION).alias("k"))
    assert df.distinct().count() == len(chars)
    assert df.where("k = collate('', 'UNICODE')").isEmpty()


def test_the_class_decides(spark):
    # a sign that the mapping keeps and the collation ignores: the clean member of the class stands for both
    texts = ["ab\U000e0041c", "abc", "x\U000e0041y"]
    df = spark.createDataFrame([("t", str(i), "f", x) for i, x in enumerate(texts)], "ref_table string, record_id string, ref_field string, text string")
    assert [standard(x) for x in texts] == texts
    assert {(r.record_id, r.canonical) for r in lookalikes.nonstandard(df).collect()} == {("0", "abc")}


# --- encoding -----------------------------------------------------------------------------------------------------------


def test_encoding_equals_tiktoken(spark):
    tiktoken = pytest.importorskip("tiktoken")
    coder = bpe.encoder()
    own = tiktoken.Encoding("own", pat_str=coder.split.pattern, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["", " ", "\n\n  x", "<|endoftext|>", "焊接电流为3.2A，", "Schweißen isn't 12345", "a" * 5000, "熔池" * 3000, "\U0001f600é​", *["".join(rng.choice("abet héß焊接 \n.1") for _ in range(rng.randrange(200))) for _ in range(60)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in df.select("doc_id", bpe.encode_column(F.col("text")).alias("ids")).collect()}
    assert got == {i: own.encode_ordinary(t) if t else [] for i, t in enumerate([*texts, None])}


def test_every_character_of_a_context_is_a_candidate(spark):
    seen = {"他": 1, "池": 60, "炉": 90}
    grams = {n: spark.createDataFrame([(k, seen, "炉")], f"k_{n} string, m_{n} map<string,long>, top_{n} string") for n, k in (("mid", "熔的"), ("left", "看熔"), ("right", "的光"))}
    got = scans.han_features(spark.createDataFrame([("看熔他的光",)], "w string"), grams)
    assert sorted(r.cand for r in got.collect()) == sorted("池炉")


# --- leaks --------------------------------------------------------------------------------------------------------------

WORDS = "the arc weld pool current slowly wanders over a plate while gas flow keeps its value and heat drops near every edge until cooling ends".split()


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(9, 15))).capitalize() + "."


def test_leaks(spark):
    rng = random.Random(6)
    items = {i: [sentence(rng) for _ in range(6)] for i in range(5)}
    lead = "Read the passage below and answer the question."
    own = lambda k: [sentence(rng) for _ in range(k)]
    changed = [s.replace("e", "E").replace(" ", "  ", 2).replace(".", " .", 1) for s in items[1]]
    docs = {
        1: own(3) + items[0] + own(3), 2: own(2) + changed[:4], 3: own(4) + items[2][:1] + own(3), 4: own(5) + [lead], 5: [x for s in items[3][:4] for x in (s, sentence(rng))],
        6: [s.replace("the", "tha", 1) for s in items[4]], 7: [], 8: items[2][:2] + own(4),
    }
    d = [(k, "\n\n".join(" ".join(v[i : i + 3]) for i in range(0, len(v), 3))) for k, v in docs.items()]
    df = spark.createDataFrame([*d, d[0], (9, None), (10, "  ")], "doc_id long, text string").withColumn("item_id", F.lit(1))
    it = spark.createDataFrame([(i, lead + " " + " ".join(v) + " What follows from this?") for i, v in items.items()] + [(99, None), (98, "")], "item_id long, text string")
    got = leaks.leaks(df.select("doc_id", "text"), it, Scratch(spark, "t"))
    assert rows(got.select("doc_id", "item_id")) == [(1, 0), (2, 1), (5, 3), (6, 4)]


def test_windows_meet_for_small_edits():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdefghij") for _ in range(160)) for _ in range(200)]
    near = [s[:40] + "z" + s[41:120] + s[121:] for s in base]

    def keys(texts):
        h, text, _, _ = leaks.windows(*leaks._codes(texts))
        return [set(h[text == k]) for k in range(len(texts))]

    a, b = keys(base), keys(near)
    met = np.mean([bool(x & y) for x, y in zip(a, b, strict=True)])
    far = np.mean([bool(x & y) for x, y in zip(a, b[1:] + b[:1], strict=True)])
    assert met > 0.98 and far < 0.05


def test_copies_of_an_item_keep_their_passages(spark):
    rng = random.Random(26)
    one, other = [sentence(rng) for _ in range(6)], [sentence(rng) for _ in range(6)]
    items = [(k, " ".join(one[:5] + [sentence(rng)])) for k in range(4)] + [(9, " ".join(other))]
    got = leaks.leaks(spark.createDataFrame([(1, " , ".join(one[:5])), (2, other[0])], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "t"))
    assert rows(got.select("doc_id", "item_id")) == [(1, 0), (1, 1), (1, 2), (1, 3)]


def test_leaks_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    it = spark.createDataFrame([(1, "One two three four. Five six seven eight.")], "item_id long, text string")
    assert rows(leaks.leaks(none, it, Scratch(spark, "t"))) == []
    assert rows(leaks.leaks(spark.createDataFrame([(1, "x")], "doc_id long, text string"), it.limit(0), Scratch(spark, "t"))) == []


def test_leaks_need_no_sentence_marks(spark):
    rng = random.Random(16)
    items = {i: [sentence(rng) for _ in range(6)] for i in range(3)}
    docs = [(1, " ; ".join(s.rstrip(".") for s in items[0])), (2, " ".join(items[1]).replace(" ", "\n\n")), (3, items[2][0] + " " + " ".join(sentence(rng) for _ in range(6)))]
    it = spark.createDataFrame([(i, " ".join(v)) for i, v in items.items()], "item_id long, text string")
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), it, Scratch(spark, "t"))
    assert rows(got.select("doc_id", "item_id")) == [(1, 0), (2, 1)]


def test_semiglobal_is_exact():
    rng = random.Random(3)
    held = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 150))) for _ in range(12)]
    texts = ["".join(rng.choice("abcdZ") for _ in range(rng.randrange(0, 200))) for _ in range(5)]
    codes, edges = leaks._codes(texts)
    who, at = np.repeat(np.arange(12), 5), np.tile(np.arange(5), 12)

    def slow(s, t):
        last = [0] * (len(t) + 1)
        for i, x in enumerate(s, 1):
            row = [i]
            for j, y in enumerate(t, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return min(last)

    assert leaks.semiglobal(codes, edges[at], edges[at + 1], held, who).tolist() == [slow(held[i], texts[j]) for i, j in zip(who, at, strict=True)]


@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.2])
@pytest.mark.parametrize("letters, run, size", [("焊接电流熔池板材喷嘴弧压气体速度", 2, 30), ("abcdefghijklmnop", 6, 90)])
def test_leaks_recall(share, letters, run, size):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [[text(size) for _ in range(6)] for _ in range(100)]

    def changed(s):
        at = rng.sample(range(size // run), int(size * share) // run)
        return "".join(text(run) if i in at else s[i * run : (i + 1) * run] for i in range(size // run))

    held = leaks.Held(np.repeat(np.arange(100), 6), [s for v in items for s in v])
    at, who = held.find([" ".join(map(changed, v[:3])) for v in items])
    found = np.bincount(at[held.items[who] == at], minlength=100)
    assert np.mean(found == 3) >= 0.98


# --- quality ------------------------------------------------------------------------------------------------------------


def test_kinds(spark):
    rng = random.Random(8)
    prose = [(i, "en", " ".join(sentence(rng) for _ in range(8))) for i in range(40)]
    cases = {
        101: ("list", "Parts:\n- root face\n- arc voltage 3 V\n- gas flow rate\n- undercut"), 102: ("table", "| a | b |\n|---|---|\n| X-1 | 3.2 |\n| X-2 | 4.2 |"), 103: ("junk", "root face " * 60), 104: ("junk", "Home | Index\n" * 9),
        105: ("table", "a;b;c\nX;1;2\nY;3;4\nZ;5;6"), 106: (None, sentence(rng) * 3 + "\n" + "- root face\n- undercut"), 107: (None, ""), 108: (None, None), 109: (None, " \n\t"), 110: ("list", "1.1 Intro ........ 3\n1.2 Arc ........ 7\n2 Gas ........ 12"), 111: ("junk", "Zx9/" * 400),
        112: ("junk", "Das Rühren für die Nähte bleibt gleich. Es ändert sich kaum etwas.".encode().decode("latin-1")), 113: (None, "Das Rühren für die Nähte bleibt gleich, so â. Es ändert sich kaum etwas."), 114: (None, "The arc<|endoftext|> wanders over a plate while gas flow keeps its value."),
    }
    docs = spark.createDataFrame([*prose, *[(k, "en", t) for k, (_, t) in cases.items()], prose[0]], "doc_id long, lang string, text string").withColumn("kind", F.lit(1))
    words = spark.createDataFrame([("en", "the"), ("en", None), (None, "x")], "lang string, word string")
    stats = Scratch(spark, "t").table("stats", quality.statistics(docs, words))
    got = dict(rows(quality.kinds(quality.scored(stats, quality.distributions(stats))).distinct()))
    assert got == {k: v for k, (v, _) in cases.items() if v}
    one = stats.where("doc_id = 101").first()
    assert one.word_count == 11 and one.end_punctuation_share == 0 and one.common_word_share == 0
    assert stats.where("doc_id = 108").first().word_count is None


def test_quality_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    stats = quality.statistics(docs, spark.createDataFrame([], "lang string, word string"))
    assert rows(quality.kinds(quality.scored(stats, quality.distributions(stats)))) == []


def test_sketch_quantiles(spark):
    df = spark.range(20000).select(F.lit("en").alias("language"), F.col("id").alias("word_count"), *[(F.col("id") / 20000).alias(s) for s in quality.STATISTICS[1:]]).where("word_count > 0")
    d = quality.distributions(df).first()
    assert abs(d["prose_share"]["p50"] - 0.5) < 0.02 and abs(d["prose_share"]["p95"] - 0.95) < 0.02


# --- scans --------------------------------------------------------------------------------------------------------------


def test_scan_noise(spark):
    rng = random.Random(9)
    clean = [" ".join(sentence(rng) for _ in range(3)) for _ in range(60)]
    clean[1] = clean[1].replace(" ", "\n", 1)
    texts = dict(enumerate(clean))
    texts[100] = clean[0].replace("e ", "e-\nx ", 0) + " The cur-\nrent drops."
    texts[101] = "Notes on gas\n" + clean[2]
    texts[102] = clean[3] + "\n- 7 -"
    texts[103] = clean[4].replace("current", "c1irrent").replace("plate", "p1ate") + " The currcnt wanders."
    texts[104] = clean[5] + " The range is 93-\n130 A."
    texts[105] = clean[6] + "\nNOTES ON GAS   8"
    texts[106] = "Notes on gas\n" + clean[7]
    at = datetime(2024, 1, 1)
    src = "struct<page:int,bbox:array<double>,original_block_id:string,asset_path:string>"
    data = [(f"u{k}", "b1", "passage", (5 if k != 105 else 6,) + (None,) * 3, v, at) for k, v in texts.items()]
    data += [("u200", "b1", "passage", (2, None, None, None), None, at), ("u201", "b1", "passage", (2, None, None, None), " ", at), ("u202", "b1", "title", (1, None, None, None), "Chapter 1", at), data[0], ("u203", "b1", "passage", None, "x" * 4000, at)]
    units = spark.createDataFrame(data, f"id string, doc_id string, type string, source {src}, content string, ingested_at timestamp_ntz")
    reading = scans.Reading(units, Scratch(spark, "t"))
    assert rows(reading.noise()) == [("u100", "hyphen"), ("u101", "header"), ("u102", "pageno"), ("u103", "charerr"), ("u105", "header"), ("u105", "pageno"), ("u106", "header")]
    text = {r.unit_id: r.text for r in reading.repaired().collect()}
    assert "The current drops" in text["u100"] and text["u101"] == clean[2] and text["u102"] == clean[3] and "The current wanders" in text["u103"]


def test_page_numbers_of_any_length(spark):
    df = spark.createDataFrame([("u", "d", 10234, "text of a line\n10234\n12345678901234"), ("v", "d", None, "x" * 200 + "  10235")], "unit_id string, doc_id string, page int, content string")
    got = {(r.unit_id, r.k): (r.number, r.bare) for r in scans.lines(df).collect()}
    assert got == {("u", 0): (None, False), ("u", 1): (10234, True), ("u", 2): (None, True), ("v", 0): (10235, False)}


def test_boosted_trees_learn_and_agree_with_column(spark):
    rng = np.random.RandomState(0)
    x = rng.rand(600, 3)
    y = (x[:, 0] + x[:, 1] > 1).astype(float)
    model = boost.fit(x, y, trees=40, depth=2)
    held = rng.rand(300, 3)
    assert np.mean((boost.score(model, held) > 0) == (held[:, 0] + held[:, 1] > 1)) > 0.9
    df = spark.createDataFrame(held[:20].tolist(), "a double, b double, c double")
    got = [r.z for r in df.select(boost.column(model, F.array("a", "b", "c")).alias("z")).collect()]
    assert np.allclose(got, boost.score(model, held[:20]))
