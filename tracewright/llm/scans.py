"""Noise in text from scanned pages: divided words, misread characters, running heads and page numbers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.glyphs import standard
from tracewright.llm import boost
from tracewright.session import Scratch

#: Marks that divide a word at a line's end.
HYPHENS = "-‐‑¬–"
#: Labelled examples a classifier is fitted on; half of them are made by spoiling clean text.
SAMPLE = 8_000
#: A correction must be at least so many times as frequent as what stands there.
DOMINANCE = 20
#: Decimal logarithm of the least ratio of a candidate to a character in each context that has the character more than twice.
LEAST_RATIO = 0.78
SEED = 11

_PAGE = re.compile(r"^(?:[-–—·\[(|]\s*|page\s+|seite\s+|s\.\s*|p\.\s*|第\s*)?(\d+|[ivxlc]{1,9})(?:\s*[-–—·\])|]|\s*页)?(?:\s*(?:/|of|von)\s*\d{1,5})?$", re.IGNORECASE)
_LEAD = re.compile(r"^(\d+)\s{2,}(?=\S)")
_TRAIL = re.compile(r"(?<=\S)\s{2,}(\d+)$")
_STOPS = re.compile(r"[。！？；，、：,;:!?”\"’）)】》]\s*$|\.\s*$|[。！？]|[.!?]\s+[A-ZÄÖÜ]")
_LETTER = re.compile(r"[^\W\d_]+")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def _number(text: str) -> int | None:
    """The value of a page number; no book has a thousand million pages."""
    if text.isdigit():
        return int(text) if len(text) < 10 else None
    total, most = 0, 0
    for c in reversed(text.lower()):
        n = _ROMAN[c]
        total += n if n >= most else -n
        most = max(most, n)
    return total


def _key(line: str) -> str:
    """The letters of a line in one case, without blanks and figures."""
    return "".join(_LETTER.findall(line)).casefold()


_LINES = "unit_id string, doc_id string, page int, k int, n int, line string, key string, affix string, number int, bare boolean, headish boolean, range_before boolean, divides boolean, continues boolean"


def lines(units: DataFrame) -> DataFrame:
    """The lines of each unit (unit_id, doc_id, page, content) in standard form, with what line-pair rules look at."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for unit, doc, page, content in zip(pdf["unit_id"], pdf["doc_id"], pdf["page"], pdf["content"], strict=True):
                text = standard(content.replace("\r\n", "\n").replace("\r", "\n"))
                each = [x.strip() for x in text.split("\n")]
                each = [x for x in each if x]
                for k, line in enumerate(each):
                    number, bare, head = None, False, line
                    if m := _PAGE.match(line):
                        number, bare = _number(m.group(1)), True
                    elif m := _LEAD.search(line) or _TRAIL.search(line):
                        number = _number(m.group(1))
                        head = (line[: m.start()] + line[m.end() :]).strip()
                    key = _key(head)
                    words = head.split()
                    spaced = len(words) > 3 and all(len(w) == 1 for w in words)
                    first = key[-4:] if re.search("[一-鿿]", head) else (words[0].casefold() if words and not spaced else key[:5])
                    if re.match(r"^第\s*[\d一二三四五六七八九十]+\s*章", head):
                        first = "第章"
                    headish = not bare and 4 <= len(key) and not _STOPS.search(head)
                    before = each[k - 1] if k else ""
                    rows.append(
                        (unit, doc, None if pd.isna(page) else int(page), k, len(each), line, key, first, number, bare, headish, bool(re.search(r"\d\s*[-–—~至到]$", before)), len(line) > 1 and line[-1] in HYPHENS and line[-2].isalpha(), line[0].isalpha())
                    )
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _LINES.split(", ")])
            yield out.astype({"page": "Int64", "number": "Int64"})

    return units.where("content is not null").select("unit_id", "doc_id", "page", "content").mapInPandas(split, _LINES)


def furniture(marked: DataFrame, titles: DataFrame, scratch: Scratch) -> DataFrame:
    """(unit_id, k, is_header, is_number) of lines that are running heads or printed page numbers.

    A running head is a line of its own that equals (but for case, blanks, figures and a misread character) a title of the
    book, or the line that the book repeats by far most often; a line that begins or ends as most such heads do is one as
    well where its book has too few to tell. A page number is a line of its own, or stands at a head's side, and agrees with
    the page of the scan by the offset that the book's numbers have in common; the end of a range of figures is none.
    ``titles`` has doc_id and key. Everything is joined by (book, key) or aggregated by book.
    """
    heads = marked.where("headish")
    known = titles.select("doc_id", "key").where(F.length("key") >= 4).distinct()
    counts = heads.join(known, ["doc_id", "key"], "left_anti").groupBy("doc_id", "key").agg(F.countDistinct("unit_id").alias("n"), F.first("affix").alias("affix"))
    ranked = counts.groupBy("doc_id").agg(F.max_by("key", F.struct("n", "key")).alias("key"), F.max("n").alias("most"), F.max_by("affix", F.struct("n", "key")).alias("affix"))
    second = counts.join(ranked.select("doc_id", F.col("key").alias("_top")), "doc_id").where("key <> _top").groupBy("doc_id").agg(F.max("n").alias("next"))
    repeated = ranked.join(second, "doc_id", "left").where((F.col("most") >= 3) & (F.col("most") >= 3 * F.coalesce("next", F.lit(0))))
    known = scratch.table("heads", known.unionByName(repeated.select("doc_id", "key")).distinct())
    exact = heads.join(known, ["doc_id", "key"], "left_semi").select("unit_id", "k")
    # what heads of all books have in common, if hardly any other line has it
    by_affix = heads.join(known.withColumn("_is", F.lit(1)), ["doc_id", "key"], "left").groupBy("affix").agg(F.count("*").alias("n"), F.sum(F.coalesce("_is", F.lit(0))).alias("yes"), F.countDistinct(F.when(F.col("_is") == 1, F.col("doc_id"))).alias("books"))
    typical = by_affix.where("books >= 2 and yes >= 0.5 * n").select("affix")
    alike = heads.join(typical, "affix", "left_semi").select("unit_id", "k")
    # one misread character: the same beginning or end, and a small edit distance
    ends = lambda c: F.array(F.concat(F.lit("^"), F.substring(c, 1, 4)), F.concat(F.lit("$"), F.substring(c, -4, 4)))
    probes = heads.select("unit_id", "k", "doc_id", F.col("key").alias("_line"), F.explode(ends(F.col("key"))).alias("e"))
    targets = known.select("doc_id", "key", F.explode(ends(F.col("key"))).alias("e"))
    near = probes.join(targets, ["doc_id", "e"]).where((F.abs(F.length("_line") - F.length("key")) <= 2) & (F.levenshtein("_line", "key") <= F.greatest(F.lit(1), F.floor(F.length("key") / 8)).cast("int"))).select("unit_id", "k")
    is_head = exact.union(alike).union(near).distinct().withColumn("is_header", F.lit(True))
    numbered = marked.where("number is not null").join(is_head, ["unit_id", "k"], "left").where("bare or is_header")
    offsets = numbered.where("page is not null").groupBy("doc_id", (F.col("number") - F.col("page")).alias("offset")).agg(F.count("*").alias("n"))
    usual = offsets.groupBy("doc_id").agg(F.max_by("offset", F.struct("n", -F.col("offset"))).alias("offset"))
    fits = F.col("page").isNull() | F.col("offset").isNull() | (F.col("number") == F.col("page") + F.col("offset"))
    is_number = numbered.join(usual, "doc_id", "left").where(fits & ~F.col("range_before")).select("unit_id", "k").distinct().withColumn("is_number", F.lit(True))
    both = is_head.join(is_number, ["unit_id", "k"], "full")
    return scratch.table("furniture", both.select("unit_id", "k", F.coalesce("is_header", F.lit(False)).alias("is_header"), F.coalesce("is_number", F.lit(False)).alias("is_number")))


def divided(marked: DataFrame, fixed: DataFrame) -> DataFrame:
    """(unit_id, k): lines that end within a word, once furniture between lines is taken away."""
    body = marked.join(fixed.select("unit_id", "k"), ["unit_id", "k"], "left_anti").select("unit_id", "k", "divides", "continues")
    after = Window.partitionBy("unit_id").orderBy("k")
    return body.withColumn("_next", F.lead("continues").over(after)).where("divides and _next").select("unit_id", "k")


def paragraphs(marked: DataFrame, fixed: DataFrame) -> DataFrame:
    """(unit_id, text): lines joined into continuous text, without furniture and with divided words made whole."""
    body = marked.join(fixed.select("unit_id", "k"), ["unit_id", "k"], "left_anti").groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("ls"))
    text = F.concat_ws("\n", F.transform("ls", lambda s: s["line"]))
    letter, han = r"[\p{L}&&[^\p{IsHan}]]", r"[\p{IsHan}，。、；：！？（）“”]"
    text = F.regexp_replace(text, rf"(?<={letter})[{HYPHENS}]\n(?=\p{{Ll}})", "")
    text = F.regexp_replace(text, rf"(?<={letter})[{HYPHENS}]\n(?={letter})", "-")
    text = F.regexp_replace(text, rf"(?<={han})\n(?=[\p{{IsHan}}\p{{N}}\p{{L}}，。、；：！？（）“”])|(?<=[\p{{N}}\p{{L}}-])\n(?={han})", "")
    return body.select("unit_id", F.regexp_replace(text, "\n", " ").alias("text"))


# --- misread characters: words of letters -------------------------------------------------------------------------------

_WORD_RE = r"(?<![\p{L}\p{N}])[\p{L}\p{N}&&[^\p{IsHan}]]{3,}(?![\p{L}\p{N}&&[^\p{IsHan}]])"


# Shapes that scanning confuses, brought to one sign; applied in this order.
_SHAPES = (("vv", "w"), ("rn", "m"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("1i", "u"), ("i1", "u"), ("l1", "u"), ("11", "u"), ("lc", "k"))
_SHAPE_FROM, _SHAPE_TO = "01i5qcbßüäöû6", "ollsgehhuaoub"


def _shape(word: Column) -> Column:
    """What a word looks like, whatever of the confusable shapes was read."""
    out = word
    for a, b in _SHAPES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, _SHAPE_FROM, _SHAPE_TO)


def _grams(word: Column) -> Column:
    padded = F.concat(F.lit("^"), word, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))


def _model(sample: DataFrame, width: int, trees: int, depth: int) -> list:
    """Boosted trees fitted on a bounded sample of (x, y)."""
    flat = sample.select(*[F.col("x")[i].cast("float").alias(f"x{i}") for i in range(width)], F.col("y").cast("float").alias("y")).toPandas().to_numpy(dtype=np.float32)
    return boost.fit(flat[:, :-1], flat[:, -1], trees=trees, depth=depth) if len(flat) else [0.0]


def word_features(pairs: DataFrame) -> DataFrame:
    """Features of (word, n, cand, m): distances, frequencies and the look of the word."""
    d = F.levenshtein("word", "cand")
    n = F.greatest(F.length("word"), F.length("cand"))
    shared = F.size(F.array_intersect(_grams(F.col("word")), _grams(F.col("cand"))))
    shape = F.levenshtein(_shape(F.col("word")), _shape(F.col("cand"))).cast("double")
    return pairs.withColumn(
        "x",
        F.array(
            d.cast("double"), (d / n).cast("double"), n.cast("double"), F.log10(F.col("n") + 1.0), F.log10(F.col("m") + 1.0), F.log10((F.col("m") + 1.0) / (F.col("n") + 1.0)),
            (shared / F.size(_grams(F.col("cand")))).cast("double"), F.col("word").rlike(r"\p{L}\d|\d\p{L}").cast("double"), (F.length("word") - F.length("cand")).cast("double"),
            (F.substring("word", 1, 1) == F.substring("cand", 1, 1)).cast("double"), (F.substring("word", -2, 2) == F.substring("cand", -2, 2)).cast("double"),
            shape, shape / n,
        ),
    )


def _candidates(rare: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, n, cand, m): words and lexicon entries that share enough character bigrams, by an inverted join."""
    shape = lambda c: _grams(_shape(F.col(c)))
    a = rare.select("word", "n", F.explode(shape("word")).alias("g"), F.size(shape("word")).alias("_a"))
    b = lexicon.select(F.col("word").alias("cand"), F.col("n").alias("m"), F.explode(shape("word")).alias("g"), F.size(shape("word")).alias("_b"))
    hits = a.join(b, "g").where((F.abs(F.col("_a") - F.col("_b")) <= 2) & (F.col("m") >= DOMINANCE * F.col("n")) & (F.col("word") != F.col("cand")))
    counted = hits.groupBy("word", "n", "cand", "m", "_a", "_b").agg(F.count("*").alias("s"))
    # an edit spoils two bigrams, so a word of n bigrams within n/4 edits, at least one and at most three, keeps the rest
    allowed = F.least(F.greatest(F.floor(F.col("_b") / 4), F.lit(1)), F.lit(3))
    near = counted.where(F.col("s") >= F.greatest(F.lit(1), F.least("_a", "_b") - 2 * allowed - 1))
    return near.where(F.levenshtein(_shape(F.col("word")), _shape(F.col("cand"))) <= allowed).select("word", "n", "cand", "m")


def misread_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, cand): misread words with their replacements. ``words`` has (word, n), lower-cased, over all texts.

    The lexicon is made of the frequent words of letters. Candidates come from an inverted join over character bigrams;
    boosted trees, fitted on lexicon words spoiled at random and on pairs of true words, rank them. A word is misread if
    its best candidate is ranked above even odds. Codes and figures with units are no words.
    """
    code = F.col("word").rlike(r"^\d+[a-zμ°]+$|^[a-z]{1,3}\d+$|^\d+$")
    words = scratch.table("words", words.where(~code))
    lexicon = scratch.table("lexicon", words.where((F.col("n") >= DOMINANCE) & ~F.col("word").rlike(r"\d")))
    candidates = scratch.table("candidates", _candidates(words, lexicon))
    # both kinds of examples are sampled before they meet the lexicon
    some = lambda df: df.orderBy(F.xxhash64("word", F.lit(SEED))).limit(SAMPLE)
    spoiled = scratch.table("spoiled_sample", some(_spoil(lexicon, scratch)))
    made = _candidates(spoiled.select("word", "n").distinct(), lexicon).join(spoiled.select("word", F.col("cand").alias("_true")), "word").withColumn("y", (F.col("cand") == F.col("_true")).cast("double"))
    # pairs of words that are both written out by many are no misreadings
    true_pairs = _candidates(some(lexicon).withColumn("n", F.lit(1).cast("long")), lexicon).join(lexicon.select("word"), "word", "left_semi").withColumn("y", F.lit(0.0)).withColumn("n", F.least(F.col("m") / 3, F.lit(1e6)).cast("long"))
    sample = word_features(made.select("word", "n", "cand", "m", "y").unionByName(true_pairs.select("word", "n", "cand", "m", "y"))).select("x", "y", F.xxhash64("word", "cand").alias("_r")).orderBy("_r").limit(2 * SAMPLE)
    model = _model(sample, 13, trees=24, depth=2)
    scored = word_features(candidates)
    scored = scored.withColumn("z", boost.column(model, F.col("x")))
    best = scored.groupBy("word").agg(F.max_by("cand", F.struct("z", "m", "cand")).alias("cand"), F.max("z").alias("z"))
    return scratch.table("misread", best.where("z > 0").select("word", "cand"))


def _spoil(lexicon: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, cand, n): lexicon words with one or two characters replaced at random, as training cases."""

    def spoil(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = "abcdefghijklmnopqrstuvwxyzäöüß0125"
        looks = {"o": "0", "l": "1", "i": "1", "s": "5", "g": "q", "e": "c", "h": "b", "ß": "b", "ü": "ii", "u": "ii", "w": "vv", "m": "rn", "d": "cl"}
        for pdf in batches:
            rows = []
            for w, m in zip(pdf["word"], pdf["n"], strict=True):
                rng = np.random.RandomState((SEED + sum(map(ord, w)) * 31 + len(w)) & 0x7FFFFFFF)
                for _ in range(6):
                    i = rng.randint(len(w))
                    alike = [j for j, c in enumerate(w) if c in looks]
                    if alike and rng.rand() < 0.5:
                        out = w
                        for j in sorted(rng.choice(alike, size=min(len(alike), 1 + rng.randint(3)), replace=False), reverse=True):
                            out = out[:j] + looks[w[j]] + out[j + 1 :]
                        rows.append((out, w, int(1 + rng.randint(max(1, int(m / (2 * DOMINANCE)))))))
                        continue
                    new = letters[rng.randint(len(letters))] + (letters[rng.randint(len(letters))] if rng.rand() < 0.25 else "")
                    out = w[:i] + new + w[i + (2 if rng.rand() < 0.15 else 1) :]
                    if len(w) > 9 and rng.rand() < 0.3:
                        j = rng.randint(len(out))
                        out = out[:j] + letters[rng.randint(len(letters))] + out[j + 1 :]
                    if out != w and len(out) >= 3:
                        rows.append((out, w, int(1 + rng.randint(max(1, int(m / (2 * DOMINANCE)))))))
            yield pd.DataFrame(rows, columns=["word", "cand", "n"])

    made = lexicon.select("word", "n").mapInPandas(spoil, "word string, cand string, n long")
    return scratch.table("spoiled", made.join(lexicon.select("word"), "word", "left_anti").dropDuplicates(["word"]))


# --- misread characters: Chinese text -----------------------------------------------------------------------------------


def han_windows(texts: DataFrame) -> DataFrame:
    """(unit_id, w): windows of five characters around each Chinese one; runs of letters and figures count as one sign."""
    t = F.concat(F.lit("^^"), F.regexp_replace("text", r"[\p{L}\p{N}&&[^\p{IsHan}]][\p{L}\p{N}.,%°/μ &&[^\p{IsHan}]]*", "#"), F.lit("$$"))
    spans = F.transform(F.sequence(F.lit(1), F.length("t") - 4), lambda i: F.substring(F.col("t"), i, F.lit(5)))
    return texts.where(F.col("text").rlike(r"\p{IsHan}")).withColumn("t", t).where(F.length("t") > 4).select("unit_id", F.explode(spans).alias("w")).where(F.substring("w", 3, 1).rlike(r"\p{IsHan}"))


def _c(i: int, n: int = 1) -> Column:
    return F.substring("w", i, n)


def _contexts() -> dict[str, Column]:
    """The contexts of a window's middle character: its two neighbours, the two before, the two after."""
    return {"mid": F.concat(_c(2), _c(4)), "left": _c(1, 2), "right": _c(4, 2)}


def han_features(windows: DataFrame, grams: dict[str, DataFrame]) -> DataFrame:
    """(w, cand, x): candidates for the middle character of each window: all that stand in its contexts and pass the least ratio.

    Contexts are the two neighbours, the two characters before and the two after; for each the counts of the character
    itself and of the candidate make the features.
    """
    df = windows
    for name, key in _contexts().items():
        df = df.join(grams[name], key == F.col(f"k_{name}"), "left")
    keys = list(grams)
    cands = F.array("given") if "given" in windows.columns else F.array_distinct(F.array_compact(F.array(*[F.col(f"top_{n}") for n in keys])))
    z = lambda name, c: F.coalesce(F.try_element_at(F.col(f"m_{name}"), c).cast("double"), F.lit(0.0))
    own = {n: z(n, _c(3)) for n in keys}
    if not {"given", "scale", "y"} & set(windows.columns):
        # training cases keep to the most frequent ones; here whatever would fail the least ratio in a context is dropped before it becomes a row
        fits = lambda c: reduce(and_, [(own[n] <= 2) | (F.log10((z(n, c) + 0.5) / (own[n] + 0.5)) >= LEAST_RATIO) for n in keys])
        cands = F.filter(F.array_distinct(F.flatten(F.array(*[F.coalesce(F.map_keys(f"m_{n}"), F.array().cast("array<string>")) for n in keys]))), fits)
    df = df.withColumn("cand", F.explode(cands)).where((F.col("cand") != _c(3)) & F.col("cand").rlike(r"\p{IsHan}"))
    if "scale" in windows.columns:
        # a spoiled window stands for a misreading as rare as real ones are
        own = {n: F.floor(z(n, F.col("cand")) * F.col("scale")).cast("double") for n in keys}
    cand = {n: z(n, F.col("cand")) for n in keys}
    # a context in which neither was ever seen says nothing
    ratio = [F.when((cand[n] == 0) & (own[n] <= 1), 1.5).otherwise(F.log10((cand[n] + 0.5) / (F.greatest(own[n], F.lit(1.0)) + 0.5))) for n in keys]
    x = F.array(*ratio, *[F.log10(cand[n] + 1.0) for n in keys], F.greatest(*ratio), F.least(*ratio), F.log10(F.greatest(*[own[n] for n in keys], F.lit(0.0)) + 1.0), sum(((cand[n] > 0).cast("double") for n in keys), F.lit(0.0)), F.least(*[F.when(own[n] <= 2, 9.0).otherwise(r) for n, r in zip(keys, ratio, strict=True)]))
    return df.select("w", "cand", x.alias("x"), *[c for c in ("y", "true") if c in windows.columns])


def misread_windows(windows: DataFrame, scratch: Scratch) -> DataFrame:
    """(w, cand): window types whose middle character is misread, with its replacement. ``windows`` has (w, n).

    Boosted trees, fitted on windows whose middle character was replaced at random and on windows as they are, rank the
    candidates of each window; a window is misread if the best one is above even odds.
    """
    tables = {}
    for name, key in _contexts().items():
        counted = windows.groupBy(key.alias(f"k_{name}"), _c(3).alias("c")).agg(F.sum("n").alias("n"))
        # one row per context: its characters are at most as many as there are characters
        per = counted.groupBy(f"k_{name}").agg(F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias(f"m_{name}"), F.max_by("c", F.struct("n", "c")).alias(f"top_{name}"))
        tables[name] = scratch.table(f"context_{name}", per)
    base = windows.orderBy(F.xxhash64("w", F.lit(SEED))).limit(SAMPLE)
    base = scratch.table("sample", base.select("w"))
    others = scratch.table("chars", windows.groupBy(_c(3).alias("c")).agg(F.sum("n").alias("n")))
    n_chars = others.count()
    if not n_chars:
        return windows.select("w", F.col("w").alias("cand")).limit(0)
    numbered = others.withColumn("i", F.row_number().over(Window.orderBy("c")) - 1)
    spoiled = base.withColumn("i", F.pmod(F.xxhash64("w", F.lit(SEED + 1)), F.lit(n_chars)).cast("int")).join(numbered.select("i", "c"), "i")
    u = F.pmod(F.xxhash64("w", F.lit(SEED + 2)), F.lit(1000)) / 1000.0
    spoiled = spoiled.where(F.col("c") != _c(3)).select(F.concat(_c(1, 2), F.col("c"), _c(4, 2)).alias("w"), F.lit(1.0).alias("y"), _c(3).alias("true"), F.pow(F.lit(10.0), -1.2 - 2.8 * u).alias("scale"))
    bad = han_features(spoiled, tables).select("x", (F.col("cand") == F.col("true")).cast("double").alias("y"))
    good = han_features(base.withColumn("y", F.lit(0.0)), tables).select("x", "y")
    model = _model(bad.unionByName(good), 10, trees=24, depth=3)

    def best(cases: DataFrame) -> DataFrame:
        scored = han_features(cases, tables)
        scored = scored.withColumn("z", boost.column(model, F.slice("x", 1, 10)))
        # a character that stands there nearly as often as the candidate in any of the contexts is no misreading
        scored = scored.where((F.col("x")[10] >= LEAST_RATIO) & (F.col("z") > 0))
        return scored.groupBy("w").agg(F.max_by("cand", F.struct("z", "cand")).alias("cand"), F.max("z").alias("z"))

    first = scratch.table("misread_first", best(windows.select("w")))
    # a replacement found in several windows is tried wherever its character stands
    pairs = first.groupBy(_c(3).alias("_c"), F.col("cand").alias("given")).agg(F.count("*").alias("_n")).where("_n >= 3").drop("_n")
    again = windows.select("w").join(first, "w", "left_anti").join(pairs, _c(3) == F.col("_c")).select("w", "given")
    both = scratch.table("misread_both", first.unionByName(best(again)))
    # a character that is misread in most of its windows is misread in the rest, whose contexts are spoiled themselves
    share = windows.join(both, "w", "left").groupBy(_c(3).alias("_c")).agg((F.sum(F.when(F.col("cand").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("s"), F.count("cand").alias("_n"), F.mode("cand", True).alias("cand"))
    always = share.where("s >= 0.5 and _n >= 3").select("_c", "cand")
    rest = windows.select("w").join(both, "w", "left_anti").join(always, _c(3) == F.col("_c")).select("w", "cand", F.lit(0.0).alias("z"))
    return scratch.table("misread_han", both.unionByName(rest))


def passages(units: DataFrame) -> DataFrame:
    """(unit_id, doc_id, page, content): one row per passage, the last delivered one that has text."""
    text = units.where((F.col("type") == "passage") & F.col("content").isNotNull())
    row = F.max_by(F.struct("doc_id", F.col("source.page").alias("page"), "content"), F.struct("ingested_at", "content")).alias("r")
    return text.groupBy(F.col("id").alias("unit_id")).agg(row).select("unit_id", "r.doc_id", "r.page", "r.content")


def title_keys(units: DataFrame) -> DataFrame:
    """(doc_id, key) of the chapter titles of each book, in the form in which heads are compared; sections are no heads."""

    @F.pandas_udf("string")
    def key(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _key(standard(t)), na_action="ignore")

    chapter = (F.col("type") == "title") & ~F.col("content").rlike(r"^[\s\p{Cf}]*[\d０-９]+\s*[.．]\s*[\d０-９]+")
    return units.where(chapter).select("doc_id", key("content").alias("key")).distinct()


class Reading:
    """The steps that find and repair scan noise, each written once to ``scratch`` and shared by the results."""

    def __init__(self, units: DataFrame, scratch: Scratch) -> None:
        self.scratch = scratch
        self.marked = scratch.table("lines", lines(passages(units)))
        self.fixed = furniture(self.marked, title_keys(units), scratch)
        self.divided = divided(self.marked, self.fixed)
        self.text = scratch.table("text", paragraphs(self.marked, self.fixed))
        found = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORD_RE), 0)))
        self.words = self.text.select("unit_id", found.alias("word"))
        self.misread = misread_words(self.words.groupBy("word").agg(F.count("*").alias("n")), scratch)
        self.windows = han_windows(self.text)
        self.misread_han = misread_windows(scratch.table("windows", self.windows.groupBy("w").agg(F.count("*").alias("n"))), scratch)

    def noise(self) -> DataFrame:
        """(unit_id, noise): hyphen, charerr, header, pageno; one row per unit and kind."""
        kinds = self.divided.select("unit_id", F.lit("hyphen").alias("noise"))
        kinds = kinds.union(self.fixed.where("is_header").select("unit_id", F.lit("header")))
        kinds = kinds.union(self.fixed.where("is_number").select("unit_id", F.lit("pageno")))
        kinds = kinds.union(self.words.join(self.misread, "word", "left_semi").select("unit_id", F.lit("charerr")))
        kinds = kinds.union(self.windows.join(self.misread_han, "w", "left_semi").select("unit_id", F.lit("charerr")))
        return kinds.distinct()

    def repaired(self) -> DataFrame:
        """(unit_id, text): continuous text without furniture, with misread words and characters replaced."""
        words = self.words.join(self.misread, "word").groupBy("unit_id").agg(F.array_sort(F.collect_set(F.struct("word", "cand"))).alias("ws"))
        han = self.windows.join(self.misread_han, "w").groupBy("unit_id").agg(F.array_sort(F.collect_set(F.struct("w", "cand"))).alias("hs"))

        @F.pandas_udf("string")
        def repair(texts: pd.Series, ws: pd.Series, hs: pd.Series) -> pd.Series:
            return pd.Series([_repair(t, w, h) for t, w, h in zip(texts, ws, hs, strict=True)])

        return self.text.join(words, "unit_id", "left").join(han, "unit_id", "left").select("unit_id", repair("text", "ws", "hs").alias("text"))


def _repair(text: str, words, windows) -> str:
    """Replace misread words (keeping a capital) and the middle characters of misread windows."""
    for pair in words if words is not None else ():
        bad, good = pair["word"], pair["cand"]

        def swap(m: re.Match[str], good: str = good) -> str:
            return good.capitalize() if m.group()[:1].isupper() or m.group()[:1].isdigit() and m.start() == 0 else good

        text = re.sub(rf"(?<![^\W_]){re.escape(bad)}(?![^\W_])", swap, text, flags=re.IGNORECASE)
    for pair in windows if windows is not None else ():
        core, good = pair["w"].strip("^$"), pair["cand"]
        middle = 2 - (len(pair["w"]) - len(pair["w"].lstrip("^")))
        pattern = "".join(r"[^\W_][\w.,%°/μ ]*?" if c == "#" else re.escape(c) for c in core[:middle]) + "(" + re.escape(core[middle]) + ")" + "".join(r"(?=[^\W_])" if c == "#" else re.escape(c) for c in core[middle + 1 :])
        text = re.sub(pattern, lambda m, good=good: m.group()[: m.start(1) - m.start()] + good + m.group()[m.end(1) - m.start() :], text)
    return text
