"""Per-document text quality statistics and the kinds of text that are no prose."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statistics that get a distribution per language.
STATISTICS = ("word_count", "mean_word_length", "symbol_ratio", "end_punctuation_share", "common_word_share", "prose_share", "list_share", "table_share", "other_share", "broken_share")
#: Accuracy parameter of the sketches.
K = 400
#: Robust z-scores beyond which a value is in the tail of its language.
TAIL = 3.0
#: Least spread of a statistic, so that a language whose documents are all alike does not flag trifles; of the others ``FLOOR``.
FLOOR = 0.1
FLOORS = {"word_count": 1.0, "mean_word_length": 0.2, "symbol_ratio": 0.01, "common_word_share": 0.02, "broken_share": 0.01}
#: Statistics whose tails speak against prose, and the side of the tail: below, above or both.
TAILS = {"end_punctuation_share": -1, "common_word_share": 0, "symbol_ratio": 1, "broken_share": 1, "mean_word_length": 0}
#: Share of prose below which a document is not mostly prose.
MOSTLY = 0.5

_BULLET = re.compile(
    r"\s*(?:[-*•·–—‣◦▪●○+]\s+\S|[(（]?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5}|[一二三四五六七八九十]{1,3})[)）]\s*\S|\d{1,3}[.、．]\s*[^\d\s]"
    r"|[①-⑳]\s*\S|[一二三四五六七八九十]{1,3}、\s*\S|\[\d{1,3}\]\s*\S)"
)
_LEADERS = re.compile(r"(?:[.．·…‥_]\s?){3,}\s*(?:\d{1,4}|[ivxlIVXL]+)\s*$")
_NUMBERED = re.compile(r"\s*(?:\d{1,2}(?:\.\d{1,2}){0,3}|第\s*[\d一二三四五六七八九十百]+\s*[章节]|Kapitel \d+|Chapter \d+)\s+\S.*?(?:\s{2,}|\t|\s)\d{1,4}\s*$")
_TAG = re.compile(r"</?t[dhr][ >/]", re.IGNORECASE)
_RULE = re.compile(r"\s*[|+:=\- ]{3,}\s*$")
_COLUMNS = re.compile(r"\S\s{2,}\S")
_END = re.compile(r"[.!?。！？…]['\"”’)）]*\s*$")
_MARK = re.compile(r"[。！？]+|[.!?．]+(?=\s|$|[一-鿿\"”’)])")
_WORD = re.compile(r"[一-鿿㐀-䶿]|[^\W_一-鿿㐀-䶿]+(?:['’-][^\W_一-鿿㐀-䶿]+)*")
_HAN = re.compile(r"[一-鿿㐀-䶿]")
_SYMBOL = re.compile(r"[^\w\s.,;:!?。，、；：！？()（）\"'“”‘’%°μ·–—/-]|[_�口]")
_BLANK = re.compile(r"\s+")
_WRAP = re.compile(r"(?<=[一-鿿，、；：])\n(?=[一-鿿\d])|(?<=\d)\n(?=[一-鿿\d])")
_LATIN_WORD = re.compile(r"[^\W\d_]{2,}")
_SPECIAL = re.compile(r"<\|[^|<>\s]{1,40}\|>")
#: What UTF-8 text looks like once it was decoded byte by byte, and letters that such a text cannot hold.
_MISDECODED = re.compile("[ÃÂÎÏâåæçèéä][\x80-\xbf]")
_DECODED = re.compile("[\u0100-\uffff]|[äöüÄÖÜß°](?![\x80-\xbf])")
_GERMAN = re.compile(r"\b(?:der|die|das|und|ist|mit|von|nicht|an|bei|nach)\b", re.IGNORECASE)
_ENGLISH = re.compile(r"\b(?:the|and|of|is|to|in|at|with|by|for)\b", re.IGNORECASE)
_CODE = re.compile(r"(zh|en|de)(?:[-_].*)?$", re.IGNORECASE)

_SCHEMA = "language string, word_count long, " + ", ".join(f"{s} double" for s in STATISTICS[1:])


def language(lang: str | None, text: str) -> str:
    """zh, en, de or other: the given code where it is well-formed, else by script and frequent words."""
    if lang and (m := _CODE.match(lang.strip())):
        return m.group(1).lower()
    if len(_HAN.findall(text)) * 5 > len(text):
        return "zh"
    de, en = len(_GERMAN.findall(text)), len(_ENGLISH.findall(text))
    return "other" if de == en == 0 else "de" if de > en else "en"


def _form(line: str) -> str:
    """l for an entry of a list, t for a row of cells, o for anything else."""
    if _LEADERS.search(line):
        return "l"
    entry = _BULLET.match(line) is not None
    if not entry:
        if line.count("|") > 1 or "\t" in line.strip() or _TAG.search(line) or _RULE.match(line):
            return "t"
        for mark in (";", "；"):
            cells = line.split(mark)
            if len(cells) > 2 and max(map(len, cells)) <= 60 and not _END.search(line):
                return "t"
        if _NUMBERED.match(line) and not _END.search(line) and len(line) < 80:
            return "l"
        if _COLUMNS.search(line.strip()) and not _END.search(line) and len(line) < 400:
            return "t"
        return "o"
    # a bulleted sentence is prose
    return "o" if len(line) > 24 and _END.search(line) else "l"


def _readable(sentence: str) -> bool:
    """A sentence of words, not of signs, figures or one endless string. Strings like special tokens are left aside."""
    sentence = _SPECIAL.sub("", sentence)
    han = len(_HAN.findall(sentence))
    words = len(_LATIN_WORD.findall(sentence))
    if han < 6 and words < 3:
        return False
    if len(_SYMBOL.findall(sentence)) * 12 > len(sentence):
        return False
    return han >= 6 or max(map(len, sentence.split())) <= 60


def measure(lang: str | None, text: str, common: dict[str, frozenset[str]], zh_common: re.Pattern[str] | None) -> tuple:
    """The language and the statistics of one text."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    size = len(_BLANK.sub("", text))
    tongue = language(lang, text)
    if not size:
        return (tongue, 0, *[0.0] * (len(STATISTICS) - 1))
    lines = [x for x in text.split("\n") if x.strip()]
    words = _WORD.findall(text)
    n_words = len(words)
    if tongue == "zh":
        hits = len(zh_common.findall(text)) if zh_common else 0
    else:
        listed = common.get(tongue, frozenset())
        hits = sum(w.lower() in listed for w in words)
    forms = [_form(x) for x in lines]
    counts = Counter(f for _, f in {(x, f) for x, f in zip(lines, forms, strict=True)})
    # one row of cells is a word series and no table, as are the same few rows again and again
    if counts["t"] < 3:
        forms = ["o" if f == "t" else f for f in forms]
    if counts["l"] < 2:
        forms = ["o" if f == "l" else f for f in forms]
    whole = lambda k: sum(len(_BLANK.sub("", x)) for x, f in zip(lines, forms, strict=True) if f == k)
    table, listing = whole("t"), whole("l")
    rest = "\n".join(x for x, f in zip(lines, forms, strict=True) if f == "o")
    rest = _WRAP.sub("", rest).replace("\n", " ")
    prose, broken, start, seen = 0, 0, 0, set()
    for m in _MARK.finditer(rest):
        piece = rest[start : m.end()].strip()
        start = m.end()
        if piece not in seen:
            seen.add(piece)
            if _readable(piece):
                prose += len(piece) - piece.count(" ")
    prose = min(prose, size - table - listing)
    if prose and _MISDECODED.search(text) and not _DECODED.search(_MISDECODED.sub("", text)):
        # every letter beyond ASCII is broken: the text was decoded wrongly as a whole
        prose, broken = 0, 2 * len(_MISDECODED.findall(text))
    share = lambda a, b: round(min(a / b, 1.0), 6) if b else 0.0
    return (
        tongue,
        n_words,
        round(sum(map(len, words)) / n_words, 6) if n_words else 0.0,
        share(len(_SYMBOL.findall(text)), size),
        share(sum(_END.search(x) is not None for x in lines), len(lines)),
        share(hits, n_words),
        share(prose, size),
        share(listing, size),
        share(table, size),
        share(max(0, size - prose - listing - table), size),
        share(broken, size),
    )


def statistics(documents: DataFrame, common_words: DataFrame, text: str = "text") -> DataFrame:
    """One row of statistics per row of ``documents`` (doc_id, lang, text), in one Arrow pass and without a shuffle.

    ``word_count`` counts words (a Chinese character is one), ``mean_word_length`` is in characters, ``symbol_ratio`` is the
    share of characters that are no letter, digit, blank or usual punctuation, ``end_punctuation_share`` the share of lines
    that end in punctuation, ``common_word_share`` the share of words on the language's list. The four shares of text by
    form sum to one: readable distinct sentences, entries of lists, rows of cells, and all else. ``broken_share`` is the share of
    characters that come from decoding a text wrongly as a whole. ``common_words`` (lang,
    word) is a bounded word list (at most 20 000 words of a language) and goes to the workers with the function.
    Null texts have null statistics; empty and blank ones have zeros; any line ending counts; a text of any length is read
    whole and in time proportional to it. Repeated rows give repeated rows.
    """
    lists = {r["lang"]: r["words"] for r in common_words.where("word is not null and lang is not null").groupBy("lang").agg(F.slice(F.array_sort(F.collect_set(F.lower("word"))), 1, 20_001).alias("words")).collect()}
    if any(len(w) > 20_000 for w in lists.values()):
        raise ValueError("common_words is a bounded list; it has more than 20 000 words of a language")
    common = {k: frozenset(v) for k, v in lists.items()}
    zh = re.compile("|".join(sorted(map(re.escape, common["zh"]), key=lambda w: (-len(w), w)))) if common.get("zh") else None

    @F.pandas_udf(_SCHEMA)
    def stats(langs: pd.Series, texts: pd.Series) -> pd.DataFrame:
        none = (None,) * (len(STATISTICS) + 1)
        rows = [none if t is None else measure(g, t, common, zh) for g, t in zip(langs, texts, strict=True)]
        out = pd.DataFrame(rows, columns=["language", *STATISTICS])
        return out.astype({"word_count": "Int64"} | {s: "float64" for s in STATISTICS[1:]})

    return documents.select("doc_id", stats(F.col("lang"), F.col(text)).alias("s")).select("doc_id", "s.*")


def distributions(stats: DataFrame, k: int = K) -> DataFrame:
    """One row per language: a mergeable quantile sketch of every statistic, with its quartiles and percentiles read off.

    The sketches combine on the map side, so a language with nearly all documents costs one sketch per task.
    """
    shares = stats.where("word_count > 0")
    sketches = shares.groupBy("language").agg(F.count("*").alias("n_documents"), *[F.kll_sketch_agg_double(F.col(s).cast("double"), k).alias(s) for s in STATISTICS])
    at = lambda s, q: F.kll_sketch_get_quantile_double(s, F.lit(q))
    return sketches.select("language", "n_documents", *[F.struct(at(s, 0.05).alias("p05"), at(s, 0.25).alias("p25"), at(s, 0.5).alias("p50"), at(s, 0.75).alias("p75"), at(s, 0.95).alias("p95")).alias(s) for s in STATISTICS])


def scored(stats: DataFrame, spread: DataFrame) -> DataFrame:
    """The statistics with a robust z-score each, the distance from the language's median in units of its spread, and
    ``beyond``: how far the statistics of ``TAILS`` lie on the side that speaks against prose, in sum.

    A document of no known language is compared with the language that it is most like (the least ``beyond``), so it is in a
    tail only if it is in the tails of all. ``spread`` has one row per language; these few go to all tasks as one list.
    """
    own = F.struct("language", *STATISTICS)
    d = spread.agg(F.collect_list(F.when(F.col("language") != "other", own)).alias("_known"), F.collect_list(own).alias("_any"))
    out = stats.crossJoin(F.broadcast(d))  # one row
    like = F.when(F.col("language") != "other", F.filter("_known", lambda x: x["language"] == F.col("language"))).otherwise(F.when(F.size("_known") > 0, F.col("_known")).otherwise(F.col("_any")))

    def compared(x: Column) -> Column:
        z = {s: F.round((F.col(s) - x[s]["p50"]) / F.greatest((x[s]["p75"] - x[s]["p25"]) / 1.349, F.lit(FLOORS.get(s, FLOOR))), 6) for s in STATISTICS}
        beyond = sum((F.greatest(F.lit(0.0), side * z[s]) if side else F.coalesce(F.abs(z[s]), F.lit(0.0)) for s, side in TAILS.items()), F.lit(0.0))
        return F.struct(F.round(beyond, 6).alias("beyond"), x["language"].alias("like"), *[z[s].alias(f"z_{s}") for s in STATISTICS])

    out = out.withColumn("_z", F.array_min(F.transform(like, compared)))
    return out.select("doc_id", "language", *STATISTICS, *[F.col("_z")[f"z_{s}"].alias(f"z_{s}") for s in STATISTICS], F.col("_z")["beyond"].alias("beyond"))


def kinds(scores: DataFrame, tail: float = TAIL, mostly: float = MOSTLY) -> DataFrame:
    """(doc_id, kind) of documents most of whose text is no prose: ``list``, ``table`` or ``junk``.

    Such a document lies in the low tail of its language's prose share with less than ``mostly`` of it prose, and its other
    statistics lie ``beyond`` the tail as well. So prose with unusual marks, whose words are like those of its language, is
    none. The kind is the form that has the greatest share of the rest. Documents without words or signs are no case.
    """
    low = (F.col("prose_share") < mostly) & (F.col("z_prose_share") < -tail) & (F.col("beyond") > tail)
    top = F.greatest("list_share", "table_share", "other_share")
    kind = F.when(F.col("table_share") == top, "table").when(F.col("list_share") == top, "list").otherwise("junk")
    some = F.col("list_share") + F.col("table_share") + F.col("other_share") + F.col("prose_share") > 0
    return scores.where(low & some).select("doc_id", kind.alias("kind"))
