"""Mapping free-entered values to a canonical list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.glyphs import folded_column, is_plain
from tracewright.session import Scratch

#: Words that say nothing about which entry is meant. A parameter of the operator.
FILLERS = ("the", "a", "an", "die", "der", "das", "den", "dem")
#: A running number after a name, as a pattern; figures of any other kind are words of the name. A parameter as well.
NUMBERING = r"\b(?:no|nr)\b\.?\s*\p{N}+$"
#: Chinese words before or after a name that say nothing about which entry is meant.
PREFIXES = ("该", "所用", "实际", "本", "此", "上述", "各", "其")
SUFFIXES = ("值", "大小", "情况", "数值", "等")
#: Edits by which a token may differ from the vocabulary (a swap of neighbours is one edit), and the shortest such token.
EDITS = 1
LEAST = 3
#: Share of a name's weight, and of the value's tokens, that matched tokens must cover. Lower ones let incomplete names in.
COVER = 0.999


def _fold(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the folded form; only values with unusual characters go through Python."""
    plain = df.where(is_plain(F.col(column))).withColumn(out, F.lower(F.trim(F.regexp_replace(F.regexp_replace(column, "ß", "ss"), r"\s+", " "))))
    odd = df.where(~is_plain(F.col(column))).withColumn(out, folded_column(F.col(column)))
    # sharp s, ss and a lost one of the two are one writing
    return plain.unionByName(odd).withColumn(out, F.regexp_replace(out, "ss", "s"))


def _tokens(folded: Column) -> Column:
    """Latin words with their full stop, and runs of Chinese characters."""
    return F.regexp_extract_all(folded, F.lit(r"([\p{IsHan}]+|[\p{L}\p{N}&&[^\p{IsHan}]]+\.?)"), 1)


def _strip(token: Column, prefixes: tuple[str, ...], suffixes: tuple[str, ...]) -> Column:
    """A Chinese token without filler prefixes and suffixes; a token that is nothing else stays."""
    out = F.regexp_replace(token, rf"^(?:{'|'.join(prefixes)})(?=[\p{{IsHan}}]{{2}})", "")
    return F.regexp_replace(out, rf"(?<=[\p{{IsHan}}]{{2}})(?:{'|'.join(suffixes)})$", "")


def _segments(term: Column, pieces: int) -> Column:
    """(start, segment) of a term cut into ``pieces`` even pieces."""
    n = F.char_length(term)
    cut = [F.floor(n * k / pieces).cast("int") for k in range(pieces + 1)]
    return F.array(*[F.struct(F.lit(k).alias("k"), F.substring(term, cut[k] + 1, cut[k + 1] - cut[k]).alias("seg")) for k in range(pieces)])


def _probes(term: Column, pieces: int, edits: int) -> Column:
    """(k, segment, length) keys under which terms within ``edits`` edits lie: the same cuts for each near length, shifted."""
    keys = []
    n = F.char_length(term)
    for d in range(-edits, edits + 1):
        for k in range(pieces):
            a, b = F.floor((n + d) * k / pieces).cast("int"), F.floor((n + d) * (k + 1) / pieces).cast("int")
            for shift in range(-edits, edits + 1):
                keys.append(F.when((a + shift >= 0) & (b > a) & (b + shift <= n), F.struct(F.lit(k).alias("k"), F.substring(term, a + shift + 1, b - a).alias("seg"), (n + d).alias("len"))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def near_terms(terms: DataFrame, vocabulary: DataFrame, scratch: Scratch, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """(term, word, sim): each distinct term with the vocabulary words within ``edits`` edits; a swap of neighbours is one.

    A word is cut into edits + 2 pieces; a term within reach holds at least one of them, at nearly the same place, so
    candidates come from an equi-join on (piece, text, length) and are then checked by their edit distance. Terms shorter
    than ``least`` match only exactly, and figures are never repaired. If any word matches exactly, the others are left out; of the rest the closest stay,
    and the same first or last character decides between equally close ones.
    """
    pieces = edits + 2
    words = vocabulary.select("word").distinct()
    exact = scratch.table("exact", terms.select("term").distinct().join(words, F.col("term") == F.col("word"), "left"))
    sure = exact.where("word is not null").select("term", "word", F.lit(1.0).alias("sim"))
    open_terms = exact.where(F.col("word").isNull() & (F.char_length("term") >= least)).select("term")
    by_piece = words.where(F.char_length("word") >= least).select("word", F.explode(_segments(F.col("word"), pieces)).alias("p"), F.char_length("word").alias("len")).select("word", "p.k", "p.seg", "len").where("seg <> ''")
    probes = open_terms.select("term", F.explode(_probes(F.col("term"), pieces, edits)).alias("p")).select("term", "p.k", "p.seg", "p.len")
    # a swap of neighbours can touch two pieces of three, so words with the same letters are candidates as well
    letters = lambda c: F.concat_ws("", F.array_sort(F.split(c, "")))
    swapped = open_terms.withColumn("l", letters(F.col("term"))).join(words.withColumn("l", letters(F.col("word"))), "l").select("term", "word")
    candidates = probes.join(by_piece, ["k", "seg", "len"]).select("term", "word").union(swapped).distinct()
    distance = F.levenshtein("term", "word")
    turned = lambda i: F.concat(F.substring(F.col("term"), F.lit(1), i - 1), F.substring(F.col("term"), i + 1, F.lit(1)), F.substring(F.col("term"), i, F.lit(1)), F.substring(F.col("term"), i + 2, F.char_length("term")))
    swap = (distance == 2) & (F.char_length("term") == F.char_length("word")) & F.exists(F.sequence(F.lit(1), F.greatest(F.char_length("term") - 1, F.lit(1))), lambda i: turned(i) == F.col("word"))
    d = F.when(swap, 1).otherwise(distance)
    figures = lambda c: F.regexp_replace(c, r"\P{N}", "")
    scored = candidates.where(figures("term") == figures("word")).withColumn("d", d).where(F.col("d") <= edits)
    ends = (F.substring("term", 1, 1) == F.substring("word", 1, 1)).cast("int") + (F.substring("term", -1, 1) == F.substring("word", -1, 1)).cast("int")
    scored = scratch.table("scored", scored.withColumn("sim", 1 - F.col("d") / F.greatest(F.char_length("term"), F.char_length("word")) + ends * 0.01))
    best = scored.groupBy("term").agg(F.max("sim").alias("top"))
    return sure.unionByName(scored.join(best, "term").where("sim >= top").select("term", "word", "sim"))


def map_to_list(values: DataFrame, entries: DataFrame, scratch: Scratch, fillers: tuple[str, ...] = FILLERS, prefixes: tuple[str, ...] = PREFIXES, suffixes: tuple[str, ...] = SUFFIXES, numbering: str = NUMBERING, cover: float = COVER, edits: int = EDITS) -> DataFrame:
    """(value, entry_id, score) for every distinct value: the entry it means, or a null entry if it means none.

    ``values`` has ``value``, ``entries`` has ``entry_id`` and ``name`` (one row per name or alias). A value that is, folded,
    a name of one entry means that entry. All others are cut into tokens, as the names are, and fillers and running numbers are taken
    from both; tokens, joined neighbours and the joined whole of a value are repaired against the words of the list by edit
    distance, and a shortened word (with a full stop) against the words it begins. Entries are then ranked by soft TF-IDF:
    the share of a name's weight that its matched words carry, times their likeness, where a word weighs more the fewer of
    the entries have it. A name counts if at least ``cover`` of its weight is matched, and an entry if its names together
    explain as great a share of the value's tokens. The best one wins; if several are equally good the value is unmatched, as
    it is if it is null, empty or only fillers.

    Tokens, values and entries are joined by equality only; a value with a third of all rows is one row here. A value meets a
    name by the name's rarest words only (as many as ``cover`` can not do without), so a word that all entries have brings
    no pairs. Steps that are read more than once are written to ``scratch``, which also keeps the plans small.
    """
    distinct = values.select("value").where("value is not null").distinct()
    folded = scratch.table("folded", _fold(distinct, "value", "f"))
    is_filler = lambda t: F.regexp_replace(t, r"\.$", "").isin(*fillers)
    bare = lambda c: F.regexp_replace(c, numbering, "")

    plain = _fold(entries.where("name is not null").select("entry_id", "name").distinct(), "name", "f").where("f <> ''").select("entry_id", F.col("f").alias("name")).distinct()
    words_of = F.filter(_tokens(bare(F.col("name"))), lambda t: ~is_filler(t))
    words_of = F.transform(F.when(F.size(words_of) > 0, words_of).otherwise(_tokens(F.col("name"))), lambda t: F.regexp_replace(t, r"\.$", ""))
    names = scratch.table("names", plain.withColumn("toks", words_of))
    sure = names.groupBy(F.col("name").alias("f")).agg(F.min("entry_id").alias("entry_id"), F.countDistinct("entry_id").alias("n")).where("n = 1").select("f", "entry_id")
    exact = scratch.table("whole", folded.select("f").distinct().join(sure, "f").select("f", "entry_id", F.lit(1.0).alias("score")))

    keys = folded.select("f").distinct().join(exact.select("f"), "f", "left_anti").withColumn("raw", F.filter(_tokens(bare(F.col("f"))), lambda t: ~is_filler(t)))
    keys = keys.withColumn("toks", F.transform("raw", lambda t: _strip(t, prefixes, suffixes)))
    keys = scratch.table("keys", keys.where(F.size("toks") > 0).select("f", "raw", "toks", F.size("toks").alias("n")))
    named = names.where(F.size("toks") > 0)
    whole = named.where(F.size("toks") > 1).select("entry_id", "name", F.concat_ws("", "toks").alias("word"), F.lit(True).alias("is_whole"), F.lit(1.0).alias("part"), F.lit(True).alias("leads"))
    # the rarer a word is among the entries, the more it tells
    each = named.select("entry_id", "name", F.explode("toks").alias("word")).distinct()
    size = named.agg(F.countDistinct("entry_id").alias("_all"))
    idf = each.groupBy("word").agg(F.countDistinct("entry_id").alias("df")).crossJoin(F.broadcast(size)).select("word", F.log(F.lit(1.0) + F.col("_all") / F.col("df")).alias("w"))
    own = Window.partitionBy("entry_id", "name")  # the words of one name
    parts = each.join(idf, "word").withColumn("part", F.col("w") / F.sum("w").over(own))
    before = F.coalesce(F.sum("part").over(own.orderBy(F.desc("part"), "word").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    parts = parts.select("entry_id", "name", "word", F.lit(False).alias("is_whole"), "part", (1 - before >= cover).alias("leads"))
    words = scratch.table("words", parts.unionByName(whole))

    # spans of a value's tokens: each one, two neighbours, and the whole
    short_of = F.transform("toks", lambda t: F.regexp_replace(t, r"\.$", ""))
    none = F.array().cast("array<struct<a:int,b:int,term:string>>")
    spans = F.concat(
        F.transform("raw", lambda t, i: F.struct(i.alias("a"), (i + 1).alias("b"), t.alias("term"))),
        F.transform(short_of, lambda t, i: F.struct(i.alias("a"), (i + 1).alias("b"), t.alias("term"))),
        F.when(F.col("n") > 1, F.transform(F.sequence(F.lit(0), F.col("n") - 2), lambda i: F.struct(i.alias("a"), (i + 2).alias("b"), F.concat(short_of[i], short_of[i + 1]).alias("term")))).otherwise(none),
        F.when(F.col("n") > 2, F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"), F.concat_ws("", short_of).alias("term")))).otherwise(none),
    )
    at = scratch.table("at", keys.select("f", "n", F.explode(spans).alias("s")).select("f", "n", "s.a", "s.b", "s.term").distinct())
    near = near_terms(at.select("term"), words, scratch, edits)
    short = keys.select(F.explode("toks").alias("t")).where(F.col("t").rlike(r"^.{3,}\.$")).distinct().select(F.regexp_replace("t", r"\.$", "").alias("term"))
    heads = words.where("not is_whole").select("word").distinct().select("word", F.explode(F.transform(F.sequence(F.lit(3), F.greatest(F.char_length("word") - 1, F.lit(3))), lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("term"))
    begun = short.join(heads, "term").where("term <> word").select("term", "word", F.lit(0.9).alias("sim"))
    repaired = near.unionByName(begun).groupBy("term", "word").agg(F.max("sim").alias("sim"))

    seen = at.join(repaired, "term").groupBy("f", "n", "word").agg(F.max("sim").alias("sim"), F.collect_set(F.struct("a", "b")).alias("spans"))
    seen = scratch.table("seen", seen)
    pairs = seen.select("f", "word").join(words.where("leads").select("word", "entry_id", "name", "is_whole"), "word").select("f", "entry_id", "name", "is_whole").distinct()
    # a whole-name hit covers its name alone; a word hit counts once per name and word
    best = pairs.join(words.drop("leads"), ["entry_id", "name", "is_whole"]).join(seen, ["f", "word"])
    per_name = best.groupBy("f", "n", "entry_id", "name", "is_whole").agg(F.sum("part").alias("cover"), F.sum(F.col("part") * F.col("sim")).alias("soft"), F.flatten(F.collect_list("spans")).alias("spans"))
    explained = per_name.where(F.col("cover") >= cover).groupBy("f", "n", "entry_id").agg(F.max("soft").alias("score"), F.flatten(F.collect_list("spans")).alias("spans"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["a"], s["b"] - 1)))))
    ranked = scratch.table("ranked", explained.where(covered >= cover * F.col("n")).select("f", "entry_id", "score"))
    top = ranked.groupBy("f").agg(F.max("score").alias("score"))
    winners = ranked.join(top, ["f", "score"]).groupBy("f", "score").agg(F.min("entry_id").alias("entry_id"), F.count("*").alias("ties")).where("ties = 1")
    found = exact.unionByName(winners.select("f", "entry_id", "score"))
    return folded.join(found, "f", "left").select("value", "entry_id", "score")
