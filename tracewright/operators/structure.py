"""Document structure: reading order, headings and sections, links between text and assets, scopes of conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators import sequence

#: Span of positions within which numbered headings confirm each other.
HEADING_BAND = 160
#: Patterns that are matched in one scan.
PACK = 1000


def live_units(units: DataFrame) -> DataFrame:
    """One row per unit, the last delivered one, without deleted units."""
    last = F.max_by(F.struct(*[c for c in units.columns if c != "id"]), F.struct("ingested_at", F.coalesce("content", F.lit("")))).alias("r")
    return units.groupBy("id").agg(last).select("id", "r.*").where("deleted_at is null")


def reading_order(units: DataFrame) -> DataFrame:
    """Add ``pos``: the rank by page (missing ones first), top, left and id within the document."""
    order = [F.coalesce(F.col("source.bbox")[1], F.lit(0.0)), F.coalesce(F.col("source.bbox")[0], F.lit(0.0)), F.col("id")]
    return sequence.ranked(units, ["doc_id"], F.coalesce("source.page", F.lit(-1)), order)


def next_edges(ordered: DataFrame) -> DataFrame:
    """(source_id, target_id): each unit with the one that follows it."""
    return sequence.shifted(ordered.select("doc_id", "pos", "id"), ["doc_id"], ["id"], 1, "_next", how="inner").select(F.col("id").alias("source_id"), F.col("id_next").alias("target_id"))


def heading_level(text: Column) -> Column:
    """1 for a chapter, the depth of the numbering for a numbered heading, 2 for a Chinese ordinal, else null."""
    depth = F.size(F.split(F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)*)[\s、.]", 1), r"\."))
    return (
        F.when(text.rlike(r"^\s*(?:第\s*[0-9一二三四五六七八九十百]+\s*章|Chapter [0-9]|Kapitel [0-9])"), 1)
        .when(text.rlike(r"^\s*[0-9]+(?:\.[0-9]+)*[\s、.]"), depth)
        .when(text.rlike(r"^\s*[一二三四五六七八九十]+、"), 2)
    )


def section_path(ordered: DataFrame, level: Column, text: Column) -> DataFrame:
    """Add ``section_path``: the headings that are open at each row, itself included for a heading.

    A heading closes all of its level or deeper. For each level that occurs (one number is read for that) the last heading is
    carried along and counts if no higher heading came after it.
    """
    df = ordered.withColumn("_level", level)
    depth = max(df.agg(F.max("_level")).first()[0] or 1, 1)
    values = {f"_h{k}": F.when(F.col("_level") == k, F.struct(F.col("pos").alias("p"), text.alias("t"))) for k in range(1, depth + 1)}
    values |= {f"_u{k}": F.when(F.col("_level") < k, F.col("pos")) for k in range(2, depth + 1)}
    df = sequence.carried(df, ["doc_id"], values, inclusive=True)
    opened = [F.when(F.col("_h1").isNotNull(), F.col("_h1.t"))]
    opened += [F.when(F.col(f"_h{k}.p") > F.coalesce(F.col(f"_u{k}"), F.lit(-1)), F.col(f"_h{k}.t")) for k in range(2, depth + 1)]
    return df.withColumn("section_path", F.array_compact(F.array(*opened))).drop("_level", *values)


def continuations(ordered: DataFrame) -> DataFrame:
    """(source_id, target_id): passages that go on on the next page: the earlier one is unfinished and the later no entry."""
    df = sequence.shifted(ordered.select("doc_id", "pos", "id", "type", F.col("source.page").alias("page"), "content"), ["doc_id"], ["id", "type", "page", "content"], 1, "_next", how="inner")
    unfinished = ~F.col("content").rlike(r"[。！？；：.!?;:]\s*$") & F.col("content").rlike(r"\S")
    fresh = F.col("content_next").rlike(r"^\s*(?:[（(]?[0-9]+[)）.、]|[-*•—])")
    ok = (F.col("type") == "passage") & (F.col("type_next") == "passage") & (F.col("page_next") == F.col("page") + 1) & unfinished & ~fresh
    return df.where(ok).select(F.col("id").alias("source_id"), F.col("id_next").alias("target_id"))


def pattern_matches(units: DataFrame, patterns: DataFrame) -> DataFrame:
    """Every hit of every enabled pattern (pattern_id, group, kind, expr, min_length, max_length, types) in each unit.

    ``patterns`` is a configuration table; its rows become columns of one scan, ``PACK`` of them at a time. A regex gives all
    its hits, a keyword its first occurrence; overlapping hits are all kept.
    """
    rows = patterns.collect()
    parts = [_pack_matches(units, rows[a : a + PACK]) for a in range(0, max(len(rows), 1), PACK)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pack_matches(units: DataFrame, rows: list) -> DataFrame:
    if not rows:
        return units.select(F.col("id").alias("unit_id"), F.lit("").alias("pattern_id"), F.lit("").alias("group"), F.lit(0).alias("hit"), F.lit("").alias("matched_text")).limit(0)
    pack = F.array(*[F.struct(F.lit(r["pattern_id"]).alias("pattern_id"), F.lit(r["group"]).alias("group"), F.array(*map(F.lit, r["types"])).cast("array<string>").alias("types"), F.lit(r["min_length"]).alias("lo"), F.lit(r["max_length"]).alias("hi"), _hits(F.col("content"), r).alias("hits")) for r in rows])
    fits = units.where("content is not null").select("id", "type", "content", F.explode(pack).alias("p"))
    fits = fits.where((F.length("content") >= F.col("p.lo")) & (F.length("content") <= F.col("p.hi")) & ((F.size("p.types") == 0) | F.array_contains("p.types", F.col("type"))))
    return fits.select(F.col("id").alias("unit_id"), "p.pattern_id", "p.group", F.posexplode("p.hits").alias("hit", "matched_text"))


def _hits(text: Column, rule) -> Column:
    if rule["kind"] == "keyword":
        return F.when(F.contains(text, F.lit(rule["expr"])), F.array(F.lit(rule["expr"]))).otherwise(F.array().cast("array<string>"))
    return F.regexp_extract_all(text, F.lit(rule["expr"]), 0)


def unique_label_links(references: DataFrame, assets: DataFrame) -> DataFrame:
    """(unit_id, asset_id): references to a label that exactly one asset of the document bears."""
    unique = assets.groupBy("doc_id", "label").agg(F.count("*").alias("n"), F.min("id").alias("asset_id")).where("n = 1").drop("n")
    return references.join(unique, ["doc_id", "label"]).select("unit_id", "asset_id").distinct()


def nearest_assets(ordered: DataFrame, is_asset: Column, block: int = sequence.BLOCK) -> DataFrame:
    """Add ``before_id`` and ``after_id``: the nearest asset on either side, if it is in the same section."""
    value = {"_b": F.when(is_asset, F.struct("id", "section_id"))}
    df = sequence.carried(ordered, ["doc_id"], value, block=block)
    df = sequence.carried(df, ["doc_id"], {"_a": F.when(is_asset, F.struct("id", "section_id"))}, reverse=True, block=block)
    same = lambda c: F.when(F.col(f"{c}.section_id") == F.col("section_id"), F.col(f"{c}.id"))
    return df.withColumn("before_id", same("_b")).withColumn("after_id", same("_a")).drop("_a", "_b")


def first_after(ordered: DataFrame, source: Column, target: Column, blocker: Column) -> DataFrame:
    """(source_id, target_id): for each source the first target or blocker after it, if that is a target."""
    df = sequence.carried(ordered, ["doc_id"], {"_n": F.when(target | blocker, F.struct("id", target.alias("hit")))}, reverse=True)
    return df.where(source & F.col("_n.hit")).select(F.col("id").alias("source_id"), F.col("_n.id").alias("target_id"))


def run_links(ordered: DataFrame, source: Column, member: Column, breaker: Column) -> DataFrame:
    """(source_id, target_id): each source with the members after it before the next breaker or source."""
    df = sequence.running(ordered, ["doc_id"], "_run", (breaker | source).cast("int"))
    heads = df.where(source).select("doc_id", "_run", F.col("id").alias("source_id"))
    members = df.where(member & ~breaker & ~source).select("doc_id", "_run", F.col("id").alias("target_id"))
    return heads.join(members, ["doc_id", "_run"]).select("source_id", "target_id")


def confirmed_headings(headings: DataFrame, band: int = HEADING_BAND) -> DataFrame:
    """Numbered headings (doc_id, id, pos, parent, num) confirmed by a sibling one off or by their parent within the band.

    The band becomes an equi-join: a heading meets those of its own and the neighbouring position buckets.
    """
    h = headings.withColumn("_k", F.floor(F.col("pos") / band))
    o = headings.select("doc_id", F.col("id").alias("o_id"), F.col("pos").alias("o_pos"), F.col("parent").alias("o_parent"), F.col("num").alias("o_num"), F.explode(F.array(*[F.floor(F.col("pos") / band) + d for d in (-1, 0, 1)])).alias("_k"))
    near = h.join(o, ["doc_id", "_k"]).where((F.col("id") != F.col("o_id")) & (F.abs(F.col("pos") - F.col("o_pos")) <= band))
    sibling = (F.col("parent") == F.col("o_parent")) & (F.abs(F.col("num") - F.col("o_num")) == 1)
    above = (F.col("o_pos") < F.col("pos")) & (F.concat_ws(".", F.when(F.col("o_parent") != "", F.col("o_parent")), F.col("o_num").cast("string")) == F.col("parent"))
    return near.where(sibling | above).select("doc_id", "id").distinct()


def scope_ends(constraints: DataFrame, ordered: DataFrame) -> DataFrame:
    """Add ``end_pos`` to constraints (id, doc_id, kind, start_pos, level): the last position they hold at.

    That is the row before the next title of their level or above, or before the next constraint of the same kind. Ends are
    carried backwards over the document, so no constraint meets all titles.
    """
    titles = ordered.select("doc_id", "pos", "level", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("id"))
    marks = constraints.select("doc_id", F.col("start_pos").alias("pos"), F.lit(None).cast("int").alias("level"), "kind", "id")
    ends = None
    for k in sorted(r[0] for r in constraints.select("level").distinct().collect()):  # one row per level
        up_to = titles.where(F.col("level") <= k).select("doc_id", F.col("pos").alias("at"), F.lit(k).alias("level"))
        ends = up_to if ends is None else ends.unionByName(up_to)
    c = constraints.select("id", "doc_id", "kind", "start_pos", "level")
    # the next title and the next constraint of the kind, each by a carried value over (document, level) or (document, kind)
    by_level = c.select("doc_id", "level", F.col("start_pos").alias("at"), "id", F.lit(None).cast("long").alias("hit")).unionByName(ends.select("doc_id", "level", "at", F.lit(None).cast("string").alias("id"), F.col("at").alias("hit")))
    next_title = _next_hit(by_level, ["doc_id", "level"])
    by_kind = marks.where("pos is not null").select("doc_id", "kind", F.col("pos").alias("at"), "id", F.col("pos").alias("hit"))
    next_same = _next_hit(by_kind, ["doc_id", "kind"])
    last = ordered.groupBy("doc_id").agg(F.max("pos").alias("last"))
    out = c.join(next_title.withColumnRenamed("next", "t"), "id", "left").join(next_same.withColumnRenamed("next", "s"), "id", "left").join(last, "doc_id")
    return out.select("id", "doc_id", "kind", "start_pos", F.least(F.coalesce(F.col("t") - 1, F.col("last")), F.coalesce(F.col("s") - 1, F.col("last"))).alias("end_pos"))


def _next_hit(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(id, next): for each row with an id the smallest ``hit`` greater than its ``at``."""
    # ties in position are separated by joining on the next distinct position
    places = rows.groupBy(*keys, "at").agg(F.max("hit").alias("hit"))
    ranked = sequence.ranked(places, keys, F.floor(F.col("at") / 4096), [F.col("at")])
    ahead = sequence.carried(ranked, keys, {"next": F.col("hit")}, reverse=True)
    return rows.where("id is not null").join(ahead.select(*keys, "at", "next"), [*keys, "at"]).select("id", "next")


def blocks_of(start: Column, end: Column) -> Column:
    """The dyadic blocks (k, b), of 2^k positions each, that an interval is made of: at most two of a size."""
    size = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    inside = lambda k, b: (b * size(k) >= start) & ((b + 1) * size(k) - 1 <= end)

    def at(k: Column) -> Column:
        ends = F.array_distinct(F.array(F.ceil(start / size(k)).cast("long"), F.floor((end + 1) / size(k)).cast("long") - 1))
        return F.transform(F.filter(ends, lambda b: inside(k, b) & ~inside(k + 1, F.floor(b / 2).cast("long"))), lambda b: F.struct(k.alias("k"), b.alias("b")))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(31)), at)))


def blocks_around(place: Column) -> Column:
    """The dyadic blocks (k, b) that hold a position, one of each size."""
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.struct(k.alias("k"), F.call_function("shiftright", place.cast("long"), k).alias("b")))


def neighbours(ordered: DataFrame, radius: int, wanted: Column) -> DataFrame:
    """(id, neighbour_id): units within ``radius`` positions of the same document that ``wanted`` holds for."""
    near = ordered.where(wanted).select("doc_id", F.col("id").alias("neighbour_id"), F.explode(F.array(*[F.col("pos") + d for d in range(-radius, radius + 1) if d])).alias("pos"))
    return ordered.select("doc_id", "id", "pos").join(near, ["doc_id", "pos"]).select("id", "neighbour_id")


def package_members(packages: DataFrame) -> DataFrame:
    """The bridge table (package_id, role, ord, member_id); nulls left out, repeated members kept at their first place."""
    roles = {"core": "core_unit_ids", "support": "support_unit_ids", "constraint": "constraint_ids", "asset": "asset_part_ids", "unresolved": "unresolved_ids"}
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.array_distinct(F.array_compact(c)).alias("ids")) for r, c in roles.items()])).alias("x")
    return packages.select(F.col("id").alias("package_id"), each).select("package_id", "x.role", F.posexplode("x.ids").alias("ord", "member_id"))


def conflicts(constraints: DataFrame) -> DataFrame:
    """(source_id, kind, n_values): conditions of one unit and kind that state different values."""
    return constraints.where("source_id is not null").groupBy("source_id", "kind").agg(F.countDistinct("value").alias("n_values")).where("n_values >= 2")
