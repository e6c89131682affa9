"""Queries over document structure: units, sections, links and scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import sequence, structure
from tracewright.session import Scratch
from tracewright.tables import latest, table

_U = """
WITH u AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, coalesce(content, '') DESC) AS rn_ FROM units) WHERE rn_ = 1 AND deleted_at IS NULL),
o AS (
  SELECT *, source.page AS page, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(source.page, -1), coalesce(source.bbox[2], 0), coalesce(source.bbox[1], 0), id) - 1 AS pos FROM u),
lv AS (
  SELECT *, CASE WHEN type <> 'title' THEN NULL
    WHEN regexp_matches(content, '^\\s*(第\\s*[0-9一二三四五六七八九十百]+\\s*章|Chapter [0-9]|Kapitel [0-9])') THEN 1
    WHEN regexp_matches(content, '^\\s*[0-9]+(\\.[0-9]+)*[\\s、.]') THEN len(string_split(regexp_extract(content, '^\\s*([0-9]+(\\.[0-9]+)*)[\\s、.]', 1), '.'))
    WHEN regexp_matches(content, '^\\s*[一二三四五六七八九十]+、') THEN 2 END AS level FROM o),
h AS (
  SELECT *,
    max(CASE WHEN level = 1 THEN struct_pack(p := pos, t := content) END) OVER w AS h1, max(CASE WHEN level = 2 THEN struct_pack(p := pos, t := content) END) OVER w AS h2,
    max(CASE WHEN level = 3 THEN struct_pack(p := pos, t := content) END) OVER w AS h3, max(CASE WHEN level < 2 THEN pos END) OVER w AS u2, max(CASE WHEN level < 3 THEN pos END) OVER w AS u3,
    max(CASE WHEN level IS NOT NULL THEN pos END) OVER w AS sec
  FROM lv WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def ordered_units(spark: SparkSession, sf: str) -> DataFrame:
    """Live units with their rank and heading level, written once: most queries read them several times."""
    units = structure.live_units(table(spark, sf, "units"))
    level = F.when(F.col("type") == "title", structure.heading_level(F.col("content")))
    df = structure.reading_order(units).withColumn("level", level).select("id", "doc_id", "source_index", "type", "content", F.col("source.page").alias("page"), "source", "role", "pos", "level")
    return Scratch(spark, "units").table("ordered", df)


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    df = ordered_units(spark, sf)
    return sequence.carried(df, ["doc_id"], {"section_id": F.when(F.col("level").isNotNull(), F.col("pos"))}, inclusive=True)


def reading_order(spark: SparkSession, sf: str) -> DataFrame:
    """The rank of each unit in its document."""
    return ordered_units(spark, sf).select("id", "doc_id", "pos")


def next_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Each unit with the one that follows it."""
    return structure.next_edges(ordered_units(spark, sf))


def section_path(spark: SparkSession, sf: str) -> DataFrame:
    """The open headings at each unit."""
    df = structure.section_path(ordered_units(spark, sf), F.col("level"), F.col("content"))
    return df.select("id", F.array_join("section_path", " / ").alias("section_path"))


def continuations(spark: SparkSession, sf: str) -> DataFrame:
    """Passages that go on on the next page."""
    return structure.continuations(ordered_units(spark, sf))


PATTERNS = [
    ("noise.page_number", "noise", "regex", r"^[0-9]+$", 1, 100000, ["passage"]),
    ("heading.chapter", "heading", "regex", r"第[0-9一二三四五六七八九十]+章", 2, 80, ["title"]),
    ("asset_reference.figure", "asset_reference", "regex", r"图[0-9]+-[0-9]+", 2, 100000, []),
    ("condition.when", "condition", "keyword", "当", 6, 2000, ["passage"]),
    ("condition.under", "condition", "regex", r"在[^，。]{2,40}的前提下", 6, 2000, ["passage"]),
    ("rule.limit", "rule", "regex", r"允许下限取[0-9.]+", 6, 2000, ["passage"]),
    ("rule.threshold", "rule", "keyword", "报警阈值", 6, 2000, ["passage"]),
    ("rule.causal", "rule", "keyword", "从而", 6, 2000, ["passage"]),
]


def patterns(spark: SparkSession) -> DataFrame:
    """The default pattern pack as a table."""
    return spark.createDataFrame(PATTERNS, "pattern_id string, `group` string, kind string, expr string, min_length int, max_length int, types array<string>")


def pattern_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Every hit of every pattern."""
    return structure.pattern_matches(structure.live_units(table(spark, sf, "units")), patterns(spark)).select("unit_id", "pattern_id", "group", "hit", "matched_text")


def _pattern_sql() -> str:
    parts = []
    for pid, group, kind, expr, lo, hi, types in PATTERNS:
        hits = f"regexp_extract_all(content, '{expr}')" if kind == "regex" else f"CASE WHEN contains(content, '{expr}') THEN ['{expr}'] ELSE [] END"
        where = f"length(content) BETWEEN {lo} AND {hi}" + (f" AND type IN ({', '.join(repr(t) for t in types)})" if types else "")
        parts.append(f"SELECT id, '{pid}' AS pattern_id, '{group}' AS \"group\", {hits} AS hits FROM u WHERE {where}")
    return f"{_U}, m AS ({' UNION ALL '.join(parts)}) SELECT id AS unit_id, pattern_id, \"group\", CAST(unnest(generate_series(0, len(hits) - 1)) AS INTEGER) AS hit, unnest(hits) AS matched_text FROM m"


def role_routing(spark: SparkSession, sf: str) -> DataFrame:
    """The roles that patterns and given roles suggest for each unit; noise rules out the rest."""
    units = structure.live_units(table(spark, sf, "units"))
    hits = structure.pattern_matches(units, patterns(spark)).groupBy("unit_id").agg(F.collect_set("group").alias("groups"))
    df = units.join(hits, F.col("id") == F.col("unit_id"), "left").withColumn("groups", F.coalesce("groups", F.array().cast("array<string>")))
    given = F.coalesce("role", F.array().cast("array<string>"))
    noise = F.array_contains("groups", "noise") | F.array_contains(given, "noise")
    rule = F.array_contains("groups", "rule") | F.array_contains(given, "rule") | F.array_contains(given, "concept_and_rule")
    concept = F.array_contains(given, "concept") | F.array_contains(given, "concept_and_rule")
    route = F.when(noise, "noise").when(rule & concept, "concept_and_rule").when(rule, "rule").when(concept, "concept").otherwise("none")
    return df.groupBy("type", route.alias("route")).agg(F.count("*").alias("n_units"))


def front_matter_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Units left after everything before the last first chapter of each document is cut."""
    df = ordered_units(spark, sf)
    chapter = F.regexp_extract("content", r"^\s*(?:第|Chapter |Kapitel )\s*([0-9]+)", 1)
    first = df.where((F.col("level") == 1) & (chapter == "1")).groupBy("doc_id").agg(F.max("pos").alias("cut"))
    return df.join(first, "doc_id", "left").where(F.col("pos") >= F.coalesce("cut", F.lit(0))).groupBy("doc_id").agg(F.count("*").alias("n_units"), F.min("pos").alias("first_pos"))


def unique_label_join(spark: SparkSession, sf: str) -> DataFrame:
    """Passages and captions that cite a figure number which exactly one caption of the document bears."""
    units = structure.live_units(table(spark, sf, "units")).where("content is not null")
    label = F.regexp_extract("content", r"^\s*(?:图|Bild |Figure |Fig\. )([0-9]+-[0-9]+)", 1)
    assets = units.where("type = 'caption'").select("doc_id", "id", label.alias("label")).where("label <> ''")
    cited = F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit("([0-9]+-[0-9]+)"), 1)))
    return structure.unique_label_links(units.where("type <> 'title'").select("doc_id", F.col("id").alias("unit_id"), cited.alias("label")), assets)


def nearest_assets(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest figure before and after each passage, within its section."""
    df = structure.nearest_assets(_sections(spark, sf).withColumn("section_id", F.coalesce("section_id", F.lit(-1))), F.col("type") == "figure")
    return df.where("type = 'passage' and (before_id is not null or after_id is not null)").select("id", "before_id", "after_id")


def introduced_formulas(spark: SparkSession, sf: str) -> DataFrame:
    """Passages with the formula that follows before any passage or title."""
    df = ordered_units(spark, sf)
    return structure.first_after(df, F.col("type") == "passage", F.col("type") == "formula", F.col("type").isin("title", "passage"))


def formula_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Each formula with the passages that follow it without a title or table in between."""
    df = ordered_units(spark, sf)
    return structure.run_links(df, F.col("type") == "formula", F.col("type") == "passage", F.col("type").isin("title", "table"))


def lookback_label(spark: SparkSession, sf: str) -> DataFrame:
    """Formulas with the one distinct number that the three units before them cite."""
    df = ordered_units(spark, sf).withColumn("cited", F.array_distinct(F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit("([0-9]+-[0-9]+)"), 1)))
    for k in (1, 2, 3):
        df = sequence.shifted(df, ["doc_id"], ["cited"], -k, str(k))
    empty = F.array().cast("array<string>")
    before = F.array_distinct(F.flatten(F.array(*[F.coalesce(f"cited{k}", empty) for k in (1, 2, 3)])))
    return df.where((F.col("type") == "formula") & (F.size(before) == 1)).select("id", before[0].alias("label"))


def numbered_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered headings confirmed by a sibling or their parent."""
    number = F.regexp_extract("content", r"^\s*([0-9]+(?:\.[0-9]+)*)\s", 1)
    parts = F.split(number, r"\.")
    h = ordered_units(spark, sf).where(F.col("type") == "title").where(number != "").select("doc_id", "id", "pos", F.array_join(F.slice(parts, 1, F.size(parts) - 1), ".").alias("parent"), parts[F.size(parts) - 1].cast("int").alias("num"))
    return structure.confirmed_headings(h)


def asof_chapter(spark: SparkSession, sf: str) -> DataFrame:
    """The last chapter heading before each unit."""
    df = sequence.carried(ordered_units(spark, sf), ["doc_id"], {"chapter_id": F.when(F.col("level") == 1, F.col("id"))})
    return df.select("id", "chapter_id")


def _constraints(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "unit_constraints"), ["id"]).where("deleted_at is null")


def _scoped(spark: SparkSession, sf: str) -> DataFrame:
    ordered = ordered_units(spark, sf)
    # the level of the section in which the condition stands; before any heading the first title of the top level ends it
    inside = sequence.carried(ordered, ["doc_id"], {"section_level": F.col("level")}, inclusive=True)
    at = inside.select(F.col("id").alias("source_id"), "doc_id", F.col("pos").alias("start_pos"), F.coalesce("section_level", F.lit(1)).alias("level"))
    constraints = _constraints(spark, sf).join(at, "source_id").select("id", "doc_id", F.col("type").alias("kind"), "start_pos", "level", "source_id", "status")
    ends = structure.scope_ends(constraints, ordered)
    return Scratch(spark, "scopes").table("scopes", ends.join(constraints.select("id", "source_id", "status"), "id"))


def constraint_scopes(spark: SparkSession, sf: str) -> DataFrame:
    """The positions from and up to which each condition holds."""
    return _scoped(spark, sf).select("id", "doc_id", "start_pos", "end_pos")


def interval_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Packages with the number of certain conditions whose scope holds all of their core units, the source not among them."""
    scopes = _scoped(spark, sf).where("status = 'certain' and end_pos >= start_pos")
    members = structure.package_members(latest(table(spark, sf, "context_packages"), ["id"])).where("role = 'core'")
    at = ordered_units(spark, sf).select(F.col("id").alias("member_id"), "doc_id", "pos")
    core = members.join(at, "member_id").groupBy("package_id", "doc_id").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    # a scope is a few dyadic blocks, however long it is, and a package asks in the blocks around its first unit
    cover = scopes.select("doc_id", "start_pos", "end_pos", "id", F.explode(structure.blocks_of(F.col("start_pos"), F.col("end_pos"))).alias("_b"))
    asks = core.withColumn("_b", F.explode(structure.blocks_around(F.col("lo"))))
    hits = asks.join(cover, ["doc_id", "_b"]).where((F.col("start_pos") < F.col("lo")) & (F.col("end_pos") >= F.col("hi")))
    return hits.groupBy("package_id", "doc_id").agg(F.countDistinct("id").alias("n_constraints"))


def neighbour_support(spark: SparkSession, sf: str) -> DataFrame:
    """Passages and titles within two positions of each formula."""
    ordered = ordered_units(spark, sf)
    near = structure.neighbours(ordered, 2, F.col("type").isin("passage", "title"))
    return near.join(ordered.where("type = 'formula'").select("id"), "id", "left_semi")


def package_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Packages with their members resolved: text of core units in order, and members that do not resolve."""
    members = structure.package_members(latest(table(spark, sf, "context_packages"), ["id"]))
    units = structure.live_units(table(spark, sf, "units")).select(F.col("id").alias("member_id"), F.lit(1).alias("is_unit"), F.length(F.coalesce("content", F.lit(""))).alias("n_chars"))
    constraints = _constraints(spark, sf).select(F.col("id").alias("member_id"), F.lit(1).alias("is_constraint"))
    df = members.join(units, "member_id", "left").join(constraints, "member_id", "left")
    found = F.when(F.col("role") == "constraint", F.col("is_constraint")).otherwise(F.col("is_unit"))
    return df.groupBy("package_id").agg(
        F.count("*").alias("n_members"), F.count_if(found.isNull()).alias("n_unresolved"), F.coalesce(F.sum(F.when(F.col("role") == "core", F.col("n_chars"))), F.lit(0)).cast("long").alias("core_chars"),
        F.count_if(F.col("role") == "constraint").alias("n_constraints"),
    )


def section_window(spark: SparkSession, sf: str) -> DataFrame:
    """For each package the number of units of the core's sections within eight positions of the core."""
    sections = _sections(spark, sf).withColumn("section_id", F.coalesce("section_id", F.lit(-1)))
    members = structure.package_members(latest(table(spark, sf, "context_packages"), ["id"])).where("role = 'core'")
    at = sections.select(F.col("id").alias("member_id"), "doc_id", "section_id", "pos")
    spans = members.join(at, "member_id").groupBy("package_id", "doc_id", "section_id").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    width = 32
    asks = spans.withColumn("_k", F.explode(F.sequence(F.floor((F.col("lo") - 8) / width), F.floor((F.col("hi") + 8) / width))))
    near = asks.join(sections.select("doc_id", "section_id", "id", "pos", F.floor(F.col("pos") / width).alias("_k")), ["doc_id", "section_id", "_k"]).where(F.col("pos").between(F.col("lo") - 8, F.col("hi") + 8))
    return near.groupBy("package_id").agg(F.countDistinct("id").alias("n_units"))


def conflict_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Units whose conditions of one kind state different values."""
    return structure.conflicts(_constraints(spark, sf).withColumnRenamed("type", "kind"))


def document_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document: units, headings, hits, rule units, edges and the deepest section."""
    units = ordered_units(spark, sf)
    hits = structure.pattern_matches(structure.live_units(table(spark, sf, "units")), patterns(spark)).groupBy(F.col("unit_id").alias("id")).agg(F.count("*").alias("hits"), F.max((F.col("group") == "rule").cast("int")).alias("rule"))
    paths = structure.section_path(units, F.col("level"), F.col("content")).join(hits, "id", "left")
    return paths.groupBy("doc_id").agg(
        F.count("*").alias("n_units"), F.count("level").alias("n_headings"), F.coalesce(F.sum("hits"), F.lit(0)).alias("n_hits"), F.coalesce(F.sum("rule"), F.lit(0)).cast("long").alias("n_rule_units"),
        (F.count("*") - 1).alias("n_edges"), F.max(F.size("section_path")).alias("depth"),
    )


QUERIES = {
    f.__name__: f
    for f in (reading_order, next_edges, section_path, continuations, pattern_matches, role_routing, front_matter_cut, unique_label_join, nearest_assets, introduced_formulas, formula_runs, lookback_label, numbered_headings, asof_chapter, constraint_scopes, interval_containment, neighbour_support, package_resolve, section_window, conflict_groups, document_summary)
}

_C = """, uc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn_ FROM unit_constraints) WHERE rn_ = 1 AND deleted_at IS NULL)"""
_OPEN = ", hd AS (SELECT doc_id, pos, content, coalesce((SELECT min(x.pos) FROM lv x WHERE x.doc_id = t.doc_id AND x.pos > t.pos AND x.level <= t.level), 1e9) AS closes FROM lv t WHERE level IS NOT NULL)\n"
_SCOPES = (
    _U
    + _C
    + """, c AS (SELECT uc.id, o.doc_id, uc.type AS kind, o.pos AS start_pos, uc.status, uc.source_id, coalesce((SELECT arg_max(l.level, l.pos) FROM lv l WHERE l.doc_id = o.doc_id AND l.level IS NOT NULL AND l.pos <= o.pos), 1) AS level FROM uc JOIN o ON o.id = uc.source_id),
sc AS (SELECT c.*, least(
    coalesce((SELECT min(l.pos) - 1 FROM lv l WHERE l.doc_id = c.doc_id AND l.level <= c.level AND l.pos > c.start_pos), 1e9),
    coalesce((SELECT min(d.start_pos) - 1 FROM c d WHERE d.doc_id = c.doc_id AND d.kind = c.kind AND d.start_pos > c.start_pos), 1e9),
    (SELECT max(x.pos) FROM o x WHERE x.doc_id = c.doc_id)) AS end_pos FROM c)"""
)
_P = """, cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn_ FROM context_packages) WHERE rn_ = 1),
m0 AS (SELECT id, 'core' AS role, core_unit_ids AS ids FROM cp UNION ALL SELECT id, 'support', support_unit_ids FROM cp UNION ALL SELECT id, 'constraint', constraint_ids FROM cp
  UNION ALL SELECT id, 'asset', asset_part_ids FROM cp UNION ALL SELECT id, 'unresolved', unresolved_ids FROM cp),
mem AS (SELECT DISTINCT id AS package_id, role, member_id FROM (SELECT id, role, unnest(ids) AS member_id FROM m0) WHERE member_id IS NOT NULL)"""

SQL = {
    "reading_order": _U + "SELECT id, doc_id, pos FROM o",
    "next_edges": _U + "SELECT id AS source_id, nxt AS target_id FROM (SELECT id, lead(id) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM o) WHERE nxt IS NOT NULL",
    "section_path": _U + _OPEN + "SELECT o.id, coalesce(string_agg(hd.content, ' / ' ORDER BY hd.pos), '') AS section_path FROM o LEFT JOIN hd ON hd.doc_id = o.doc_id AND hd.pos <= o.pos AND o.pos < hd.closes GROUP BY o.id",
    "continuations": _U
    + """SELECT id AS source_id, nid AS target_id FROM (SELECT *, lead(id) OVER w AS nid, lead(type) OVER w AS nt, lead(page) OVER w AS np, lead(content) OVER w AS nc FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
WHERE type = 'passage' AND nt = 'passage' AND np = page + 1 AND NOT regexp_matches(content, '[。！？；：.!?;:]\\s*$') AND regexp_matches(content, '\\S') AND NOT regexp_matches(nc, '^\\s*([（(]?[0-9]+[)）.、]|[-*•—])')""",
    "pattern_matches": _pattern_sql(),
    "role_routing": _pattern_sql().replace("SELECT id AS unit_id, pattern_id", ", g AS (SELECT id, list(DISTINCT \"group\") AS groups FROM m WHERE len(hits) > 0 GROUP BY 1), r AS (SELECT u.*, coalesce(groups, []) AS groups, coalesce(role, []) AS given FROM u LEFT JOIN g USING (id)) SELECT type, route, count(*) AS n_units FROM (SELECT type, CASE WHEN list_contains(groups, 'noise') OR list_contains(given, 'noise') THEN 'noise' WHEN rule AND concept THEN 'concept_and_rule' WHEN rule THEN 'rule' WHEN concept THEN 'concept' ELSE 'none' END AS route FROM (SELECT *, list_contains(groups, 'rule') OR list_contains(given, 'rule') OR list_contains(given, 'concept_and_rule') AS rule, list_contains(given, 'concept') OR list_contains(given, 'concept_and_rule') AS concept FROM r)) GROUP BY ALL --"),
    "front_matter_cut": _U + """, f AS (SELECT doc_id, max(pos) AS cut FROM lv WHERE level = 1 AND regexp_extract(content, '^\\s*(第|Chapter |Kapitel )\\s*([0-9]+)', 2) = '1' GROUP BY 1)
SELECT doc_id, count(*) AS n_units, min(pos) AS first_pos FROM o LEFT JOIN f USING (doc_id) WHERE pos >= coalesce(cut, 0) GROUP BY 1""",
    "unique_label_join": _U + """, a AS (SELECT doc_id, id, regexp_extract(content, '^\\s*(图|Bild |Figure |Fig\\. )([0-9]+-[0-9]+)', 2) AS label FROM u WHERE type = 'caption'),
l AS (SELECT doc_id, label, min(id) AS asset_id FROM a WHERE label <> '' GROUP BY ALL HAVING count(*) = 1),
c AS (SELECT doc_id, id, unnest(regexp_extract_all(content, '[0-9]+-[0-9]+')) AS label FROM u WHERE type <> 'title')
SELECT DISTINCT c.id AS unit_id, asset_id FROM c JOIN l USING (doc_id, label)""",
    "nearest_assets": _U + """, s AS (SELECT *, coalesce(sec, -1) AS section_id FROM h),
n AS (SELECT id, type, section_id,
  last_value(CASE WHEN type = 'figure' THEN struct_pack(i := id, s := section_id) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
  first_value(CASE WHEN type = 'figure' THEN struct_pack(i := id, s := section_id) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM s),
r AS (SELECT id, type, CASE WHEN b.s = section_id THEN b.i END AS before_id, CASE WHEN a.s = section_id THEN a.i END AS after_id FROM n)
SELECT id, before_id, after_id FROM r WHERE type = 'passage' AND (before_id IS NOT NULL OR after_id IS NOT NULL)""",
    "introduced_formulas": _U + """, n AS (SELECT id, type, content, first_value(CASE WHEN type IN ('formula', 'title', 'passage') THEN struct_pack(i := id, t := type) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS x FROM o)
SELECT id AS source_id, x.i AS target_id FROM n WHERE type = 'passage' AND x.t = 'formula'""",
    "formula_runs": _U + """, r AS (SELECT *, sum(CASE WHEN type IN ('title', 'table', 'formula') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT s.id AS source_id, t.id AS target_id FROM r s JOIN r t ON s.doc_id = t.doc_id AND s.run = t.run WHERE s.type = 'formula' AND t.type = 'passage'""",
    "lookback_label": _U + """, x AS (SELECT id, type, list_distinct(flatten([coalesce(lag(c, 1) OVER w, []), coalesce(lag(c, 2) OVER w, []), coalesce(lag(c, 3) OVER w, [])])) AS before
  FROM (SELECT *, regexp_extract_all(coalesce(content, ''), '[0-9]+-[0-9]+') AS c FROM o) WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT id, before[1] AS label FROM x WHERE type = 'formula' AND len(before) = 1""",
    "numbered_headings": _U + """, x AS (SELECT doc_id, id, pos, string_split(regexp_extract(content, '^\\s*([0-9]+(\\.[0-9]+)*)\\s', 1), '.') AS p FROM o WHERE type = 'title' AND regexp_matches(content, '^\\s*[0-9]+(\\.[0-9]+)*\\s')),
y AS (SELECT doc_id, id, pos, array_to_string(p[:len(p) - 1], '.') AS parent, CAST(p[len(p)] AS INTEGER) AS num FROM x)
SELECT DISTINCT a.doc_id, a.id FROM y a JOIN y b ON a.doc_id = b.doc_id AND a.id <> b.id AND abs(a.pos - b.pos) <= 160
WHERE (a.parent = b.parent AND abs(a.num - b.num) = 1) OR (b.pos < a.pos AND (CASE WHEN b.parent <> '' THEN b.parent || '.' ELSE '' END) || b.num = a.parent)""",
    "asof_chapter": _U + "SELECT id, last_value(CASE WHEN level = 1 THEN id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS chapter_id FROM lv",
    "constraint_scopes": _SCOPES + "SELECT id, doc_id, start_pos, CAST(end_pos AS BIGINT) AS end_pos FROM sc",
    "interval_containment": _SCOPES + _P + """, core AS (SELECT package_id, doc_id, min(pos) AS lo, max(pos) AS hi FROM mem JOIN o ON o.id = member_id WHERE mem.role = 'core' GROUP BY ALL)
SELECT package_id, core.doc_id, count(DISTINCT sc.id) AS n_constraints FROM core JOIN sc ON sc.doc_id = core.doc_id AND start_pos < lo AND end_pos >= hi WHERE status = 'certain' AND end_pos >= start_pos GROUP BY ALL""",
    "neighbour_support": _U + "SELECT a.id, b.id AS neighbour_id FROM o a JOIN o b ON a.doc_id = b.doc_id AND abs(a.pos - b.pos) BETWEEN 1 AND 2 WHERE a.type = 'formula' AND b.type IN ('passage', 'title')",
    "package_resolve": _U + _C + _P + """SELECT package_id, count(*) AS n_members, count(*) FILTER (CASE WHEN mem.role = 'constraint' THEN uc.id ELSE u.id END IS NULL) AS n_unresolved,
  coalesce(CAST(sum(CASE WHEN mem.role = 'core' THEN length(coalesce(u.content, '')) * CASE WHEN u.id IS NULL THEN NULL ELSE 1 END END) AS BIGINT), 0) AS core_chars, count(*) FILTER (mem.role = 'constraint') AS n_constraints
FROM mem LEFT JOIN u ON u.id = member_id LEFT JOIN uc ON uc.id = member_id GROUP BY 1""",
    "section_window": _U + _P + """, s AS (SELECT id, doc_id, pos, coalesce(sec, -1) AS section_id FROM h), sp AS (SELECT package_id, doc_id, section_id, min(pos) AS lo, max(pos) AS hi FROM mem JOIN s ON s.id = member_id WHERE role = 'core' GROUP BY ALL)
SELECT package_id, count(DISTINCT s.id) AS n_units FROM sp JOIN s ON s.doc_id = sp.doc_id AND s.section_id = sp.section_id AND s.pos BETWEEN lo - 8 AND hi + 8 GROUP BY 1""",
    "conflict_groups": _U + _C + "SELECT source_id, type AS kind, count(DISTINCT value) AS n_values FROM uc WHERE source_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT value) >= 2",
    "document_summary": _pattern_sql().replace("SELECT id AS unit_id, pattern_id", ", g AS (SELECT id, sum(len(hits)) AS hits, max(CASE WHEN \"group\" = 'rule' THEN 1 ELSE 0 END) AS rule FROM m WHERE len(hits) > 0 GROUP BY 1) SELECT doc_id, count(*) AS n_units, count(level) AS n_headings, CAST(coalesce(sum(hits), 0) AS BIGINT) AS n_hits, CAST(coalesce(sum(rule), 0) AS BIGINT) AS n_rule_units, count(*) - 1 AS n_edges, CAST(max(dp.n) AS INTEGER) AS depth FROM h LEFT JOIN g USING (id) LEFT JOIN dp USING (id) GROUP BY 1 --").replace(", m AS (", _OPEN + ", dp AS (SELECT o.id, count(hd.pos) AS n FROM o LEFT JOIN hd ON hd.doc_id = o.doc_id AND hd.pos <= o.pos AND o.pos < hd.closes GROUP BY 1), m AS (", 1),
}
