"""Queries of packages, reviews and the graph service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.operators import concepts as ops
from tracewright.operators import gates, structure
from tracewright.queries import alignment, knowledge, problems
from tracewright.queries import structure as units
from tracewright.session import Scratch
from tracewright.tables import latest, table

LIST_MARK = r"^\s*([-*•·]|[(（]?[0-9]{1,3}[)）.、]|[①-⑳])"
#: Rows of a list run, nodes of a tree page, packages of a list page.
RUN, PAGE, PACKAGES = 15, 180, 20


def list_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Each title with the rows of the list that follows it without a gap, at most 15 rows on."""
    df = units.ordered_units(spark, sf)
    title = F.col("type") == "title"
    entry = ~title & F.coalesce(F.col("content").rlike(LIST_MARK), F.lit(False))
    links = structure.run_links(df, title, entry, ~title & ~entry)
    at = df.select("id", "pos")
    near = links.join(at.select(F.col("id").alias("source_id"), F.col("pos").alias("a")), "source_id").join(at.select(F.col("id").alias("target_id"), F.col("pos").alias("b")), "target_id")
    return near.where(F.col("b") - F.col("a") <= RUN).select("source_id", "target_id")


def claiming_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Every unit in a core or among the support with the package that claims it: the first in order of time and id, cores before support."""
    p = latest(table(spark, sf, "context_packages"), ["id"])
    members = structure.package_members(p).where("role in ('core', 'support')").join(p.select(F.col("id").alias("package_id"), "created_at"), "package_id")
    claim = F.min_by(F.struct("package_id", "role"), F.struct(F.col("role") != "core", "created_at", "package_id"))
    return members.groupBy(F.col("member_id").alias("unit_id")).agg(claim.alias("c"), F.countDistinct("package_id").alias("n_packages")).select("unit_id", "c.package_id", "c.role", "n_packages")


def transition_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Transitions of live rules by object: how often, in how many rules, and how many ends name no state."""
    t = knowledge._rules(spark, sf).select(F.col("id").alias("rule_id"), F.explode("transitions").alias("t")).select("rule_id", "t.*")
    s = knowledge._states(spark, sf).select("state_id", F.lit(1).alias("known"))
    ends = t.join(s.select(F.col("state_id").alias("from_state_id"), F.col("known").alias("a")), "from_state_id", "left").join(s.select(F.col("state_id").alias("to_state_id"), F.col("known").alias("b")), "to_state_id", "left")
    return ends.groupBy("object").agg(F.count("*").alias("n_transitions"), F.countDistinct("rule_id").alias("n_rules"), F.sum(F.when(F.col("a").isNull(), 1).otherwise(0) + F.when(F.col("b").isNull(), 1).otherwise(0)).alias("n_open_ends"))


def relation_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Relations by kind and ends with the ids that state them, the best status and the first time."""
    r = table(spark, sf, "concept_relations").where("child_concept_id is not null and parent_concept_id is not null")
    ids = F.array_join(F.array_sort(F.collect_set("relation_id")), "|")
    return r.groupBy(problems.relation_kind().alias("kind"), "child_concept_id", "parent_concept_id").agg(ids.alias("relation_ids"), F.max((F.upper("registration_status") == "APPROVED").cast("int")).alias("approved"), F.date_format(F.min("created_at"), "yyyy-MM-dd").alias("first_day"))


def member_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Core and support of each package as sets: common, only core, only support, and the shares that these are."""
    p = latest(table(spark, sf, "context_packages"), ["id"])
    ids = lambda c: F.array_distinct(F.array_compact(F.coalesce(c, F.array().cast("array<string>"))))
    core, support = ids("core_unit_ids"), ids("support_unit_ids")
    both = F.size(F.array_intersect(core, support))
    return p.select("id", both.alias("common"), F.size(F.array_except(core, support)).alias("only_core"), F.size(F.array_except(support, core)).alias("only_support"), F.round(F.coalesce(F.try_divide(both, F.size(F.array_union(core, support))), F.lit(1.0)), 4).alias("jaccard"))


def gold_join(spark: SparkSession, sf: str) -> DataFrame:
    """The normalised states of rules as gold, joined on rule, side and place with the raw ones as predictions."""
    s = knowledge._states(spark, sf).select("rule_id", "side", "pos", "state_id", "normalized_state", "raw_state")
    return gates.gold_metrics(s.select("rule_id", "side", "pos", "state_id", F.col("normalized_state").alias("v")), s.where("raw_state is not null").select("rule_id", "side", "pos", "state_id", F.col("raw_state").alias("v")), ["rule_id", "side", "pos", "state_id"], "v")


def answer_protocol(spark: SparkSession, sf: str) -> DataFrame:
    """Replies that name units of packages, held against their cases: how many break which rule of the protocol."""
    p = latest(table(spark, sf, "context_packages"), ["id"])
    cases = p.select(F.col("id").alias("case_id"), F.array_compact("core_unit_ids").alias("candidates"), F.array_compact("support_unit_ids").alias("evidence"))
    n = F.size(F.coalesce("constraint_ids", F.array().cast("array<string>")))
    decision = F.element_at(F.array(*map(F.lit, ("BIND", "REWRITE", "CREATE", "MERGE"))), F.pmod(n, F.lit(4)) + 1)
    replies = p.where("constraint_ids is not null").select(F.col("id").alias("case_id"), decision.alias("decision"), F.slice(F.array_compact("core_unit_ids"), 1, 2).alias("target_ids"), F.array_compact("asset_part_ids").alias("evidence_ids"))
    return gates.answers(cases, replies, ("BIND", "REWRITE", "CREATE", "DISCARD")).groupBy("check").agg(F.count("*").alias("n"))


def admission_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """Unapproved concepts on the ladder of admission: by whether they are taken up and, if not, the first reason."""
    c = knowledge._concepts(spark, sf)
    status = F.upper(F.coalesce("registration_status", F.lit("")))
    checks = F.array(F.coalesce(F.col("canonical_name").rlike(r"\S"), F.lit(False)), F.col("definition").isNotNull(), ~F.coalesce(F.col("canonical_name").rlike("^[0-9]+$"), F.lit(False)))
    n = F.size(F.coalesce("evidence_ids", F.array().cast("array<string>")))
    cases = c.where(status != "APPROVED").select("concept_id", F.col("canonical_name").alias("name"), F.when(n >= 2, "HIGH").otherwise("LOW").alias("band"), F.when(status == "REJECTED", "REJECT").when(status == "DEFERRED", "DEFER").otherwise("APPROVE").alias("decision"), checks.alias("checks"))
    taken = knowledge._approved(spark, sf).where("canonical_name is not null").select(F.lower("canonical_name").alias("term"), "concept_id")
    return gates.admitted(cases, taken).groupBy("accepted", "reason").agg(F.count("*").alias("n"))


def ancestor_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Concepts of the hierarchy that a tree filtered for 焊 shows: those whose name has it, and all above them."""
    hit = knowledge._concepts(spark, sf).where(F.contains("canonical_name", F.lit("焊"))).select("concept_id")
    tree = problems._tree(spark, sf)
    rows = Scratch(spark, "marks").table("rows", tree.rows())
    own = rows.join(hit, "concept_id", "left_semi").select("concept_id", F.lit("hit").alias("mark"))
    above = tree.descendants().join(hit.withColumnRenamed("concept_id", "descendant"), "descendant", "left_semi").select(F.col("ancestor").alias("concept_id"), F.lit("path").alias("mark"))
    return own.unionByName(above).groupBy("concept_id").agg(F.min("mark").alias("mark"))


def tree_page(spark: SparkSession, sf: str) -> DataFrame:
    """The first 180 nodes of each tree by depth and id, with whether the tree has more."""
    rows = problems._tree(spark, sf).rows().where("depth >= 0")
    # a first cut by parts of a tree keeps a hot root out of one task
    part = Window.partitionBy("root_id", F.pmod(F.xxhash64("concept_id"), F.lit(64))).orderBy("depth", "concept_id")
    cut = rows.withColumn("_k", F.row_number().over(part)).where(F.col("_k") <= PAGE + 1)
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("root_id").orderBy("depth", "concept_id")))
    size = rows.groupBy("root_id").agg(F.count("*").alias("n"))
    return ranked.where(F.col("rank") <= PAGE).join(size, "root_id").select("root_id", "concept_id", "depth", "rank", (F.col("n") > PAGE).alias("truncated"))


def package_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of packages in each sort mode: newest, largest core, most conditions."""
    p = latest(table(spark, sf, "context_packages"), ["id"])
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    modes = {"newest": F.col("created_at"), "core": size("core_unit_ids"), "conditions": size("constraint_ids")}
    out = None
    for mode, by in modes.items():
        page = p.select("id", by.alias("by")).orderBy(F.desc("by"), "id").limit(PACKAGES).select(F.lit(mode).alias("mode"), "id")
        out = page if out is None else out.unionByName(page)
    return out


def adjacent_text(spark: SparkSession, sf: str) -> DataFrame:
    """For each asset the passages directly before and after it in the same section."""
    df = units._sections(spark, sf).withColumn("section_id", F.coalesce("section_id", F.lit(-1)))
    near = structure.neighbours(df, 1, F.col("type") == "passage")
    of = df.where(F.col("type").isin("figure", "table", "formula")).select("id", "section_id")
    return near.join(of, "id").join(df.select(F.col("id").alias("neighbour_id"), "section_id"), ["neighbour_id", "section_id"]).select("id", "neighbour_id")


def recall_by_tier(spark: SparkSession, sf: str) -> DataFrame:
    """How many objects of each band an approved name binds, as a share of the objects and of their occurrences."""
    bands = alignment.rank_bands(spark, sf).select("name", "frequency", "band")
    bound = ops.names_of(knowledge._approved(spark, sf)).groupBy("term").agg(F.countDistinct("concept_id").alias("k")).where("k = 1").select(F.col("term").alias("name"), F.lit(1).alias("hit"))
    df = bands.join(bound, "name", "left")
    share = lambda a, b: F.round(F.try_divide(a, b), 4)
    hit = F.sum(F.when(F.col("hit") == 1, F.col("frequency")).otherwise(0))
    return df.groupBy("band").agg(F.count("*").alias("n"), F.count("hit").alias("n_hit"), share(F.count("hit"), F.count("*")).alias("recall"), share(hit, F.sum("frequency")).alias("weighted_recall"))


QUERIES = {
    f.__name__: f
    for f in (list_runs, claiming_sweep, transition_detail, relation_merge, member_overlap, gold_join, answer_protocol, admission_ladder, ancestor_marks, tree_page, package_pages, adjacent_text, recall_by_tier)
}

_B, _U = knowledge._BASE, units._U
_CP = "cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn_ FROM context_packages) WHERE rn_ = 1)"
_SET = "list_distinct(list_filter(coalesce({}, []), lambda x: x IS NOT NULL))"
SQL = {
    "list_runs": _U + f""", m AS (SELECT id, doc_id, pos, type = 'title' AS t, type <> 'title' AND coalesce(regexp_matches(content, '{LIST_MARK}'), false) AS e FROM o)
SELECT a.id AS source_id, b.id AS target_id FROM m a JOIN m b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + {RUN} WHERE a.t AND b.e AND NOT EXISTS (SELECT 1 FROM m x WHERE x.doc_id = a.doc_id AND x.pos > a.pos AND x.pos < b.pos AND NOT x.e)""",
    "claiming_sweep": f"""WITH {_CP}, m AS (SELECT DISTINCT id, created_at, role, unit_id FROM (SELECT id, created_at, 'core' AS role, unnest(core_unit_ids) AS unit_id FROM cp UNION ALL SELECT id, created_at, 'support', unnest(support_unit_ids) FROM cp) WHERE unit_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY role <> 'core', created_at, id) AS k FROM m), n AS (SELECT unit_id, count(DISTINCT id) AS n_packages FROM m GROUP BY 1)
SELECT unit_id, id AS package_id, role, n_packages FROM r JOIN n USING (unit_id) WHERE k = 1""",
    "transition_detail": _B + """, t AS (SELECT id AS rule_id, x.object AS object, x.from_state_id AS f, x.to_state_id AS g FROM (SELECT id, unnest(transitions) AS x FROM ru))
SELECT t.object, count(*) AS n_transitions, count(DISTINCT t.rule_id) AS n_rules, CAST(sum((a.state_id IS NULL)::INT + (b.state_id IS NULL)::INT) AS BIGINT) AS n_open_ends FROM t LEFT JOIN st a ON a.state_id = f LEFT JOIN st b ON b.state_id = g GROUP BY 1""",
    "relation_merge": _B + """SELECT kind, child_concept_id, parent_concept_id, array_to_string(list_sort(list(DISTINCT relation_id)), '|') AS relation_ids, max((upper(registration_status) = 'APPROVED')::INTEGER) AS approved, strftime(min(created_at), '%Y-%m-%d') AS first_day
FROM rk WHERE child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL GROUP BY ALL""",
    "member_overlap": f"""WITH {_CP}, s AS (SELECT id, {_SET.format("core_unit_ids")} AS c, {_SET.format("support_unit_ids")} AS p FROM cp)
SELECT id, CAST(len(list_intersect(c, p)) AS INTEGER) AS common, CAST(len(c) - len(list_intersect(c, p)) AS INTEGER) AS only_core, CAST(len(p) - len(list_intersect(c, p)) AS INTEGER) AS only_support, round(CASE WHEN len(c) + len(p) = 0 THEN 1.0 ELSE len(list_intersect(c, p)) / (len(c) + len(p) - len(list_intersect(c, p))) END, 4) AS jaccard FROM s""",
    "gold_join": _B + "SELECT count(*) AS n_gold, count(raw_state) AS n_found, count(*) FILTER (raw_state IS NOT NULL AND normalized_state IS NOT DISTINCT FROM raw_state) AS n_right, round(count(*) FILTER (raw_state IS NOT NULL AND normalized_state IS NOT DISTINCT FROM raw_state) / count(*), 4) AS accuracy FROM st",
    "answer_protocol": f"""WITH {_CP}, x AS (SELECT id, constraint_ids IS NOT NULL AS replied, coalesce(len(constraint_ids), 0) % 4 AS d, list_filter(coalesce(core_unit_ids, []), lambda x: x IS NOT NULL)[1:2] AS t, list_filter(coalesce(support_unit_ids, []), lambda x: x IS NOT NULL) AS e, list_filter(coalesce(asset_part_ids, []), lambda x: x IS NOT NULL) AS g FROM cp),
v AS (SELECT 'one_reply' AS "check" FROM x WHERE NOT replied UNION ALL SELECT 'known_decision' FROM x WHERE NOT replied OR d = 3
  UNION ALL SELECT 'target_count' FROM x WHERE replied AND NOT CASE d WHEN 0 THEN len(t) = 1 WHEN 1 THEN len(t) BETWEEN 1 AND 4 ELSE len(t) = 0 END
  UNION ALL SELECT 'evidence_was_given' FROM x WHERE replied AND len(list_filter(g, lambda y: NOT list_contains(e, y))) > 0)
SELECT "check", count(*) AS n FROM v GROUP BY 1""",
    "admission_ladder": _B + """, tk AS (SELECT lower(canonical_name) AS term, min(concept_id) AS owner FROM ap WHERE canonical_name IS NOT NULL GROUP BY 1),
x AS (SELECT co.*, owner, upper(coalesce(registration_status, '')) AS s FROM co LEFT JOIN tk ON lower(canonical_name) = term WHERE upper(coalesce(registration_status, '')) <> 'APPROVED'),
y AS (SELECT CASE WHEN s = 'REJECTED' THEN 'rejected' WHEN s = 'DEFERRED' THEN 'deferred' WHEN coalesce(len(evidence_ids), 0) < 2 THEN 'band'
  WHEN NOT (coalesce(regexp_matches(canonical_name, '\\S'), false) AND definition IS NOT NULL AND NOT coalesce(regexp_matches(canonical_name, '^[0-9]+$'), false)) THEN 'checks' WHEN owner IS NOT NULL AND owner <> concept_id THEN 'name_taken' END AS reason FROM x)
SELECT reason IS NULL AS accepted, reason, count(*) AS n FROM y GROUP BY ALL""",
    "ancestor_marks": problems._P5_SQL + """, co AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY ingested_at DESC) AS rn_ FROM concepts) WHERE rn_ = 1), hit AS (SELECT concept_id AS id FROM co WHERE contains(canonical_name, '焊'))
SELECT id AS concept_id, min(mark) AS mark FROM (SELECT concept_id AS id, 'hit' AS mark FROM tree WHERE concept_id IN (SELECT id FROM hit) UNION ALL SELECT anc, 'path' FROM anc WHERE descendant IN (SELECT id FROM hit)) GROUP BY 1""",
    "tree_page": problems._P5_SQL + f"""SELECT root_id, concept_id, depth, CAST(rank AS INTEGER) AS rank, n > {PAGE} AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY root_id ORDER BY depth, concept_id) AS rank, count(*) OVER (PARTITION BY root_id) AS n FROM tree WHERE depth >= 0) WHERE rank <= {PAGE}""",
    "package_pages": f"WITH {_CP} " + " UNION ALL ".join(f"(SELECT '{m}' AS mode, id FROM cp ORDER BY {by} DESC NULLS LAST, id LIMIT {PACKAGES})" for m, by in (("newest", "created_at"), ("core", "coalesce(len(core_unit_ids), 0)"), ("conditions", "coalesce(len(constraint_ids), 0)"))),
    "adjacent_text": _U + "SELECT a.id, b.id AS neighbour_id FROM h a JOIN h b ON a.doc_id = b.doc_id AND abs(a.pos - b.pos) = 1 AND coalesce(a.sec, -1) = coalesce(b.sec, -1) WHERE a.type IN ('figure', 'table', 'formula') AND b.type = 'passage'",
}


SQL |= {
    "recall_by_tier": alignment._SRC
        + f""", r AS (SELECT name, frequency, {alignment._RANK} AS rank, count(*) OVER () AS population FROM src), b AS (SELECT name, frequency, {alignment._BAND} AS band FROM r),
k AS (SELECT term FROM nm JOIN ap USING (concept_id) GROUP BY 1 HAVING count(DISTINCT concept_id) = 1)
SELECT band, count(*) AS n, count(term) AS n_hit, round(count(term) / count(*), 4) AS recall, round(sum(CASE WHEN term IS NULL THEN 0 ELSE frequency END) / sum(frequency), 4) AS weighted_recall FROM b LEFT JOIN k ON name = term GROUP BY 1""",
}
