"""Queries over concepts, rules and their graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions.text import normalize_name, normalize_text, stable_id
from tracewright.operators import concepts as ops
from tracewright.operators import gates, hierarchy
from tracewright.queries.problems import isa_links, relation_kind
from tracewright.session import Scratch
from tracewright.tables import latest, table


def _concepts(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "concepts"), ["concept_id"])


def _approved(spark: SparkSession, sf: str) -> DataFrame:
    return _concepts(spark, sf).where("upper(registration_status) = 'APPROVED'")


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "rule_states"), ["state_id"])


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "rules"), ["id"]).where("deleted_at is null")


def object_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds: distinct normalised objects with the first spelling in state order, their rules counted."""
    s = _states(spark, sf).withColumn("normalized_name", normalize_name(F.col("object"))).where("normalized_name <> ''")
    out = s.groupBy("normalized_name").agg(F.min_by("object", "state_id").alias("raw_name"), F.countDistinct("rule_id").alias("n_rules"), F.countDistinct("state_id").alias("n_states"))
    return out.select(stable_id("seed", F.col("normalized_name")).alias("seed_id"), "normalized_name", "raw_name", "n_rules", "n_states")


def exact_binding(spark: SparkSession, sf: str) -> DataFrame:
    """Objects bound to concepts by exact name or alias, ambiguous ones told apart."""
    bound = ops.bind_exact(_states(spark, sf).select(F.col("object").alias("value")), ops.names_of(_concepts(spark, sf)))
    return bound.groupBy("status", "method").agg(F.count("*").alias("n_values"), F.countDistinct("concept_id").alias("n_concepts"))


def status_lattice(spark: SparkSession, sf: str) -> DataFrame:
    """How each object resolves: MATCHED, AMBIGUOUS, PROPOSED (only unapproved bear it), REJECTED or NO_MATCH."""
    names = ops.names_of(_concepts(spark, sf)).join(_concepts(spark, sf).select("concept_id", F.upper(F.coalesce("registration_status", F.lit("CANDIDATE"))).alias("status")), "concept_id")
    per = names.groupBy("term").agg(F.count_if(F.col("status") == "APPROVED").alias("ok"), F.count_if(F.col("status") == "REJECTED").alias("no"), F.count("*").alias("n"))
    v = _states(spark, sf).where("object is not null").select("state_id", normalize_text(F.col("object")).alias("term"))
    ladder = F.when(F.col("n").isNull(), "NO_MATCH").when(F.col("ok") > 1, "AMBIGUOUS").when(F.col("ok") == 1, "MATCHED").when(F.col("no") == F.col("n"), "REJECTED").otherwise("PROPOSED")
    return v.join(per, "term", "left").groupBy(ladder.alias("status")).agg(F.count("*").alias("n_states"), F.countDistinct("term").alias("n_terms"))


def _approved_terms(spark: SparkSession, sf: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Names of approved concepts, (term_id, term), and the distinct ones, (term), as written tables."""
    terms = scratch.table("terms", _approved(spark, sf).select(F.col("concept_id").alias("term_id"), F.col("canonical_name").alias("term")).where("term is not null").distinct())
    return terms, scratch.table("words", terms.select("term").distinct())


def contained_terms(spark: SparkSession, sf: str) -> DataFrame:
    """How often passages name each approved concept."""
    units = latest(table(spark, sf, "units"), ["id"]).where("type = 'passage' and content is not null and deleted_at is null").select(F.col("id").alias("text_id"), F.col("content").alias("text"))
    terms, words = _approved_terms(spark, sf, Scratch(spark, "contained"))
    # concepts of the same name share its counts
    per = ops.contained(units, words).groupBy("term").agg(F.count("*").alias("n_units"), F.sum("hits").alias("n_hits"))
    return terms.join(per, "term").select("term_id", "term", "n_units", "n_hits")


def lexical_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of each passage that approved names cover."""
    units = latest(table(spark, sf, "units"), ["id"]).where("type = 'passage' and content is not null and deleted_at is null").select(F.col("id").alias("text_id"), F.col("content").alias("text"))
    return ops.coverage(units, _approved(spark, sf).where("canonical_name is not null").select(F.col("canonical_name").alias("term")))


def evidence_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 24 best passages for each approved concept: name, definition and taxonomy sentences raise the score."""
    units = latest(table(spark, sf, "units"), ["id"]).where("content is not null and deleted_at is null").select(F.col("id").alias("text_id"), F.col("content").alias("text"), "type")
    terms, words = _approved_terms(spark, sf, Scratch(spark, "evidence"))
    score = F.lit(45) + F.when(F.col("text").rlike("本节所说的|Gemeint ist|The word"), 25).otherwise(0) + F.when(F.col("text").rlike("包括|分为|属于"), 25).otherwise(0) + F.when(F.col("type") == "title", 20).otherwise(0)
    # concepts of the same name share its ranking; a first cut per bucket keeps a frequent name's passages out of one task
    s = ops.contained(units, words).select("term", "text_id", score.alias("score")).withColumn("_k", F.pmod(F.xxhash64("text_id"), F.lit(64)))
    best = [F.desc("score"), "text_id"]
    cut = s.withColumn("_r", F.row_number().over(Window.partitionBy("term", "_k").orderBy(*best))).where("_r <= 24")
    top = cut.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy(*best))).where("rank <= 24")
    return terms.join(top, "term").select(F.col("term_id").alias("concept_id"), F.col("text_id").alias("unit_id"), "score", "rank")


def ngram_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The three most similar approved names for each distinct object, by character n-grams."""
    scratch = Scratch(spark, "ngrams")
    docs = _approved(spark, sf).groupBy(F.col("concept_id").alias("id")).agg(F.first("canonical_name").alias("name"), F.first("aliases").alias("al"))
    docs = docs.select("id", normalize_text(F.concat_ws(" ", "name", F.concat_ws(" ", "al"))).alias("text"))
    index = scratch.table("index", ops.tfidf(docs))
    names = _states(spark, sf).where("object is not null").select(normalize_text(F.col("object")).alias("text")).distinct()
    return ops.similar(names.select(F.col("text").alias("id"), "text").where("text <> ''"), index, 3).where("score >= 0.2")


def candidate_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates per object from three channels, exact first, then contained names, then similar ones; six at most."""
    scratch = Scratch(spark, "fusion")
    approved = _approved(spark, sf)
    values = scratch.table("values", _states(spark, sf).where("object is not null").select(normalize_text(F.col("object")).alias("value")).distinct().where("value <> ''"))
    names = scratch.table("names", ops.names_of(approved))
    exact = values.join(names, values["value"] == names["term"]).select("value", "concept_id", F.lit(1).alias("channel"), F.lit(1.0).alias("score"))
    inside = ops.contained_terms(values.select(F.col("value").alias("text_id"), F.col("value").alias("text")), names.select(F.col("concept_id").alias("term_id"), "term"))
    inside = inside.groupBy(F.col("text_id").alias("value"), F.col("term_id").alias("concept_id")).agg(F.max(F.length("term")).cast("double").alias("score")).withColumn("channel", F.lit(2))
    docs = names.groupBy(F.col("concept_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("term")), " ").alias("text"))
    alike = ops.similar(values.select(F.col("value").alias("id"), F.col("value").alias("text")), scratch.table("index", ops.tfidf(docs)), 6).where("score >= 0.2")
    alike = alike.select(F.col("query_id").alias("value"), F.col("id").alias("concept_id"), F.lit(3).alias("channel"), "score")
    pooled = exact.unionByName(inside.select("value", "concept_id", "channel", "score")).unionByName(alike)
    one = pooled.groupBy("value", "concept_id").agg(F.min("channel").alias("channel"), F.max_by("score", -F.col("channel")).alias("score"))
    w = Window.partitionBy("value").orderBy("channel", F.desc("score"), "concept_id")
    return one.withColumn("rank", F.row_number().over(w)).where("rank <= 6").select("value", "concept_id", "channel", "rank")


def part_links(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and wholes: PART_OF rows, and INCLUDES rows turned round."""
    kind = relation_kind()
    r = table(spark, sf, "concept_relations").where(kind.isin("PARTOF", "INCLUDES"))
    swap = kind == "INCLUDES"
    ends = r.select(F.when(swap, F.col("parent_concept_id")).otherwise(F.col("child_concept_id")).alias("child"), F.when(swap, F.col("child_concept_id")).otherwise(F.col("parent_concept_id")).alias("parent"))
    return ends.where("child is not null and parent is not null and child <> parent").distinct()


def relation_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Relations by kind and ends, with how often and by how many records each is stated."""
    r = table(spark, sf, "concept_relations").where("child_concept_id is not null and parent_concept_id is not null")
    return r.groupBy(relation_kind().alias("kind"), "child_concept_id", "parent_concept_id").agg(F.countDistinct("relation_id").alias("n_records"), F.count("*").alias("n_rows"))


def cycle_free_links(spark: SparkSession, sf: str) -> DataFrame:
    """IS_A and part links, as one graph of parents, left when those that would close a cycle are left out in sorted order."""
    scratch = Scratch(spark, "acyclic")
    return ops.cycle_free(isa_links(spark, sf).unionByName(part_links(spark, sf)), scratch)


def direct_links(spark: SparkSession, sf: str) -> DataFrame:
    """The acyclic links without those that a longer path replaces."""
    scratch = Scratch(spark, "direct")
    return ops.reduce_transitive(scratch.table("acyclic", cycle_free_links(spark, sf)), scratch)


def kg_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by label: nodes, relations by kind and bindings by status."""
    nodes = [("concepts", _concepts(spark, sf), "concept_id"), ("rules", _rules(spark, sf), "id"), ("states", _states(spark, sf), "state_id")]
    out = None
    for label, df, key in nodes:
        part = df.agg(F.lit("node").alias("kind"), F.lit(label).alias("label"), F.countDistinct(key).alias("n"))
        out = part if out is None else out.unionByName(part)
    relations = table(spark, sf, "concept_relations").groupBy(F.lit("relation").alias("kind"), F.coalesce(relation_kind(), F.lit("")).alias("label")).agg(F.countDistinct("relation_id").alias("n"))
    return out.unionByName(relations)


def _degrees(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "concept_relations").where("child_concept_id is not null and parent_concept_id is not null").select("relation_id", "child_concept_id", "parent_concept_id").distinct()
    ends = r.select(F.explode(F.array("child_concept_id", "parent_concept_id")).alias("concept_id"))
    return ends.groupBy("concept_id").agg(F.count("*").alias("degree"))


def kg_overview(spark: SparkSession, sf: str) -> DataFrame:
    """The 120 concepts of the highest degree and how many links they have among themselves."""
    top = _degrees(spark, sf).orderBy(F.desc("degree"), "concept_id").limit(120)
    r = table(spark, sf, "concept_relations").select("relation_id", "child_concept_id", "parent_concept_id").distinct()
    inside = r.join(top.select(F.col("concept_id").alias("child_concept_id")), "child_concept_id", "left_semi").join(top.select(F.col("concept_id").alias("parent_concept_id")), "parent_concept_id", "left_semi")
    n = inside.select(F.explode(F.array("child_concept_id", "parent_concept_id")).alias("concept_id")).groupBy("concept_id").agg(F.count("*").alias("inner_degree"))
    return top.join(n, "concept_id", "left").select("concept_id", "degree", F.coalesce("inner_degree", F.lit(0)).alias("inner_degree"))


def kg_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Roots of the IS_A hierarchy with the number of nodes and the depth below each, and cyclic ones apart."""
    tree = hierarchy.hierarchy(isa_links(spark, sf), Scratch(spark, "kg"))
    return tree.groupBy("root_id").agg(F.count("*").alias("n_nodes"), F.max("depth").alias("max_depth"))


def search(spark: SparkSession, sf: str, query: str, kinds: tuple[str, ...] = ("concept", "rule", "state", "unmatched"), limit: int = 40) -> DataFrame:
    """(kind, id): what contains ``query``, whatever its case, in a name, alias, definition or expression; ``limit`` of each kind,
    between 1 and 100. ``unmatched`` are objects that no approved concept bears."""
    q = query.strip().lower()
    hit = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(q))
    concepts, states = _concepts(spark, sf), _states(spark, sf)
    named = ops.names_of(_approved(spark, sf)).select("term").distinct()
    free = states.where(hit(F.col("object"))).select(F.col("object").alias("id"), normalize_text(F.col("object")).alias("term")).where("term <> ''").distinct().join(named, "term", "left_anti")
    found = {
        "concept": lambda: concepts.where(hit(F.col("canonical_name")) | F.exists(F.coalesce("aliases", F.array().cast("array<string>")), hit) | hit(F.col("definition"))).select(F.col("concept_id").alias("id")),
        "rule": lambda: _rules(spark, sf).where(hit(F.col("raw_expression"))).select("id"),
        "state": lambda: states.where(hit(F.col("object")) | hit(F.col("raw_state"))).select(F.col("state_id").alias("id")),
        "unmatched": lambda: free.select("id"),
    }
    out = None
    for kind in kinds:
        part = found[kind]().select(F.lit(kind).alias("kind"), "id").orderBy("id").limit(min(max(limit, 1), 100))
        out = part if out is None else out.unionByName(part)
    return out


def kg_search(spark: SparkSession, sf: str) -> DataFrame:
    """A search in Chinese and one in Latin letters, over all kinds."""
    return search(spark, sf, "焊接").withColumn("query", F.lit("焊接")).unionByName(search(spark, sf, " WELD ").withColumn("query", F.lit("weld")))


def kg_concept_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours of every approved concept with the direction of each link."""
    r = table(spark, sf, "concept_relations").where("child_concept_id is not null and parent_concept_id is not null").select(relation_kind().alias("kind"), "child_concept_id", "parent_concept_id").distinct()
    out = r.select(F.col("child_concept_id").alias("concept_id"), "kind", F.lit("out").alias("direction"), F.col("parent_concept_id").alias("neighbour_id"))
    into = r.select(F.col("parent_concept_id").alias("concept_id"), "kind", F.lit("in").alias("direction"), F.col("child_concept_id").alias("neighbour_id"))
    return out.unionByName(into).join(_approved(spark, sf).select("concept_id"), "concept_id", "left_semi")


def kg_rule_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Each rule with its states by side and the number of its distinct objects."""
    s = _states(spark, sf)
    per = s.groupBy(F.col("rule_id").alias("id")).agg(*[F.count_if(F.col("side") == x).alias(f"n_{x}") for x in ("condition", "antecedent", "consequent")], F.countDistinct("object").alias("n_objects"))
    return _rules(spark, sf).select("id", "relation").join(per, "id", "left").select("id", "relation", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_condition", "n_antecedent", "n_consequent", "n_objects")])


def referential_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Relation ends that concepts lacks, names that several concepts bear, and concepts without any link."""
    ids = _concepts(spark, sf).select("concept_id")
    r = table(spark, sf, "concept_relations")
    ends = r.select(F.explode(F.array("child_concept_id", "parent_concept_id")).alias("concept_id")).where("concept_id is not null").distinct()
    missing = ends.join(ids, "concept_id", "left_anti").agg(F.lit("missing_end").alias("check"), F.count("*").alias("n"))
    shared = ops.names_of(_concepts(spark, sf)).groupBy("term").agg(F.countDistinct("concept_id").alias("k")).where("k > 1").agg(F.lit("shared_name").alias("check"), F.count("*").alias("n"))
    alone = ids.join(ends, "concept_id", "left_anti").agg(F.lit("isolated").alias("check"), F.count("*").alias("n"))
    return missing.unionByName(shared).unionByName(alone)


QUERIES = {
    f.__name__: f
    for f in (object_seeds, exact_binding, status_lattice, contained_terms, lexical_coverage, evidence_topk, ngram_topk, candidate_fusion, relation_dedupe, part_links, cycle_free_links, direct_links, kg_summary, kg_overview, kg_hierarchy, kg_search, kg_concept_detail, kg_rule_detail, referential_audit)
}

_L = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY ingested_at DESC) AS rn_ FROM {t}) WHERE rn_ = 1"
_BASE = f"""WITH RECURSIVE co AS ({_L.format(k="concept_id", t="concepts")}), st AS ({_L.format(k="state_id", t="rule_states")}), ru AS ({_L.format(k="id", t="rules")} AND deleted_at IS NULL),
un AS ({_L.format(k="id", t="units")} AND deleted_at IS NULL),
ap AS (SELECT * FROM co WHERE upper(registration_status) = 'APPROVED'),
nm0 AS (SELECT concept_id, canonical_name AS raw, 'exact_canonical' AS method FROM co UNION ALL SELECT concept_id, unnest(aliases), 'exact_alias' FROM co),
nm AS (SELECT concept_id, lower(regexp_replace(raw, '[\\s\\p{{Z}}]+', '', 'g')) AS term, max(method) AS method FROM nm0 WHERE lower(regexp_replace(raw, '[\\s\\p{{Z}}]+', '', 'g')) <> '' GROUP BY ALL),
rk AS (SELECT *, regexp_replace(upper(type), '[^\\p{{L}}]', '', 'g') AS kind FROM concept_relations)
"""
_NORM = "lower(regexp_replace({}, '[\\s\\p{{Z}}]+', '', 'g'))"
_DAG = """, e AS (SELECT DISTINCT child, parent FROM (SELECT CASE WHEN kind = 'INCLUDES' THEN parent_concept_id ELSE child_concept_id END AS child, CASE WHEN kind = 'INCLUDES' THEN child_concept_id ELSE parent_concept_id END AS parent FROM rk WHERE kind IN ('PARTOF', 'INCLUDES'))
  WHERE child IS NOT NULL AND parent IS NOT NULL AND child <> parent)"""
_GRAMS = """g(id, gram, src) AS (SELECT id, substr(text, i, 2), 'd' FROM d0, unnest(generate_series(1, length(text) - 1)) AS x(i) UNION ALL SELECT id, substr(text, i, 3), 'd' FROM d0, unnest(generate_series(1, length(text) - 2)) AS x(i)
  UNION ALL SELECT id, substr(text, i, 2), 'q' FROM q1, unnest(generate_series(1, length(text) - 1)) AS x(i) UNION ALL SELECT id, substr(text, i, 3), 'q' FROM q1, unnest(generate_series(1, length(text) - 2)) AS x(i) UNION ALL SELECT id, text, 'q' FROM q1 WHERE length(text) = 1),
tf AS (SELECT src, id, gram, count(*) AS tf FROM g GROUP BY ALL), df AS (SELECT gram, count(*) AS df FROM tf WHERE src = 'd' GROUP BY 1), n AS (SELECT count(DISTINCT id) AS n FROM tf WHERE src = 'd'),
w AS (SELECT src, id, tf.gram, (1 + ln(tf)) * CASE WHEN df IS NULL THEN 1.0 ELSE ln((1 + n) / (1 + df)) + 1 END AS w FROM tf LEFT JOIN df ON df.gram = tf.gram, n),
nr AS (SELECT src, id, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
sc AS (SELECT q.id AS query_id, d.id, round(sum(q.w * d.w) / any_value(qn.norm) / any_value(dn.norm), 6) AS score FROM w q JOIN w d ON q.gram = d.gram AND q.src = 'q' AND d.src = 'd' JOIN nr qn ON qn.src = 'q' AND qn.id = q.id JOIN nr dn ON dn.src = 'd' AND dn.id = d.id GROUP BY q.id, d.id)"""
SQL = {
    "object_seeds": _BASE + """, s AS (SELECT *, lower(regexp_replace(object, '[^0-9A-Za-z一-鿿]+', '', 'g')) AS normalized_name FROM st)
SELECT 'seed_' || substr(sha256(normalized_name), 1, 16) AS seed_id, normalized_name, arg_min(object, state_id) AS raw_name, count(DISTINCT rule_id) AS n_rules, count(DISTINCT state_id) AS n_states FROM s WHERE normalized_name <> '' GROUP BY normalized_name""",
    "exact_binding": _BASE + f""", v AS (SELECT DISTINCT object AS value, {_NORM.format("object")} AS term FROM st),
ow AS (SELECT term, count(DISTINCT concept_id) AS n, min(concept_id) AS one, max(method) AS method FROM nm GROUP BY 1),
b AS (SELECT value, CASE WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN n = 1 THEN one END AS concept_id, CASE WHEN n = 1 THEN method END AS method FROM v LEFT JOIN ow USING (term))
SELECT status, method, count(*) AS n_values, count(DISTINCT concept_id) AS n_concepts FROM b GROUP BY ALL""",
    "status_lattice": _BASE + f""", p AS (SELECT term, count(*) FILTER (upper(coalesce(registration_status, 'CANDIDATE')) = 'APPROVED') AS ok, count(*) FILTER (upper(coalesce(registration_status, 'CANDIDATE')) = 'REJECTED') AS no, count(*) AS n FROM nm JOIN co USING (concept_id) GROUP BY 1),
v AS (SELECT state_id, {_NORM.format("object")} AS term FROM st WHERE object IS NOT NULL)
SELECT CASE WHEN n IS NULL THEN 'NO_MATCH' WHEN ok > 1 THEN 'AMBIGUOUS' WHEN ok = 1 THEN 'MATCHED' WHEN no = n THEN 'REJECTED' ELSE 'PROPOSED' END AS status, count(*) AS n_states, count(DISTINCT term) AS n_terms FROM v LEFT JOIN p USING (term) GROUP BY 1""",
    "contained_terms": _BASE + """SELECT concept_id AS term_id, canonical_name AS term, count(DISTINCT un.id) AS n_units, CAST(sum((length(content) - length(replace(content, canonical_name, ''))) // length(canonical_name)) AS BIGINT) AS n_hits
FROM un JOIN (SELECT DISTINCT concept_id, canonical_name FROM ap) ap ON contains(content, canonical_name) WHERE un.type = 'passage' AND content IS NOT NULL AND length(canonical_name) >= 2 GROUP BY ALL""",
    "lexical_coverage": _BASE + """, p AS (SELECT id, content, unnest(generate_series(1, length(content))) AS i FROM un WHERE type = 'passage' AND content IS NOT NULL),
t AS (SELECT DISTINCT canonical_name AS term FROM ap WHERE length(canonical_name) >= 2),
c AS (SELECT id, count(DISTINCT i + d) AS covered FROM p JOIN t ON substr(content, i, length(term)) = term, unnest(generate_series(0, length(term) - 1)) AS x(d) GROUP BY 1)
SELECT un.id AS text_id, coalesce(covered, 0) AS covered, CAST(length(content) AS INTEGER) AS n_chars FROM un LEFT JOIN c USING (id) WHERE type = 'passage' AND content IS NOT NULL""",
    "evidence_topk": _BASE + """, x AS (SELECT DISTINCT ap.concept_id, un.id AS unit_id, 45 + CASE WHEN regexp_matches(content, '本节所说的|Gemeint ist|The word') THEN 25 ELSE 0 END + CASE WHEN regexp_matches(content, '包括|分为|属于') THEN 25 ELSE 0 END + CASE WHEN un.type = 'title' THEN 20 ELSE 0 END AS score
  FROM un JOIN (SELECT DISTINCT concept_id, canonical_name FROM ap) ap ON contains(content, canonical_name) WHERE length(canonical_name) >= 2)
SELECT concept_id, unit_id, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY concept_id ORDER BY score DESC, unit_id) AS INTEGER) AS rank FROM x QUALIFY rank <= 24""",
    "candidate_fusion": _BASE + f""", v AS (SELECT DISTINCT {_NORM.format("object")} AS value FROM st WHERE {_NORM.format("object")} <> ''),
an AS (SELECT nm.* FROM nm JOIN ap USING (concept_id)),
d0 AS (SELECT concept_id AS id, array_to_string(list_sort(list(DISTINCT term)), ' ') AS text FROM an GROUP BY 1), q1 AS (SELECT value AS id, value AS text FROM v), """
    + _GRAMS
    + """, al AS (SELECT query_id AS value, id AS concept_id, 3 AS channel, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sc) WHERE rank <= 6 AND score >= 0.2),
h AS (SELECT value, concept_id, 1 AS channel, CAST(1.0 AS DOUBLE) AS score FROM v JOIN an ON value = term UNION ALL SELECT value, concept_id, 2, CAST(max(length(term)) AS DOUBLE) FROM v JOIN an ON contains(value, term) WHERE length(term) >= 2 GROUP BY ALL UNION ALL SELECT * FROM al),
o AS (SELECT value, concept_id, min(channel) AS channel, arg_min(score, channel) AS score FROM h GROUP BY ALL)
SELECT value, concept_id, CAST(channel AS INTEGER) AS channel, CAST(row_number() OVER (PARTITION BY value ORDER BY channel, score DESC, concept_id) AS INTEGER) AS rank FROM o QUALIFY rank <= 6""",
    "relation_dedupe": _BASE + "SELECT kind, child_concept_id, parent_concept_id, count(DISTINCT relation_id) AS n_records, count(*) AS n_rows FROM rk WHERE child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL GROUP BY ALL",
    "kg_summary": _BASE + """SELECT 'node' AS kind, 'concepts' AS label, count(DISTINCT concept_id) AS n FROM co UNION ALL SELECT 'node', 'rules', count(DISTINCT id) FROM ru UNION ALL SELECT 'node', 'states', count(DISTINCT state_id) FROM st
UNION ALL SELECT 'relation', coalesce(kind, ''), count(DISTINCT relation_id) FROM rk GROUP BY ALL""",
    "kg_overview": _BASE + """, r AS (SELECT DISTINCT relation_id, child_concept_id AS a, parent_concept_id AS b FROM concept_relations WHERE child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL),
d AS (SELECT id AS concept_id, count(*) AS degree FROM (SELECT a AS id FROM r UNION ALL SELECT b FROM r) GROUP BY 1), top AS (SELECT * FROM d ORDER BY degree DESC, concept_id LIMIT 120),
i AS (SELECT id AS concept_id, count(*) AS inner_degree FROM (SELECT unnest([a, b]) AS id FROM r WHERE a IN (SELECT concept_id FROM top) AND b IN (SELECT concept_id FROM top)) GROUP BY 1)
SELECT concept_id, degree, coalesce(inner_degree, 0) AS inner_degree FROM top LEFT JOIN i USING (concept_id)""",
    "kg_search": _BASE + ", fr AS (SELECT DISTINCT object AS id FROM st WHERE " + _NORM.format("object") + " <> '' AND " + _NORM.format("object") + " NOT IN (SELECT term FROM nm JOIN ap USING (concept_id)))\n" + " UNION ALL ".join(
        f"""(SELECT 'concept' AS kind, concept_id AS id, '{q}' AS query FROM co WHERE contains(lower(coalesce(canonical_name, '')), '{q}') OR len(list_filter(coalesce(aliases, []), lambda a: contains(lower(coalesce(a, '')), '{q}'))) > 0 OR contains(lower(coalesce(definition, '')), '{q}') ORDER BY 2 LIMIT 40)
UNION ALL (SELECT 'rule', id, '{q}' FROM ru WHERE contains(lower(raw_expression), '{q}') ORDER BY 2 LIMIT 40) UNION ALL (SELECT 'state', state_id, '{q}' FROM st WHERE contains(lower(object), '{q}') OR contains(lower(raw_state), '{q}') ORDER BY 2 LIMIT 40)
UNION ALL (SELECT 'unmatched', id, '{q}' FROM fr WHERE contains(lower(id), '{q}') ORDER BY 2 LIMIT 40)""" for q in ("焊接", "weld")),
    "kg_concept_detail": _BASE + """, r AS (SELECT DISTINCT kind, child_concept_id AS a, parent_concept_id AS b FROM rk WHERE child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL)
SELECT a AS concept_id, kind, 'out' AS direction, b AS neighbour_id FROM r WHERE a IN (SELECT concept_id FROM ap) UNION ALL SELECT b, kind, 'in', a FROM r WHERE b IN (SELECT concept_id FROM ap)""",
    "kg_rule_detail": _BASE + """SELECT ru.id, any_value(relation) AS relation, count(*) FILTER (side = 'condition') AS n_condition, count(*) FILTER (side = 'antecedent') AS n_antecedent, count(*) FILTER (side = 'consequent') AS n_consequent, count(DISTINCT object) AS n_objects
FROM ru LEFT JOIN st ON st.rule_id = ru.id GROUP BY 1""",
    "referential_audit": _BASE + """, en AS (SELECT DISTINCT id FROM (SELECT child_concept_id AS id FROM rk UNION ALL SELECT parent_concept_id FROM rk) WHERE id IS NOT NULL)
SELECT 'missing_end' AS "check", count(*) AS n FROM en WHERE id NOT IN (SELECT concept_id FROM co) UNION ALL SELECT 'shared_name', count(*) FROM (SELECT term FROM nm GROUP BY 1 HAVING count(DISTINCT concept_id) > 1)
UNION ALL SELECT 'isolated', count(*) FROM co WHERE concept_id NOT IN (SELECT id FROM en)""",
    "ngram_topk": _BASE + f""", d0 AS (SELECT concept_id AS id, {_NORM.format("concat_ws(' ', canonical_name, array_to_string(aliases, ' '))")} AS text FROM ap),
q0 AS (SELECT DISTINCT {_NORM.format("object")} AS text FROM st WHERE object IS NOT NULL), q1 AS (SELECT text AS id, text FROM q0 WHERE text <> ''),
""" + _GRAMS + """
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sc) WHERE rank <= 3 AND score >= 0.2""",
    "part_links": _BASE + _DAG + "SELECT child, parent FROM e",
}
from tracewright.queries.problems import _P5_SQL  # noqa: E402

SQL["kg_hierarchy"] = _P5_SQL + "SELECT root_id, count(*) AS n_nodes, max(depth) AS max_depth FROM tree GROUP BY 1"


def graph_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """What an import of the graph would refuse, counted by entity and check."""
    v = gates.graph_integrity(_rules(spark, sf), _states(spark, sf), table(spark, sf, "concept_relations"), _concepts(spark, sf), relation_kind())
    return v.groupBy("entity", "check").agg(F.count("*").alias("n"))


def kg_state_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Each state with its rule's relation, the other states of the rule counted, and the concept its object is bound to."""
    s = _states(spark, sf)
    bound = ops.bind_exact(s.select(F.col("object").alias("value")), ops.names_of(_approved(spark, sf))).where("status = 'matched'").select(F.col("value").alias("object"), "concept_id")
    n = s.groupBy("rule_id").agg((F.count("*") - 1).alias("n_others"))
    return s.join(n, "rule_id").join(_rules(spark, sf).select(F.col("id").alias("rule_id"), "relation"), "rule_id", "left").join(bound, "object", "left").select("state_id", "rule_id", "side", "relation", "n_others", "concept_id")


def registered_library(spark: SparkSession, sf: str) -> DataFrame:
    """Relations whose ends are both approved concepts, by kind."""
    ids = _approved(spark, sf).select("concept_id").distinct()
    r = table(spark, sf, "concept_relations").select(relation_kind().alias("kind"), "child_concept_id", "parent_concept_id").distinct()
    inside = r.join(ids.withColumnRenamed("concept_id", "child_concept_id"), "child_concept_id", "left_semi").join(ids.withColumnRenamed("concept_id", "parent_concept_id"), "parent_concept_id", "left_semi")
    return inside.groupBy("kind").agg(F.count("*").alias("n_relations"))


def rule_context(spark: SparkSession, sf: str) -> DataFrame:
    """Up to three other states of the rule for each antecedent, in order of side and place."""
    s = _states(spark, sf)
    me = s.where("side = 'antecedent'").select("state_id", "rule_id")
    other = s.select("rule_id", F.col("state_id").alias("o"), "side", "pos", F.concat_ws("|", F.coalesce("object", F.lit("")), F.coalesce("raw_state", F.lit(""))).alias("text"))
    # a rule has few states: its counterparts are a bounded list
    pairs = me.join(other, "rule_id").where("state_id <> o")
    ctx = pairs.groupBy("state_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("side", "pos", "o", "text"))), 1, 3).alias("c"))
    return ctx.select("state_id", F.array_join(F.transform("c", lambda x: x["text"]), " + ").alias("context"))


QUERIES |= {f.__name__: f for f in (graph_integrity, kg_state_detail, registered_library, rule_context)}
SQL |= {
    "graph_integrity": _BASE
    + """, v AS (
  SELECT DISTINCT 'rule' AS entity, id, c AS "check" FROM ru, unnest(list_filter([CASE WHEN context_package_id IS NULL THEN 'rule_has_package' END, CASE WHEN NOT coalesce(regexp_matches(raw_expression, '\\S'), false) THEN 'rule_has_expression' END], lambda x: x IS NOT NULL)) AS t(c)
  UNION SELECT 'state', state_id, c FROM st, unnest(list_filter([CASE WHEN NOT coalesce(regexp_matches(object, '\\S'), false) THEN 'state_has_object' END, CASE WHEN NOT coalesce(regexp_matches(raw_state, '\\S'), false) THEN 'state_has_value' END,
    CASE WHEN NOT coalesce(side IN ('condition', 'antecedent', 'consequent'), false) THEN 'state_side' END], lambda x: x IS NOT NULL)) AS t(c)
  UNION SELECT 'relation', relation_id, c FROM rk, unnest(list_filter([CASE WHEN child_concept_id IS NULL OR parent_concept_id IS NULL THEN 'relation_has_ends' END,
    CASE WHEN NOT coalesce(kind IN ('ISA', 'PARTOF', 'INCLUDES', 'SAMEAS', 'NOTSAMEAS', 'DIFFERENTFROM', 'RELATEDTO'), false) THEN 'relation_kind' END, CASE WHEN child_concept_id = parent_concept_id THEN 'relation_no_loop' END], lambda x: x IS NOT NULL)) AS t(c)
  UNION SELECT 'relation', relation_id, 'end_exists' FROM (SELECT relation_id, unnest([child_concept_id, parent_concept_id]) AS e FROM rk) WHERE e IS NOT NULL AND e NOT IN (SELECT concept_id FROM co))
SELECT entity, "check", count(*) AS n FROM v GROUP BY ALL""",
    "kg_state_detail": _BASE + f""", an AS (SELECT term, min(concept_id) AS concept_id FROM nm JOIN (SELECT concept_id FROM ap) USING (concept_id) GROUP BY 1 HAVING count(DISTINCT concept_id) = 1), k AS (SELECT rule_id, count(*) - 1 AS n_others FROM st GROUP BY 1)
SELECT state_id, st.rule_id, side, relation, n_others, concept_id FROM st JOIN k USING (rule_id) LEFT JOIN ru ON ru.id = st.rule_id LEFT JOIN an ON {_NORM.format("object")} = an.term""",
    "registered_library": _BASE + "SELECT kind, count(*) AS n_relations FROM (SELECT DISTINCT kind, child_concept_id AS a, parent_concept_id AS b FROM rk) WHERE a IN (SELECT concept_id FROM ap) AND b IN (SELECT concept_id FROM ap) GROUP BY 1",
    "rule_context": _BASE + """, p AS (SELECT a.state_id, b.side, b.pos, b.state_id AS o, coalesce(b.object, '') || '|' || coalesce(b.raw_state, '') AS text FROM st a JOIN st b ON a.rule_id = b.rule_id AND a.state_id <> b.state_id WHERE a.side = 'antecedent'),
r AS (SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY side, pos, o, text) AS k FROM p)
SELECT state_id, string_agg(text, ' + ' ORDER BY k) AS context FROM r WHERE k <= 3 GROUP BY 1""",
}
