"""Queries over rule states, runs and metrics, and over the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import dsl, register
from tracewright.functions.text import normalize_text
from tracewright.operators import concepts as ops
from tracewright.operators import events as ev
from tracewright.operators import sequence
from tracewright.queries.problems import relation_kind
from tracewright.queries.knowledge import _BASE, _NORM, _approved, _concepts, _rules, _states
from tracewright.streaming import windows
from tracewright.session import Scratch
from tracewright.tables import latest, table


def source_aggregation(spark: SparkSession, sf: str) -> DataFrame:
    """Objects as sources: states, rules, sides and their most common state."""
    s = _states(spark, sf).withColumn("name", normalize_text(F.col("object"))).where("name <> ''")
    per = s.groupBy("name", "normalized_state").agg(F.count("*").alias("n"))
    common = per.where("normalized_state is not null and normalized_state <> ''").groupBy("name").agg(F.max_by("normalized_state", F.struct("n", "normalized_state")).alias("common_state"))
    base = s.groupBy("name").agg(F.count("*").alias("frequency"), F.countDistinct("rule_id").alias("n_rules"), F.countDistinct("side").alias("n_sides"))
    return base.join(common, "name", "left").select("name", "frequency", "n_rules", "n_sides", "common_state")


def rank_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Objects ranked by occurrence, with confidence and band."""
    counted = source_aggregation(spark, sf).select("name", "frequency")
    return ops.rank_bands(counted, F.col("frequency"), F.col("name")).select("name", "frequency", "rank", "population", "confidence", "band")


def unprocessed_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects that no approved concept bears, by occurrence; the long tail of one-off ones is left out after ranking."""
    names = ops.names_of(_approved(spark, sf)).select(F.col("term").alias("name")).distinct()
    counted = source_aggregation(spark, sf).select("name", "frequency").join(names, "name", "left_anti")
    ranked = ops.rank_bands(counted, F.col("frequency"), F.col("name"))
    return ranked.where("not (band = 'LOW' and frequency <= 5)").select("name", "frequency", "rank", "band")


def bin_pack(spark: SparkSession, sf: str) -> DataFrame:
    """Bins of cases by tier: at most 12 cases and 400 characters, in order of frequency."""
    bands = rank_bands(spark, sf).select(F.col("band").alias("tier"), "frequency", F.col("name").alias("id"), F.length("name").alias("size"))
    packed = ops.pack_bins(bands, 12, 400)
    return packed.groupBy("tier", "bin").agg(F.count("*").alias("n_cases"), F.min("id").alias("first_id"))


def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Rules numbered in order of id and cut into batches of 12."""
    r = sequence.ranked(_rules(spark, sf).select("id").withColumn("one", F.lit(1)), ["one"], F.substring("id", 1, 9), [F.col("id")])
    return r.select("id", F.floor(F.col("pos") / 12).alias("batch"))


def proposals(spark: SparkSession, sf: str) -> DataFrame:
    """Unmatched names with a support of five states or more, with priority by support."""
    names = ops.names_of(_concepts(spark, sf)).select(F.col("term").alias("name")).distinct()
    s = _states(spark, sf).withColumn("name", normalize_text(F.col("object"))).where("name <> ''").join(names, "name", "left_anti")
    out = s.groupBy("name").agg(F.countDistinct("state_id").alias("support"), F.countDistinct("raw_state").alias("n_expressions")).where("support >= 5")
    return out.withColumn("priority", F.when(F.col("support") >= 20, "P0").when(F.col("support") >= 10, "P1").otherwise("P2"))


def state_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """For each matched concept its states by expression, the share of the most frequent and how many are quantities."""
    names = ops.names_of(_approved(spark, sf))
    s = _states(spark, sf).withColumn("term", normalize_text(F.col("object"))).join(names.groupBy("term").agg(F.min("concept_id").alias("concept_id"), F.countDistinct("concept_id").alias("k")).where("k = 1"), "term")
    per = s.groupBy("concept_id", F.coalesce(F.nullif(F.col("normalized_state"), F.lit("")), F.col("raw_state"), F.lit("")).alias("expression")).agg(F.count("*").alias("n"))
    return per.groupBy("concept_id").agg(F.sum("n").alias("n_states"), F.count("*").alias("n_expressions"), F.max("n").alias("most"), F.sum(F.when(F.col("expression").rlike("[0-9]"), F.col("n")).otherwise(0)).alias("n_numeric"))


def artifact_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Share of states whose object is an approved name, by side and in total."""
    names = ops.names_of(_approved(spark, sf)).select("term").distinct().withColumn("hit", F.lit(1))
    s = _states(spark, sf).withColumn("term", normalize_text(F.col("object"))).join(names, "term", "left")
    g = s.groupingSets([["side"], []], "side").agg(F.count("*").alias("n_states"), F.count("hit").alias("n_matched"))
    return g.select(F.coalesce("side", F.lit("all")).alias("side"), "n_states", "n_matched", F.round(F.col("n_matched") / F.col("n_states"), 4).alias("rate"))


def nearest_rank_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest-rank percentiles of document lengths by source, from counts of lengths, so no list of a hot source is kept."""
    counts = table(spark, sf, "documents").where("n_chars is not null").groupBy("source", "n_chars").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy("n_chars")
    run = counts.withColumn("hi", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    total = counts.groupBy("source").agg(F.sum("n").alias("total"))
    at = run.join(total, "source")
    pick = lambda p: F.min(F.when(F.col("hi") > F.floor((F.col("total") - 1) * p), F.col("n_chars")))
    return at.groupBy("source").agg(F.max("total").alias("n"), pick(0.5).alias("p50"), pick(0.95).alias("p95"), F.max("n_chars").alias("longest"))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Given roles against roles predicted from the text of units."""
    units = latest(table(spark, sf, "units"), ["id"]).where("deleted_at is null and type = 'passage' and content is not null")
    expected = F.when(F.size("role") > 0, F.col("role")[0]).otherwise("none")
    actual = F.when(F.col("content").rlike("应|允许|must|wird zuerst"), "rule").when(F.col("content").rlike("本节所说的|Gemeint ist|The word"), "concept").otherwise("none")
    return units.groupBy(expected.alias("expected"), actual.alias("actual")).agg(F.count("*").alias("n"))


def prf_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Precision, recall and F1 per role from the confusion counts."""
    m = confusion_matrix(spark, sf)
    tp = m.where("expected = actual").select(F.col("expected").alias("role"), F.col("n").alias("tp"))
    e, a = m.groupBy(F.col("expected").alias("role")).agg(F.sum("n").alias("ne")), m.groupBy(F.col("actual").alias("role")).agg(F.sum("n").alias("na"))
    df = e.join(a, "role", "full").join(tp, "role", "left").fillna(0, ["ne", "na", "tp"])
    p, r = F.coalesce(F.try_divide("tp", "na"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "ne"), F.lit(0.0))
    return df.select("role", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 4).alias("f1"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Package states of each run: counts by status, attempts and mean seconds to completion."""
    p = latest(table(spark, sf, "package_states"), ["run_id", "context_package_id"])
    status = F.lower(F.trim("status"))
    secs = F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return p.groupBy("run_id", status.alias("status")).agg(F.count("*").alias("n_packages"), F.sum("attempt_count").alias("n_attempts"), F.coalesce(F.sum(secs), F.lit(0)).alias("micros"))


def resume_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Packages that a resumed run takes up: those of no run, and those whose last state is no success."""
    p = latest(table(spark, sf, "package_states"), ["run_id", "context_package_id"])
    done = ev.last_wins(p, "context_package_id", ["started_at", "run_id"]).where(F.lower(F.trim("status")).isin("success", "completed", "no_rule")).select(F.col("context_package_id").alias("id"))
    return latest(table(spark, sf, "context_packages"), ["id"]).join(done, "id", "left_anti").select("id")


def state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A merge of orders: the even keys are updated with a doubled price, new keys inserted, the rest kept."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    old = o.where("o_orderkey % 3 <> 0").toDF("key", "price", "status")
    new = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("key"), (F.col("o_totalprice") * 2).alias("price"), F.lit("U").alias("status"))
    merged = ev.upsert(old, new, ["key"], {"price": F.coalesce("n_price", "o_price"), "status": F.coalesce("n_status", "o_status"), "attempts": F.when(F.col("o_key").isNotNull() & F.col("n_key").isNotNull(), 2).otherwise(1)})
    return merged.groupBy("status", "attempts").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


def review_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user."""
    last = ev.last_wins(table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type")


def catalog_union(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers, and customers whose key no supplier has."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return ev.first_wins_union(s, c, "key")


def memory_fold(spark: SparkSession, sf: str) -> DataFrame:
    """A library folded from an event log made of concepts and their SAME_AS links, which merge the greater id into the smaller one."""
    c = _concepts(spark, sf)
    decided = c.select(F.unix_micros(F.col("created_at").cast("timestamp")).alias("seq"), F.when(F.upper("registration_status") == "REJECTED", "reject").otherwise("approve").alias("kind"), "concept_id", F.lit(None).cast("string").alias("target_id"), F.col("canonical_name").alias("name"))
    alias = c.select(F.unix_micros(F.col("ingested_at").cast("timestamp")).alias("seq"), F.lit("alias").alias("kind"), "concept_id", F.lit(None).cast("string").alias("target_id"), F.explode("aliases").alias("name")).where("name is not null")
    same = table(spark, sf, "concept_relations").where(relation_kind() == "SAMEAS").where("child_concept_id is not null and parent_concept_id is not null and child_concept_id <> parent_concept_id")
    low, high = F.least("child_concept_id", "parent_concept_id"), F.greatest("child_concept_id", "parent_concept_id")
    pairs = same.select(high.alias("concept_id"), low.alias("target_id")).distinct()
    # of several merges of a concept the last one counts: the order is that of the targets
    merge = pairs.select(F.conv(F.substring(F.md5("target_id"), 1, 12), 16, 10).cast("long").alias("seq"), F.lit("merge").alias("kind"), "concept_id", "target_id", F.lit(None).cast("string").alias("name"))
    folded = ev.fold_memory(decided.unionByName(alias).unionByName(merge), Scratch(spark, "memory"))
    return folded.select("concept_id", "status", "name", F.array_join("aliases", "|").alias("aliases"), "merged_into")


def grid_argmin(spark: SparkSession, sf: str) -> DataFrame:
    """Of a grid of size and price limits, per brand the cheapest setting that keeps 60 % of the parts."""
    grid = spark.createDataFrame([(s, p) for s in (10, 20, 30, 40, 50) for p in (1000, 1200, 1500, 2000)], "max_size int, max_price int")
    part = table(spark, sf, "part")
    total = part.groupBy("p_brand").agg(F.count("*").alias("n"))
    # the grid is a fixed list of 20 settings: a broadcast pairing
    kept = part.join(F.broadcast(grid), (F.col("p_size") <= F.col("max_size")) & (F.col("p_retailprice") <= F.col("max_price"))).groupBy("p_brand", "max_size", "max_price").agg(F.count("*").alias("kept"))
    ok = kept.join(total, "p_brand").where("kept >= 0.6 * n")
    return ok.groupBy("p_brand").agg(F.min(F.struct((F.col("max_size") * F.col("max_price")).alias("cost"), "max_size", "max_price", "kept")).alias("b")).select("p_brand", "b.cost", "b.max_size", "b.max_price", "b.kept")


def manifest_quota(spark: SparkSession, sf: str) -> DataFrame:
    """A stress set of packages: per kind the eight most complex ones by members."""
    from pyspark.sql import Window

    p = latest(table(spark, sf, "context_packages"), ["id"])
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    score = 1000 * size("core_unit_ids") + 500 * F.when(F.col("constraint_ids").isNull(), 0).otherwise(size("constraint_ids")) + 50 * F.when(F.col("support_unit_ids").isNull(), 0).otherwise(size("support_unit_ids"))
    kind = F.get_json_object("attributes", "$.kind")
    s = p.where("core_unit_ids is not null").select("id", F.coalesce(kind, F.lit("none")).alias("kind"), score.alias("score")).withColumn("_k", F.pmod(F.xxhash64("id"), F.lit(32)))
    w = Window.partitionBy("kind").orderBy(F.desc("score"), "id")
    cut = s.withColumn("_r", F.row_number().over(Window.partitionBy("kind", "_k").orderBy(F.desc("score"), "id"))).where("_r <= 8")
    return cut.withColumn("rank", F.row_number().over(w)).where("rank <= 8").select("id", "kind", "score", "rank")


def dsl_parse(spark: SparkSession, sf: str) -> DataFrame:
    """The raw expressions of rules parsed: relation, states on each side and transitions, or a failure."""
    r = _rules(spark, sf).select("id", "raw_expression")
    parsed = dsl.parse_rules(r, "raw_expression", ["id"])
    first = lambda side, c: F.try_element_at(side, F.lit(1))[c]
    return parsed.select(
        "id", "relation", F.size("conditions").alias("n_conditions"), F.size("antecedents").alias("n_antecedents"), F.size("consequents").alias("n_consequents"), F.size("transitions").alias("n_transitions"),
        first("antecedents", "object").alias("from_object"), first("antecedents", "raw_state").alias("from_state"), first("consequents", "object").alias("to_object"), first("consequents", "raw_state").alias("to_state"), F.col("error").isNotNull().alias("failed"),
    )


def rule_table_function(spark: SparkSession, sf: str) -> DataFrame:
    """Rules by relation and number of states, parsed by the SQL table function."""
    register.register(spark)
    _rules(spark, sf).select("id", "raw_expression").createOrReplaceTempView("tracewright_rules")
    return spark.sql("SELECT p.relation, size(p.antecedents) AS n_antecedents, count(*) AS n_rules FROM tracewright_rules r, LATERAL parse_rules(r.raw_expression, r.id) p GROUP BY ALL")


#: One patch for each edit of the language, for a draft of two groups with two rules in the first; %s is a rule line.
_PATCHES = (
    "NO_CHANGES", "SET_C 1\nC: 环境|室温", "DELETE_C 2", "REPLACE_R 1/2\nR: 电流|大 —[导致]→ 熔深|大", "DELETE_R 1/1", "ADD_R 2\nR: 电流|小 → 熔深|小", "REPLACE_GROUP 2\n规则组2\nR: 电流|小 → 熔深|小\nEND_GROUP",
    "DELETE_GROUP 1\nADD_GROUP\n规则组3\nR: 电流|小 → 熔深|小\nEND_GROUP", "REPLACE_ALL\n规则组9\nC: 环境|室温\nR: 电流|小 → 熔深|小\nEND_ALL", "DELETE_R 1/7",
)


def patch_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Each rule's expression in a draft of two groups, edited by one of ten patches in turn: the new draft, or a failure."""
    r = _rules(spark, sf).where("raw_expression is not null").select("id", F.coalesce("rule_index", F.lit(0)).alias("k"), F.trim(F.regexp_replace("raw_expression", r"\s+", " ")).alias("x"))
    draft = F.concat(F.lit("规则组1\n"), "x", F.lit("\nR: 电压|低 → 电弧|短\n规则组2\nC: 板厚|3 mm\n"), "x")
    patch = F.element_at(F.array(*[F.lit(p) for p in _PATCHES]), (F.pmod("k", F.lit(len(_PATCHES))) + 1).cast("int"))
    return r.select("id", dsl.patch_column(draft, patch).alias("p")).select("id", "p.text", F.col("p.error").isNotNull().alias("failed"))


def tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts and sums by event type, by a stream over the events run to its end."""
    return windows.tumbling(spark, f"{sf}/events.parquet", "1 hour")


def sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Counts in windows of an hour every quarter of an hour."""
    return windows.sliding(spark, f"{sf}/events.parquet", "1 hour", "15 minutes")


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of users with gaps of 30 minutes."""
    return windows.sessions(spark, f"{sf}/events.parquet", "30 minutes")


def dedupe_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The number of distinct users and types, duplicates dropped by the stream."""
    return windows.deduplicated(spark, f"{sf}/events.parquet")


def asof_events(spark: SparkSession, sf: str) -> DataFrame:
    """The last signup before each purchase of the same user."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    ranked = sequence.ranked(e, ["user_id"], F.date_trunc("minute", F.col("ts").cast("timestamp")), [F.col("ts"), F.col("event_id")])
    out = sequence.carried(ranked, ["user_id"], {"signup_id": F.when(F.col("event_type") == "signup", F.col("event_id"))})
    return out.where("event_type = 'purchase'").select("event_id", F.coalesce("signup_id", F.lit(-1)).alias("signup_id"))


QUERIES = {
    f.__name__: f
    for f in (source_aggregation, rank_bands, unprocessed_objects, bin_pack, batch_ids, proposals, state_coverage, artifact_rates, nearest_rank_percentiles, confusion_matrix, prf_metrics, run_summary, resume_queue, state_upsert, review_last_wins, catalog_union, memory_fold, grid_argmin, manifest_quota, dsl_parse, rule_table_function, patch_apply, tumbling, sliding, sessions, dedupe_stream, asof_events)
}

_SRC = _BASE + f""", s AS (SELECT *, {_NORM.format("object")} AS name FROM st), pr AS (SELECT name, normalized_state, count(*) AS n FROM s WHERE normalized_state <> '' GROUP BY ALL),
cm AS (SELECT name, arg_max(normalized_state, struct_pack(n := n, t := normalized_state)) AS common_state FROM pr GROUP BY 1),
src AS (SELECT name, count(*) AS frequency, count(DISTINCT rule_id) AS n_rules, count(DISTINCT side) AS n_sides FROM s WHERE name <> '' GROUP BY 1)"""
_RANK = "row_number() OVER (ORDER BY frequency DESC, name)"
_BAND = "CASE WHEN rank <= ceil(population / 31) THEN 'HIGH' WHEN rank <= ceil(6 * population / 31) THEN 'MEDIUM' ELSE 'LOW' END"
_CONF = _BASE + """, m AS (SELECT CASE WHEN len(role) > 0 THEN role[1] ELSE 'none' END AS expected, CASE WHEN regexp_matches(content, '应|允许|must|wird zuerst') THEN 'rule' WHEN regexp_matches(content, '本节所说的|Gemeint ist|The word') THEN 'concept' ELSE 'none' END AS actual, count(*) AS n
  FROM un WHERE type = 'passage' AND content IS NOT NULL GROUP BY ALL)"""
_PS = "ps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, context_package_id ORDER BY ingested_at DESC) AS rn_ FROM package_states) WHERE rn_ = 1)"
_AN = ", an AS (SELECT term, min(concept_id) AS concept_id, count(DISTINCT concept_id) AS k FROM nm JOIN (SELECT concept_id FROM ap) USING (concept_id) GROUP BY 1)"
SQL = {
    "source_aggregation": _SRC + "SELECT src.*, common_state FROM src LEFT JOIN cm USING (name)",
    "rank_bands": _SRC + f", r AS (SELECT name, frequency, {_RANK} AS rank, count(*) OVER () AS population FROM src) SELECT *, round(1 - (rank - 1) / population, 4) AS confidence, {_BAND} AS band FROM r",
    "unprocessed_objects": _SRC + _AN + f", r AS (SELECT name, frequency, {_RANK} AS rank, count(*) OVER () AS population FROM src WHERE name NOT IN (SELECT term FROM an)), b AS (SELECT name, frequency, rank, {_BAND} AS band FROM r) SELECT * FROM b WHERE NOT (band = 'LOW' AND frequency <= 5)",
    "batch_ids": _BASE + "SELECT id, (row_number() OVER (ORDER BY id) - 1) // 12 AS batch FROM ru",
    "proposals": _SRC + ", p AS (SELECT name, count(DISTINCT state_id) AS support, count(DISTINCT raw_state) AS n_expressions FROM s WHERE name <> '' AND name NOT IN (SELECT term FROM nm) GROUP BY 1 HAVING count(DISTINCT state_id) >= 5) SELECT *, CASE WHEN support >= 20 THEN 'P0' WHEN support >= 10 THEN 'P1' ELSE 'P2' END AS priority FROM p",
    "state_coverage": _SRC + _AN + """, p AS (SELECT concept_id, coalesce(nullif(normalized_state, ''), raw_state, '') AS expression, count(*) AS n FROM s JOIN an ON s.name = an.term WHERE k = 1 GROUP BY ALL)
SELECT concept_id, CAST(sum(n) AS BIGINT) AS n_states, count(*) AS n_expressions, max(n) AS most, CAST(sum(CASE WHEN regexp_matches(expression, '[0-9]') THEN n ELSE 0 END) AS BIGINT) AS n_numeric FROM p GROUP BY 1""",
    "artifact_rates": _SRC + _AN + ", g AS (SELECT side, count(*) AS n_states, count(an.term) AS n_matched FROM s LEFT JOIN an ON s.name = an.term GROUP BY GROUPING SETS ((side), ())) SELECT coalesce(side, 'all') AS side, n_states, n_matched, round(n_matched / n_states, 4) AS rate FROM g",
    "nearest_rank_percentiles": "WITH l AS (SELECT source, list_sort(list(n_chars)) AS v FROM documents WHERE n_chars IS NOT NULL GROUP BY 1) SELECT source, CAST(len(v) AS BIGINT) AS n, v[CAST(floor((len(v) - 1) * 0.5) AS INTEGER) + 1] AS p50, v[CAST(floor((len(v) - 1) * 0.95) AS INTEGER) + 1] AS p95, v[len(v)] AS longest FROM l",
    "confusion_matrix": _CONF + "SELECT * FROM m",
    "prf_metrics": _CONF + """, r AS (SELECT role, coalesce(sum(ne), 0) AS ne, coalesce(sum(na), 0) AS na, coalesce(sum(tp), 0) AS tp FROM (SELECT expected AS role, n AS ne, 0 AS na, CASE WHEN expected = actual THEN n ELSE 0 END AS tp FROM m UNION ALL SELECT actual, 0, n, 0 FROM m) GROUP BY 1),
x AS (SELECT role, CASE WHEN na = 0 THEN 0.0 ELSE tp / na END AS p, CASE WHEN ne = 0 THEN 0.0 ELSE tp / ne END AS r FROM r)
SELECT role, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) AS f1 FROM x""",
    "run_summary": f"WITH {_PS} SELECT run_id, lower(trim(status)) AS status, count(*) AS n_packages, CAST(sum(attempt_count) AS BIGINT) AS n_attempts, CAST(coalesce(sum(epoch_us(completed_at) - epoch_us(started_at)), 0) AS BIGINT) AS micros FROM ps GROUP BY ALL",
    "resume_queue": f"WITH {_PS}, l AS (SELECT context_package_id, arg_max(status, struct_pack(a := started_at, b := run_id)) AS status FROM ps WHERE context_package_id IS NOT NULL GROUP BY 1) SELECT DISTINCT id FROM context_packages WHERE id NOT IN (SELECT context_package_id FROM l WHERE lower(trim(status)) IN ('success', 'completed', 'no_rule'))",
    "state_upsert": """WITH old AS (SELECT o_orderkey AS key, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey AS key, o_totalprice * 2 AS price, 'U' AS status FROM orders WHERE o_orderkey % 2 = 0),
m AS (SELECT coalesce(n.price, o.price) AS price, coalesce(n.status, o.status) AS status, CASE WHEN o.key IS NOT NULL AND n.key IS NOT NULL THEN 2 ELSE 1 END AS attempts FROM old o FULL JOIN new n ON o.key = n.key)
SELECT status, CAST(attempts AS INTEGER) AS attempts, count(*) AS n, round(sum(price), 2) AS total FROM m GROUP BY ALL""",
    "review_last_wins": "SELECT user_id, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS event_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS event_type FROM events GROUP BY 1",
    "catalog_union": "SELECT s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
    "memory_fold": _BASE + """, p AS (SELECT DISTINCT greatest(child_concept_id, parent_concept_id) AS concept_id, least(child_concept_id, parent_concept_id) AS target_id FROM rk WHERE kind = 'SAMEAS' AND child_concept_id <> parent_concept_id),
hop AS (SELECT concept_id, arg_max(target_id, substr(md5(target_id), 1, 12)) AS into_ FROM p GROUP BY 1),
far AS (SELECT concept_id, into_, 1 AS d FROM hop UNION ALL SELECT far.concept_id, hop.into_, d + 1 FROM far JOIN hop ON hop.concept_id = far.into_),
mg AS (SELECT concept_id, arg_max(into_, d) AS merged_into FROM far GROUP BY 1),
a AS (SELECT concept_id, canonical_name AS name FROM co WHERE canonical_name IS NOT NULL AND upper(coalesce(registration_status, '')) <> 'REJECTED' UNION SELECT concept_id, x FROM (SELECT concept_id, unnest(aliases) AS x FROM co) WHERE x IS NOT NULL),
g AS (SELECT concept_id, list_sort(list(DISTINCT name)) AS aliases FROM (SELECT coalesce(merged_into, concept_id) AS concept_id, name FROM a LEFT JOIN mg USING (concept_id)) GROUP BY 1)
SELECT concept_id, CASE WHEN merged_into IS NOT NULL THEN 'MERGED' WHEN upper(registration_status) = 'REJECTED' THEN 'REJECTED' ELSE 'REGISTERED' END AS status, CASE WHEN upper(registration_status) = 'REJECTED' THEN NULL ELSE canonical_name END AS name,
  CASE WHEN merged_into IS NULL THEN coalesce(array_to_string(g.aliases, '|'), '') END AS aliases, merged_into FROM co LEFT JOIN g USING (concept_id) LEFT JOIN mg USING (concept_id)""",
    "grid_argmin": """WITH grid AS (SELECT s AS max_size, p AS max_price FROM unnest([10, 20, 30, 40, 50]) AS a(s), unnest([1000, 1200, 1500, 2000]) AS b(p)), t AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
k AS (SELECT p_brand, max_size, max_price, count(*) AS kept FROM part JOIN grid ON p_size <= max_size AND p_retailprice <= max_price GROUP BY ALL)
SELECT p_brand, CAST(max_size * max_price AS INTEGER) AS cost, CAST(max_size AS INTEGER) AS max_size, CAST(max_price AS INTEGER) AS max_price, kept FROM k JOIN t USING (p_brand) WHERE kept >= 0.6 * n QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY max_size * max_price, max_size, max_price) = 1""",
    "manifest_quota": """WITH cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) AS rn_ FROM context_packages) WHERE rn_ = 1 AND core_unit_ids IS NOT NULL),
s AS (SELECT id, coalesce(attributes::JSON ->> '$.kind', 'none') AS kind, CAST(1000 * len(core_unit_ids) + 500 * coalesce(len(constraint_ids), 0) + 50 * coalesce(len(support_unit_ids), 0) AS INTEGER) AS score FROM cp)
SELECT *, CAST(row_number() OVER (PARTITION BY kind ORDER BY score DESC, id) AS INTEGER) AS rank FROM s QUALIFY rank <= 8""",
    "tumbling": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "sliding": "SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * k AS window_start, count(*) AS n FROM events, unnest([0, 1, 2, 3]) AS x(k) GROUP BY ALL",
    "sessions": """WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k""",
    "dedupe_stream": "SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1",
    "asof_events": "SELECT event_id, coalesce(signup_id, -1) AS signup_id FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS signup_id FROM events) WHERE event_type = 'purchase'",
}

_CUT = "trim(regexp_replace(replace(replace({}, '*', ''), '__', ''), '^\\s*R\\s*[:：][\\s\\p{{Z}}]*', ''))"
_STRIP = "trim({}, ' ' || chr(9) || '。；;')"
_PARSED = _BASE + f""", x AS (SELECT id, {_CUT.format("raw_expression")} AS e FROM ru),
y AS (SELECT id, regexp_extract(e, '=([^=>|]*)=>', 1) AS r, regexp_extract(e, '^(.*?)[\\s\\p{{Z}}]*=[^=>|]*=>', 1) AS l, regexp_extract(e, '=[^=>|]*=>[\\s\\p{{Z}}]*(.*)$', 1) AS g FROM x),
z0 AS (SELECT id, nullif(trim(r), '') AS relation, {_STRIP.format("split_part(l, '|', 1)")} AS from_object, {_STRIP.format("substr(l, strpos(l, '|') + 1)")} AS from_state, {_STRIP.format("split_part(g, '|', 1)")} AS to_object, {_STRIP.format("substr(g, strpos(g, '|') + 1)")} AS to_state FROM y),
z AS (SELECT *, from_object <> '' AND from_state <> '' AND to_object <> '' AND to_state <> '' AS ok FROM z0)
"""
_DRAFT = """SELECT id, coalesce(rule_index, 0) % 10 AS k, trim(regexp_replace(raw_expression, '\\s+', ' ', 'g')) AS x, '规则组1' || chr(10) AS g1, 'R: 电压|低 → 电弧|短' || chr(10) AS r2, '规则组2' || chr(10) AS g2, 'C: 板厚|3 mm' || chr(10) AS c2, 'C: 无' || chr(10) AS c0, 'R: 电流|小 → 熔深|小' AS n FROM ru WHERE raw_expression IS NOT NULL"""
SQL |= {
    "dsl_parse": _PARSED
    + """SELECT id, CASE WHEN ok THEN relation END AS relation, CASE WHEN ok THEN 0 END AS n_conditions, CASE WHEN ok THEN 1 END AS n_antecedents, CASE WHEN ok THEN 1 END AS n_consequents, CASE WHEN ok THEN CASE WHEN from_object = to_object AND from_state <> to_state THEN 1 ELSE 0 END END AS n_transitions,
  CASE WHEN ok THEN from_object END AS from_object, CASE WHEN ok THEN from_state END AS from_state, CASE WHEN ok THEN to_object END AS to_object, CASE WHEN ok THEN to_state END AS to_state, NOT ok AS failed FROM z""",
    "rule_table_function": _PARSED + "SELECT CASE WHEN ok THEN relation END AS relation, CASE WHEN ok THEN 1 END AS n_antecedents, count(*) AS n_rules FROM z GROUP BY ALL",
    "patch_apply": _BASE + f""", d AS ({_DRAFT})
SELECT id, CASE k WHEN 0 THEN g1 || c0 || x || chr(10) || r2 || g2 || c2 || x
  WHEN 1 THEN g1 || 'C: 环境|室温' || chr(10) || x || chr(10) || r2 || g2 || c2 || x
  WHEN 2 THEN g1 || c0 || x || chr(10) || r2 || g2 || c0 || x
  WHEN 3 THEN g1 || c0 || x || chr(10) || 'R: 电流|大 —[导致]→ 熔深|大' || chr(10) || g2 || c2 || x
  WHEN 4 THEN g1 || c0 || r2 || g2 || c2 || x
  WHEN 5 THEN g1 || c0 || x || chr(10) || r2 || g2 || c2 || x || chr(10) || n
  WHEN 6 THEN g1 || c0 || x || chr(10) || r2 || g2 || c0 || n
  WHEN 7 THEN g2 || c2 || x || chr(10) || '规则组3' || chr(10) || c0 || n
  WHEN 8 THEN '规则组9' || chr(10) || 'C: 环境|室温' || chr(10) || n END AS text, k = 9 AS failed FROM d""",
}
