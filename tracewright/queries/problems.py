"""Queries of the general data problems: missing references, hierarchies and units of measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.quantity import quantity_column, written_column
from tracewright.operators import changepoints, hierarchy, references
from tracewright.session import Scratch
from tracewright.tables import first_delivery, table

# --- missing references -------------------------------------------------------------------------------------------------


def all_references(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every distinct reference (ref_table, record_id, ref_field, target_table, target_id, seen) and every target."""
    constraints, packages, states = (table(spark, sf, t) for t in ("unit_constraints", "context_packages", "package_states"))
    sources = [
        ("unit_constraints", constraints.withColumn("record_id", F.col("id")), [("source_id", F.array("source_id"), "units")]),
        ("context_packages", packages.withColumn("record_id", F.col("id")), [("core_unit_ids", F.col("core_unit_ids"), "units"), ("constraint_ids", F.col("constraint_ids"), "unit_constraints")]),
        ("package_states", states.withColumn("record_id", F.concat_ws(":", "run_id", "context_package_id")), [("rule_ids_json", references.json_ids(F.col("rule_ids_json")), "rules")]),
    ]
    refs = None
    for name, df, fields in sources:
        seen = df.groupBy("record_id").agg(F.min("ingested_at").alias("seen"))
        fields_at = F.array(*[F.struct(F.lit(f).alias("ref_field"), F.lit(t).alias("target_table"), ids.alias("ids")) for f, ids, t in fields])
        each = df.select("record_id", F.explode(fields_at).alias("x")).select("record_id", "x.ref_field", "x.target_table", F.explode("x.ids").alias("target_id"))
        each = each.where(F.col("target_id").isNotNull()).distinct().join(seen, "record_id")
        each = each.select(F.lit(name).alias("ref_table"), "record_id", "ref_field", "target_table", "target_id", "seen")
        refs = each if refs is None else refs.unionByName(each)
    targets = None
    for t in ("units", "unit_constraints", "rules"):
        part = first_delivery(table(spark, sf, t), ["id"], first_deleted=F.min("deleted_at")).withColumn("target_table", F.lit(t))
        targets = part if targets is None else targets.unionByName(part)
    return refs, targets


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct reference without a valid target."""
    refs, targets = all_references(spark, sf)
    found = references.timed_orphans(refs, targets, [("target_table", "target_table"), ("target_id", "id")], nullable=["target_id"])
    return found.select("ref_table", "record_id", "ref_field", "target_id", "reason", "period")


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans per table, field, reason and month."""
    return references.orphans_per_period(p2_found(spark, sf))


_P2_SQL = """
WITH uc AS (SELECT id AS record_id, min(ingested_at) AS seen FROM unit_constraints GROUP BY 1),
cp AS (SELECT id AS record_id, min(ingested_at) AS seen FROM context_packages GROUP BY 1),
ps AS (SELECT run_id || ':' || context_package_id AS record_id, min(ingested_at) AS seen FROM package_states GROUP BY 1),
refs AS (
  SELECT DISTINCT 'unit_constraints' AS ref_table, id AS record_id, 'source_id' AS ref_field, 'units' AS tt, source_id AS target_id, seen
  FROM unit_constraints JOIN uc ON id = record_id
  UNION SELECT 'context_packages', id, 'core_unit_ids', 'units', unnest(core_unit_ids), seen FROM context_packages JOIN cp ON id = record_id
  UNION SELECT 'context_packages', id, 'constraint_ids', 'unit_constraints', unnest(constraint_ids), seen FROM context_packages JOIN cp ON id = record_id
  UNION SELECT 'package_states', p.run_id || ':' || p.context_package_id, 'rule_ids_json', 'rules',
    unnest(CASE WHEN json_valid(rule_ids_json) AND json_type(TRY_CAST(rule_ids_json AS JSON)) = 'ARRAY' THEN CAST(TRY_CAST(rule_ids_json AS JSON) AS VARCHAR[]) END), seen
  FROM package_states p JOIN ps ON p.run_id || ':' || p.context_package_id = record_id),
targets AS (
  SELECT 'units' AS tt, id, min(ingested_at) AS fi, min(deleted_at) AS fd FROM units GROUP BY 2
  UNION ALL SELECT 'unit_constraints', id, min(ingested_at), min(deleted_at) FROM unit_constraints GROUP BY 2
  UNION ALL SELECT 'rules', id, min(ingested_at), min(deleted_at) FROM rules GROUP BY 2),
status AS (
  SELECT r.*, CASE WHEN t.id IS NULL THEN 'missing' WHEN fi > seen THEN 'late' WHEN fd <= seen THEN 'deleted' END AS reason
  FROM refs r LEFT JOIN targets t ON r.tt = t.tt AND r.target_id = t.id WHERE r.target_id IS NOT NULL),
found AS (SELECT ref_table, record_id, ref_field, target_id, reason, strftime(seen, '%Y-%m') AS period FROM status WHERE reason IS NOT NULL)
"""

# --- hierarchies --------------------------------------------------------------------------------------------------------


def relation_kind(column: str = "type") -> F.Column:
    """A relation's type without case, blanks and separators."""
    return F.regexp_replace(F.upper(column), r"[^\p{L}]", "")


def _tree(spark: SparkSession, sf: str, paths: bool = False) -> hierarchy.Tree:
    return hierarchy.Tree(isa_links(spark, sf), Scratch(spark, "hierarchy"), paths=paths)


def isa_links(spark: SparkSession, sf: str) -> DataFrame:
    """(child, parent) of the IS_A rows."""
    relations = table(spark, sf, "concept_relations").where(relation_kind() == "ISA")
    return hierarchy.links(relations, "child_concept_id", "parent_concept_id")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Root and depth of every id in an IS_A link."""
    return _tree(spark, sf).rows().select("concept_id", "root_id", "depth")


def p5_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Full path of every node, from its root down, and its number of descendants; nodes on or below cycles have no path and -1."""
    tree = _tree(spark, sf, True)
    below = tree.descendants().groupBy(F.col("ancestor").alias("concept_id")).agg(F.count("*").alias("n_descendants"))
    out = tree.rows().select("concept_id", "root_id", "depth", F.array_join("path", " > ").alias("path")).join(below, "concept_id", "left")
    return out.withColumn("n_descendants", F.when(F.col("depth") >= 0, F.coalesce("n_descendants", F.lit(0))).otherwise(-1))


def p5_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """Every ancestor with every descendant and the shortest distance between them, through all parents; cyclic parts have none."""
    return _tree(spark, sf).descendants()


def p5_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Every node on a cycle, with the smallest id of its cycle or of the cycles that share nodes with it."""
    return hierarchy.cycles(isa_links(spark, sf), Scratch(spark, "cycles"))


_P5_SQL = """
WITH RECURSIVE e AS (
  SELECT DISTINCT child_concept_id AS c, parent_concept_id AS p FROM concept_relations
  WHERE regexp_replace(upper(type), '[^\\p{L}]', '', 'g') = 'ISA' AND child_concept_id IS NOT NULL AND parent_concept_id IS NOT NULL),
nodes AS (SELECT c AS id FROM e UNION SELECT p FROM e),
up AS (SELECT c AS id, p AS here FROM e UNION SELECT u.id, e.p FROM up u JOIN e ON e.c = u.here),
oncycle AS (SELECT id FROM up WHERE id = here),
bad AS (SELECT id, min(root) AS root FROM (SELECT id, id AS root FROM oncycle UNION ALL SELECT u.id, o.id FROM up u JOIN oncycle o ON o.id = u.here) GROUP BY 1),
good AS (SELECT * FROM e WHERE c NOT IN (SELECT id FROM bad)),
down AS (
  SELECT id, id AS root, 0 AS depth, id AS path FROM nodes WHERE id NOT IN (SELECT c FROM e)
  UNION ALL SELECT good.c, d.root, d.depth + 1, d.path || ' > ' || good.c FROM down d JOIN good ON good.p = d.id),
fine AS (SELECT id, arg_min(root, (depth, root, path)) AS root, min(depth) AS depth, arg_min(path, (depth, root, path)) AS path FROM down GROUP BY 1),
pairs AS (SELECT p AS anc, c AS descendant, 1 AS dist FROM good UNION SELECT x.anc, good.c, x.dist + 1 FROM pairs x JOIN good ON good.p = x.descendant),
anc AS (SELECT anc, descendant, min(dist) AS dist FROM pairs GROUP BY ALL),
tree AS (SELECT id AS concept_id, root AS root_id, CAST(depth AS INTEGER) AS depth, path FROM fine
  UNION ALL SELECT id, root, CAST(-1 AS INTEGER), NULL FROM bad)
"""

# --- units of measure ---------------------------------------------------------------------------------------------------

MAYBE_NUMBER = "[0-9０-９零〇一二两三四五六七八九十百千万]"


def measured(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (state_id, ...) with the quantity of raw_state in its common unit."""
    rows = table(spark, sf, "rule_states").where(F.col("raw_state").rlike(MAYBE_NUMBER)).select("state_id", "object", "raw_state", "normalized_state", "ingested_at")
    q = quantity_column(F.col("raw_state"), F.col("normalized_state"))
    return rows.withColumn("q", q).where("q.common_unit is not null")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with a measured quantity, converted to the common unit of its kind."""
    return measured(spark, sf).select("state_id", "q.common_unit", "q.lower_value", "q.upper_value").distinct()


def _histories(spark: SparkSession, sf: str) -> DataFrame:
    """(source, kind, at, id, value): each object's numbers as they are written, bare ones included."""
    rows = table(spark, sf, "rule_states").where(F.col("raw_state").rlike(MAYBE_NUMBER))
    rows = rows.withColumn("q", written_column(F.col("raw_state"), F.col("normalized_state"))).where("q.kind is not null")
    return rows.select(F.coalesce("object", F.lit("")).alias("source"), "q.kind", F.col("ingested_at").alias("at"), F.col("state_id").alias("id"), "q.value")


def p7_shifts(spark: SparkSession, sf: str) -> DataFrame:
    """Unit changes by level: each object's histories of unconverted numbers, segmented on log values; shifts by a known factor."""
    return changepoints.unit_shifts(_histories(spark, sf))


def p7_reversed(spark: SparkSession, sf: str) -> DataFrame:
    """Every number of the histories in the unit with which its history begins, by the factors of ``p7_shifts``."""
    scratch = Scratch(spark, "reversed")
    rows = scratch.table("histories", _histories(spark, sf))
    return changepoints.reversed_values(rows, scratch.table("shifts", changepoints.unit_shifts(rows)))


QUERIES = {"p2_found": p2_found, "p2_report": p2_report, "p5_found": p5_found, "p5_paths": p5_paths, "p5_descendants": p5_descendants, "p5_cycles": p5_cycles, "p7_found": p7_found, "p7_shifts": p7_shifts, "p7_reversed": p7_reversed}

SQL = {
    "p2_found": _P2_SQL + "SELECT * FROM found",
    "p2_report": _P2_SQL + "SELECT ref_table, ref_field, reason, period, count(*) AS n_orphans, count(DISTINCT record_id) AS n_records FROM found GROUP BY ALL",
    "p5_found": _P5_SQL + "SELECT concept_id, root_id, depth FROM tree",
    "p5_paths": _P5_SQL + "SELECT concept_id, root_id, depth, path, CASE WHEN depth >= 0 THEN coalesce((SELECT count(*) FROM anc WHERE anc = concept_id), 0) ELSE -1 END AS n_descendants FROM tree",
    "p5_descendants": _P5_SQL + "SELECT anc AS ancestor, descendant, CAST(dist AS INTEGER) AS distance FROM anc",
    "p5_cycles": _P5_SQL + "SELECT o.id AS concept_id, least(o.id, min(u.here)) AS cycle_id FROM oncycle o JOIN up u ON u.id = o.id JOIN up b ON b.id = u.here AND b.here = o.id GROUP BY o.id",
}
