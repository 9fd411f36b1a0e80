"""Queries of evidence, intervals, graphs, mappings and evaluation over the projected tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.operators import consensus as cons
from litweft.operators import evaluate, intervals, mapping, ontology
from litweft.plans.project import EVIDENCE_SQL, ONTOLOGY_SQL, SPANS_SQL, evidence, spans
from litweft.plans.project import ontology as tree
from litweft.session import table


def consensus(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: consensus interactions with document and sentence counts."""
    c = cons.consensus_counts(evidence(spark, sf))
    return c.select("mirna_family", "gene_family", "direction", "regulation", "organisms", "evidence_count", "sent_count", "is_consensus")


def consensus_serving(spark: SparkSession, sf: str) -> DataFrame:
    s = cons.serving_rows(cons.consensus(evidence(spark, sf)))
    return s.select("mirna_family", "gene_family", "interaction", "organisms", "evidence_documents", "sent_evidences", "evidence_count", "sent_count", "is_consensus")


def consensus_documents(spark: SparkSession, sf: str) -> DataFrame:
    return cons.interaction_documents(evidence(spark, sf))


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cons.reject_rows(evidence(spark, sf), bad_names=["CHINA", "PERU"]).groupBy("gene_family").agg(F.count("*").alias("n"))


def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge_spans(spans(spark, sf), ["grp"])


def interval_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    d = intervals.dedupe_overlaps(spans(spark, sf), ["grp"], order="ord", organism="label")
    return d.select("grp", "ord", "label")


def exon_union(spark: SparkSession, sf: str) -> DataFrame:
    s = spans(spark, sf).select(F.col("grp").alias("gene_id"), "start", "end", F.when(F.col("grp") % 2 == 0, "+").otherwise("-").alias("strand"))
    return intervals.exon_union(s)


def span_overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    s = spans(spark, sf)
    j = intervals.overlap_join(s.where("label = 'click'"), s.where("label = 'error'"), ["grp"], width=3600)
    return j.select("grp", "ord_a", "ord_b")


def ontology_descendants(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("node"))
    return ontology.closure(seeds, tree(spark, sf), max_depth=4)


def ontology_descendants_sql(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("node"))
    return ontology.closure_sql(spark, seeds, tree(spark, sf), 3)


def ontology_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "part").where("p_partkey > 1").select(F.col("p_partkey").alias("node"))
    return ontology.closure(seeds, tree(spark, sf), max_depth=2, up=True)


def ontology_at_level(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("node"))
    return ontology.at_level(seeds, tree(spark, sf), 3)


def ontology_roots(spark: SparkSession, sf: str) -> DataFrame:
    return ontology.root_of(tree(spark, sf))


def ontology_parents(spark: SparkSession, sf: str) -> DataFrame:
    return ontology.parents(tree(spark, sf)).select("child", F.array_join("parents", ",").alias("parents"))


def redundant_term_suppression(spark: SparkSession, sf: str) -> DataFrame:
    hits = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("node"))
    return ontology.suppress_descendants(hits, tree(spark, sf))


def id_mapping_chain(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    m = mapping.chain(part.select("p_partkey"), (table(spark, sf, "lineitem"), "l_partkey", "l_suppkey"), (table(spark, sf, "supplier"), "s_suppkey", "s_nationkey"), (table(spark, sf, "nation"), "n_nationkey", "n_name"))
    return m.select("id", F.array_join("targets", ",").alias("targets"))


def family_targets(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    sites = part.select("p_partkey", F.concat_ws(":", "p_name", "p_brand").alias("gene_mir"))
    fam = part.select(F.col("p_brand").alias("family"), F.col("p_type").alias("mirna"))
    return mapping.expand_targets(sites, fam).select("p_partkey", "gene", "family", "mirna")


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    conf = evaluate.confusion(d, F.col("lang") == "en", F.col("n_chars") > 500, ["source"])
    return evaluate.scores(conf)


def label_metrics(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("t"), F.when(F.col("o_totalprice") > 200000, "1").when(F.col("o_totalprice") > 90000, "2").otherwise("3").alias("p"))
    return evaluate.by_label(o, "t", "p")


def ablation_grid(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    checks = {"qty": F.col("l_quantity") > 25, "disc": F.col("l_discount") < 0.05, "tax": F.col("l_tax") < 0.04}
    return evaluate.ablation(li, checks, F.col("l_returnflag") == "R")


def rule_blame(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.blame(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag", "l_linestatus")


QUERIES = {
    f.__name__: f
    for f in (
        consensus, consensus_serving, consensus_documents, rejected_rows, interval_merge, interval_dedupe, exon_union, span_overlap_join, ontology_descendants, ontology_descendants_sql,
        ontology_ancestors, ontology_at_level, ontology_roots, ontology_parents, redundant_term_suppression, id_mapping_chain, family_targets, confusion_metrics, label_metrics, ablation_grid, rule_blame,
    )
}

_CONS = f"""
WITH {EVIDENCE_SQL},
g AS (SELECT mirna_family, gene_family, direction, regulation, string_agg(DISTINCT organism, ';' ORDER BY organism) AS organisms,
             string_agg(DISTINCT doc_id, ';' ORDER BY doc_id) AS evidence_documents, string_agg(DISTINCT sent_id, ';' ORDER BY sent_id) AS sent_evidences, count(DISTINCT doc_id) AS evidence_count, count(DISTINCT sent_id) AS sent_count FROM ev GROUP BY ALL),
cons AS (SELECT *, CASE WHEN evidence_count = max(evidence_count) OVER (PARTITION BY mirna_family, gene_family) THEN 1 ELSE 0 END AS is_consensus FROM g)
"""
_ISLES = f"""
WITH {SPANS_SQL},
o AS (SELECT *, max("end") OVER (PARTITION BY grp ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM sp),
isl AS (SELECT *, sum(CASE WHEN pm IS NULL OR start >= pm THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS i FROM o)
"""


def _down(seeds: str, depth: int) -> str:
    return f"""WITH RECURSIVE {ONTOLOGY_SQL},
c AS (SELECT p_partkey AS seed, p_partkey AS node, 0 AS level FROM part WHERE {seeds}
      UNION ALL SELECT c.seed, e.child, c.level + 1 FROM c JOIN edge e ON e.parent = c.node WHERE c.level < {depth})
"""


_RATES = """round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall"""

ORACLE = {
    "consensus": _CONS + "SELECT mirna_family, gene_family, direction, regulation, organisms, evidence_count, sent_count, is_consensus FROM cons",
    "consensus_serving": _CONS + "SELECT mirna_family, gene_family, direction || ';' || regulation AS interaction, organisms, evidence_documents, sent_evidences, evidence_count, sent_count, is_consensus FROM cons",
    "consensus_documents": f"WITH {EVIDENCE_SQL} SELECT DISTINCT mirna_family, gene_family, direction || ';' || regulation AS interaction, doc_id FROM ev",
    "rejected_rows": f"WITH {EVIDENCE_SQL} SELECT gene_family, count(*) AS n FROM ev WHERE gene_family NOT IN ('CHINA', 'PERU') AND NOT starts_with(upper(gene_family), 'MIR-') GROUP BY 1",
    "interval_merge": _ISLES + 'SELECT grp, min(start) AS start, max("end") AS "end", count(*) AS n FROM isl GROUP BY grp, i',
    "interval_dedupe": _ISLES + "SELECT grp, min(ord) AS ord, string_agg(DISTINCT label, ';' ORDER BY label) AS label FROM isl GROUP BY grp, i",
    "exon_union": f"""WITH {SPANS_SQL},
o AS (SELECT *, max("end") OVER (PARTITION BY grp ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM sp),
isl AS (SELECT *, sum(CASE WHEN pm IS NULL OR start > pm + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS i FROM o),
u AS (SELECT grp AS gene_id, CASE WHEN grp % 2 = 0 THEN '+' ELSE '-' END AS strand, min(start) AS start, max("end") AS "end" FROM isl GROUP BY grp, i)
SELECT gene_id, strand, row_number() OVER (PARTITION BY gene_id ORDER BY CASE WHEN strand = '-' THEN -start ELSE start END) - 1 AS pos, start, "end" FROM u""",
    "span_overlap_join": f"""WITH {SPANS_SQL} SELECT a.grp, a.ord AS ord_a, b.ord AS ord_b FROM sp a JOIN sp b ON a.grp = b.grp AND a.start < b."end" AND b.start < a."end"
WHERE a.label = 'click' AND b.label = 'error' AND a.start < a."end" AND b.start < b."end" """,
    "ontology_descendants": _down("p_partkey > 0", 4) + "SELECT seed, node, CAST(min(level) AS BIGINT) AS level FROM c WHERE level > 0 GROUP BY 1, 2",
    "ontology_descendants_sql": _down("p_partkey > 0", 3) + "SELECT seed, node, CAST(min(level) AS BIGINT) AS level FROM c WHERE level > 0 GROUP BY 1, 2",
    "ontology_ancestors": f"""WITH RECURSIVE {ONTOLOGY_SQL},
c AS (SELECT p_partkey AS seed, p_partkey AS node, 0 AS level FROM part WHERE p_partkey > 1 UNION ALL SELECT c.seed, e.parent, c.level + 1 FROM c JOIN edge e ON e.child = c.node WHERE c.level < 2)
SELECT seed, node, CAST(level AS BIGINT) AS level FROM c WHERE level > 0""",
    "ontology_at_level": _down("p_partkey > 0", 3) + "SELECT seed, node FROM c WHERE level = 3 OR (level BETWEEN 1 AND 2 AND node NOT IN (SELECT parent FROM edge))",
    "ontology_roots": f"""WITH RECURSIVE {ONTOLOGY_SQL}, r AS (SELECT DISTINCT parent AS node FROM edge WHERE parent NOT IN (SELECT child FROM edge)),
c AS (SELECT node, node AS root FROM r UNION ALL SELECT e.child, c.root FROM c JOIN edge e ON e.parent = c.node) SELECT node, root FROM c""",
    "ontology_parents": f"WITH {ONTOLOGY_SQL} SELECT child, CAST(parent AS VARCHAR) AS parents FROM edge",
    "redundant_term_suppression": f"""WITH {ONTOLOGY_SQL}, t AS (SELECT DISTINCT l_orderkey AS doc_id, l_partkey AS node FROM lineitem),
up AS (SELECT child AS node, parent AS anc FROM edge UNION SELECT a.child, b.parent FROM edge a JOIN edge b ON a.parent = b.child),
bad AS (SELECT t.doc_id, t.node FROM t JOIN up USING (node) JOIN t h ON h.doc_id = t.doc_id AND h.node = up.anc)
SELECT l_orderkey AS doc_id, l_partkey AS node FROM lineitem WHERE (l_orderkey, l_partkey) NOT IN (SELECT (doc_id, node) FROM bad)""",
    "id_mapping_chain": """SELECT p_partkey AS id, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS targets FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
    "family_targets": """SELECT p_partkey, p_name AS gene, p_brand AS family, mirna FROM part JOIN (SELECT DISTINCT p_brand AS f, p_type AS mirna FROM part) ON f = p_brand""",
    "confusion_metrics": f"""WITH c AS (SELECT source, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn
 FROM (SELECT source, coalesce(lang = 'en', false) AS t, coalesce(n_chars > 500, false) AS p FROM documents) GROUP BY 1)
SELECT *, {_RATES}, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""",
    "label_metrics": f"""WITH o AS (SELECT substr(o_orderpriority, 1, 1) AS t, CASE WHEN o_totalprice > 200000 THEN '1' WHEN o_totalprice > 90000 THEN '2' ELSE '3' END AS p FROM orders),
c AS (SELECT label, (SELECT count(*) FROM o WHERE t = label) AS support, (SELECT count(*) FROM o WHERE t = label AND p = label) AS tp, (SELECT count(*) FROM o WHERE p = label AND t <> label) AS fp,
  (SELECT count(*) FROM o WHERE t = label AND p <> label) AS fn FROM (SELECT t AS label FROM o UNION SELECT p FROM o))
SELECT *, {_RATES}, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""",
    "ablation_grid": f"""WITH m AS (SELECT unnest(range(8)) AS mask), r AS (SELECT mask, l_returnflag = 'R' AS t,
  (mask & 1 = 0 OR l_quantity > 25) AND (mask & 2 = 0 OR l_discount < 0.05) AND (mask & 4 = 0 OR l_tax < 0.04) AS p FROM lineitem, m),
c AS (SELECT mask, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn FROM r GROUP BY 1)
SELECT concat_ws('+', CASE WHEN mask & 1 <> 0 THEN 'qty' END, CASE WHEN mask & 2 <> 0 THEN 'disc' END, CASE WHEN mask & 4 <> 0 THEN 'tax' END) AS subset, tp, fp, fn, tn,
  {_RATES}, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""",
    "rule_blame": "SELECT l_linestatus, count(*) FILTER (l_returnflag = l_linestatus) AS n_right, count(*) FILTER (l_returnflag <> l_linestatus) AS n_wrong FROM lineitem GROUP BY 1",
}
