"""Queries of filters, containers, labels and reshaping helpers, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.functions import synonyms
from litweft.functions import text as tx
from litweft.operators import consensus, evaluate, ontology, serve
from litweft.plans.project import EVIDENCE_SQL, ONTOLOGY_SQL, SENTENCES_SQL, evidence, sentences
from litweft.plans.project import ontology as tree
from litweft.session import table


def short_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Which words of the corpus, as hits with the signs around them, pass the filter of short hits."""
    w = sentences(spark, sf).select(F.explode(F.split("text", " ")).alias("w")).distinct()
    lead, tail = F.regexp_extract("w", "^([^A-Za-z0-9]*)", 1), F.regexp_extract("w", "([^A-Za-z0-9]*)$", 1)
    h = w.select("w", lead.alias("prefix"), tail.alias("suffix")).withColumn("found", F.expr("substr(w, length(prefix) + 1, greatest(length(w) - length(prefix) - length(suffix), 0))")).where("found <> ''")
    return h.where(tx.strong_hit(F.col("found"), F.col("prefix"), F.col("suffix"), F.col("found") == F.upper("found"))).select("w", "found")


def mirna_hits(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "mx").where("mirna_family <> ''").select("row_id", F.expr("left(mirna_family, 4 + cast(row_id % 5 as int))").alias("found"), F.expr("element_at(array('hsa-', 'rno-', '', 'Mmu-'), cast(row_id % 4 as int) + 1)").alias("prefix"))
    return m.where(tx.mirna_hit(F.col("found"), F.col("prefix")))


def context_hits(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot").where("concept <> ''").select("row_id", "concept", (F.col("num_occurrences") > 1).alias("exact"))
    return a.where(tx.context_hit(F.col("concept"), F.col("exact"))).select("row_id", "concept")


def excluded_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Synonym lists without excluded words, numbers and single letters."""
    s = table(spark, sf, "part").select("p_partkey", F.array("p_name", F.lower("p_type"), "p_brand", F.lit("-12.5e3"), F.col("p_size").cast("string"), F.lit("x")).alias("syns"))
    kept = synonyms.without_numbers(synonyms.without_excluded(F.col("syns"), {"common": ["SMALL", "hot bolt"], "taxnames": ["large", "MEDIUM"]}))
    return s.select("p_partkey", F.array_join(kept, "|").alias("syns"), synonyms.unfindable(F.col("p_partkey").cast("string")).alias("mark"))


def inverted_cells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", synonyms.invert_cell(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " cell of ").otherwise(" cells of "), "p_type")).alias("name"))


def gene_symbols(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "mx").where("gene_family <> ''").select("row_id", F.concat(F.expr("element_at(array('MIR', 'mir', ''), cast(row_id % 3 as int) + 1)"), "gene_family", F.when(F.col("row_id") % 2 == 0, "HG").otherwise("")).alias("symbol"))
    return s.where(synonyms.is_gene_symbol(F.col("symbol")))


def synonym_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Match, merge and removal in synonym lists."""
    s = table(spark, sf, "part").select("p_partkey", F.array("p_name", "p_type").alias("a"), F.array("p_brand", "p_type").alias("b"))
    union = synonyms.merge(F.col("a"), F.col("b"))
    return s.select("p_partkey", F.array_join(union, "|").alias("merged"), F.array_join(synonyms.remove(union, F.lit("SMALL")), "|").alias("left"), synonyms.matches(F.col("a"), F.lit("small")).alias("hit"))


def label_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, mixed names and cleaned database ids among concepts and genes."""
    c = table(spark, sf, "mx_annot").where("concept <> ''").select(F.col("concept").alias("label")).unionByName(table(spark, sf, "mx").where("gene_family <> ''").select(F.col("gene_family").alias("label")))
    c = c.unionByName(table(spark, sf, "part").select(F.concat((F.col("p_size") - 20).cast("string"), F.lit(".5")).alias("label"))).distinct()
    return c.select("label", synonyms.is_number(F.col("label")).alias("number"), synonyms.has_digit_and_letter(F.col("label")).alias("mixed"))


def gold_labels(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.expr("element_at(array('TARGET', 'INVCORR', 'REGULATE', 'UP', 'DOWN'), cast(o_orderkey % 5 as int) + 1)").alias("dir"))
    return evaluate.gold_labels(o).groupBy("dir").agg(F.count("*").alias("n"))


def subset_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Support-weighted scores of the labels for every subset of the checks."""
    li = table(spark, sf, "lineitem")
    checks = {"qty": F.col("l_quantity") > 25, "disc": F.col("l_discount") < 0.05}
    return evaluate.weighted_by_subset(li, checks, "l_returnflag", F.when(F.col("l_tax") < 0.04, F.col("l_returnflag")).otherwise("N"))


def term_genes(spark: SparkSession, sf: str) -> DataFrame:
    """Genes annotated with a term or one below it, in some organisms."""
    a = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("term"), F.col("l_suppkey").alias("gene"), F.col("l_linenumber").alias("taxon"))
    terms = table(spark, sf, "part").where("p_partkey in (7, 20, 21)").select(F.col("p_partkey").alias("node"))
    return ontology.term_genes(a, terms, tree(spark, sf), [1, 3])


def row_details(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the interaction table as JSON objects."""
    mx = table(spark, sf, "mx").where("mirna_family <> '' and gene_family <> '' and evidence_count is not null")
    return mx.select("row_id", serve.as_object(mirna=F.col("mirna_family"), gene=F.col("gene_family"), count=F.col("evidence_count")).alias("object"))


def packed_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence rows packed into nested columns and read back by field."""
    ev = evidence(spark, sf).withColumn("loc1", F.length("mirna_family")).withColumn("loc2", F.length("gene_family"))
    p = consensus.pack_evidence(consensus.spans_by_entity(ev.withColumn("direction", F.when(F.col("direction") == "A", "MIR_GENE").otherwise("GENE_MIR"))))
    return p.groupBy(consensus.clean_family(F.concat(F.lit("__"), "mirna_family", F.lit("__"))).alias("family"), F.col("interaction.int_dir").alias("dir")).agg(
        F.countDistinct("evidence.sent").alias("sents"), F.sum(F.col("evidence.loc_mirna").cast("long")).alias("mir_at"), F.sum(F.col("evidence.loc_gene").cast("long")).alias("gene_at")
    )


QUERIES = {
    f.__name__: f
    for f in (short_hits, mirna_hits, context_hits, excluded_synonyms, inverted_cells, gene_symbols, synonym_ops, label_tests, gold_labels, subset_scores, term_genes, row_details, packed_evidence)
}

_SIGNS = "' ()[],;.' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = {
    "short_hits": f"""WITH {SENTENCES_SQL}, w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS w FROM sent),
p AS (SELECT w, regexp_extract(w, '^([^A-Za-z0-9]*)', 1) AS prefix, regexp_extract(w, '([^A-Za-z0-9]*)$', 1) AS suffix FROM w),
h AS (SELECT *, substr(w, length(prefix) + 1, greatest(length(w) - length(prefix) - length(suffix), 0)) AS found FROM p)
SELECT w, found FROM h WHERE found <> '' AND (length(found) NOT BETWEEN 2 AND 5 OR (trim(prefix, {_SIGNS}) = '' AND trim(suffix, {_SIGNS}) = '' AND found = upper(found)))""",
    "mirna_hits": """WITH m AS (SELECT row_id, left(mirna_family, 4 + row_id % 5) AS found, ['hsa-', 'rno-', '', 'Mmu-'][row_id % 4 + 1] AS prefix FROM mx WHERE mirna_family <> '')
SELECT * FROM m WHERE prefix <> 'rno-' AND (length(found) > 5 OR starts_with(lower(found), 'mir') OR starts_with(lower(found), 'micro') OR starts_with(lower(found), 'let'))""",
    "context_hits": "SELECT row_id, concept FROM mx_annot WHERE concept <> '' AND (length(concept) >= 6 OR coalesce(num_occurrences > 1, false)) AND NOT contains(concept, 'and ')",
    "excluded_synonyms": """WITH s AS (SELECT p_partkey, [p_name, lower(p_type), p_brand] AS xs FROM part)
SELECT p_partkey, array_to_string(list_filter(xs, lambda x: x NOT IN ('SMALL', 'hot bolt', 'large', 'MEDIUM') AND upper(x) NOT IN ('SMALL', 'hot bolt')), '|') AS syns, '__' || p_partkey || '__' AS mark FROM s""",
    "inverted_cells": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type || ' ' || p_name || ' cell' ELSE p_name || ' cells of ' || p_type END AS name FROM part",
    "gene_symbols": """WITH s AS (SELECT row_id, ['MIR', 'mir', ''][row_id % 3 + 1] || gene_family || CASE WHEN row_id % 2 = 0 THEN 'HG' ELSE '' END AS symbol FROM mx WHERE gene_family <> '')
SELECT * FROM s WHERE NOT starts_with(upper(symbol), 'MIR') OR ends_with(upper(symbol), 'HG')""",
    "synonym_ops": """SELECT p_partkey, p_name || '|' || p_type || '|' || p_brand AS merged, CASE WHEN p_type = 'SMALL' THEN p_name || '|' || p_brand ELSE p_name || '|' || p_type || '|' || p_brand END AS left,
  lower(p_type) = 'small' OR lower(p_name) = 'small' AS hit FROM part""",
    "label_tests": """WITH c AS (SELECT concept AS label FROM mx_annot WHERE concept <> '' UNION SELECT gene_family FROM mx WHERE gene_family <> '' UNION SELECT (p_size - 20) || '.5' FROM part)
SELECT label, try_cast(label AS DOUBLE) IS NOT NULL AND NOT regexp_matches(label, '[A-Za-z]') AS number, regexp_matches(label, '[0-9]') AND regexp_matches(label, '[A-Za-z]') AS mixed FROM c""",
    "gold_labels": "SELECT CASE WHEN o_orderkey % 5 < 3 THEN 'NEU' WHEN o_orderkey % 5 = 3 THEN 'UP' ELSE 'DOWN' END AS dir, count(*) AS n FROM orders GROUP BY 1",
    "subset_scores": """WITH r AS (SELECT unnest(range(4)) AS mask, l_returnflag AS t, CASE WHEN l_tax < 0.04 THEN l_returnflag ELSE 'N' END AS p0, l_quantity > 25 AS a, l_discount < 0.05 AS b FROM lineitem),
q AS (SELECT mask, t, CASE WHEN (mask & 1 = 0 OR a) AND (mask & 2 = 0 OR b) THEN p0 ELSE 'NA' END AS p FROM r),
s AS (SELECT mask, t AS label, count(*) AS support, count(*) FILTER (p = t) AS tp FROM q GROUP BY ALL), c AS (SELECT mask, p AS label, count(*) AS claimed FROM q GROUP BY ALL),
m AS (SELECT s.mask, support, CAST(tp AS DOUBLE) / nullif(claimed, 0) AS pr, CAST(tp AS DOUBLE) / support AS re, 2.0 * tp / (support + coalesce(claimed, 0)) AS f FROM s LEFT JOIN c ON c.mask = s.mask AND c.label = s.label)
SELECT concat_ws('+', CASE WHEN mask & 1 <> 0 THEN 'qty' END, CASE WHEN mask & 2 <> 0 THEN 'disc' END) AS subset, CAST(sum(support) AS BIGINT) AS support, round(sum(coalesce(pr, 0) * support) / sum(support), 6) AS "precision",
  round(sum(re * support) / sum(support), 6) AS recall, round(sum(f * support) / sum(support), 6) AS f1 FROM m GROUP BY mask""",
    "term_genes": f"""WITH RECURSIVE {ONTOLOGY_SQL}, c AS (SELECT p_partkey AS term, p_partkey AS node FROM part WHERE p_partkey IN (7, 20, 21) UNION ALL SELECT c.term, e.child FROM c JOIN edge e ON e.parent = c.node)
SELECT DISTINCT c.term, l_linenumber AS taxon, l_suppkey AS gene FROM c JOIN lineitem ON l_partkey = node WHERE l_linenumber IN (1, 3)""",
    "row_details": """SELECT row_id, '{"mirna":"' || mirna_family || '","gene":"' || gene_family || '","count":' || evidence_count || '}' AS object FROM mx WHERE mirna_family <> '' AND gene_family <> '' AND evidence_count IS NOT NULL""",
    "packed_evidence": f"""WITH {EVIDENCE_SQL} SELECT mirna_family AS family, CASE WHEN direction = 'A' THEN 'MIR_GENE' ELSE 'GENE_MIR' END AS dir, count(DISTINCT sent_id) AS sents,
  CAST(sum(CASE WHEN direction = 'A' THEN length(mirna_family) ELSE length(gene_family) END) AS BIGINT) AS mir_at, CAST(sum(CASE WHEN direction = 'A' THEN length(gene_family) ELSE length(mirna_family) END) AS BIGINT) AS gene_at FROM ev GROUP BY ALL""",
}
