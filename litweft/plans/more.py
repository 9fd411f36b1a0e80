"""Queries of the remaining lookups, mappings, builders and helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litweft.functions import text as tx
from litweft.operators import annotate, consensus, dictionaries, documents, frames, genome, mapping, ontology, serve
from litweft.plans.project import EVIDENCE_SQL, ONTOLOGY_SQL, evidence
from litweft.plans.project import ontology as tree
from litweft.session import table


def interaction_details(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence by document with its text and the concepts of the document."""
    rel = table(spark, sf, "documents").select(F.col("source").alias("mirna_family"), F.col("lang").alias("gene_family"), F.col("journal").alias("interaction"), F.col("article_id").alias("doc_id"), F.col("doc_id").cast("string").alias("sent_id"))
    text = table(spark, sf, "documents").where("text <> ''").select(F.col("doc_id").cast("string").alias("sent_id"), "text")
    d = serve.details(rel, text, table(spark, sf, "mx_annot"))
    return d.select("doc_id", "sent_id", "text", F.array_join("concepts", "#").alias("concepts"))


def natural_order(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of the natural order of document ids: prefix, then number."""
    docs = table(spark, sf, "mx_dates").where("doc_id <> ''").select("doc_id").distinct()
    prefix, number, _ = serve.natural_key(F.col("doc_id"))
    return docs.select("doc_id", prefix.alias("prefix"), number.cast("long").alias("number"))


def chunk_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return documents.chunks(table(spark, sf, "mx_annot").select("doc_id"), 40).groupBy("chunk").agg(F.count("*").alias("n"))


def document_sources(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "mx_dates").select("row_id", serve.source_link(F.col("doc_id")).alias("s")).select("row_id", "s.source")


def subtree_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    terms = part.select(F.col("p_partkey").cast("string").alias("term_id"), F.col("p_name").alias("name"), (F.col("p_size") == 13).alias("is_obsolete"))
    syns = part.select(F.col("p_partkey").cast("string").alias("term_id"), F.col("p_type").alias("syn"))
    edges = tree(spark, sf).select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent"))
    d = dictionaries.from_ontology(terms, syns, edges, excluded_roots=["5", "12"], excluded_terms=["9"])
    return d.select("term_id", F.array_join("syns", "|").alias("syns"))


def symbol_merge(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "part").select(F.col("p_brand").alias("term_id"), F.array("p_type", "p_name").alias("syns"))
    return dictionaries.merge_symbols(li).select("term_id", F.array_join("syns", "|").alias("syns"))


def symbol_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    marks = part.select(F.col("p_partkey").alias("marker_id"), F.col("p_name").alias("symbol"), F.concat_ws("|", "p_brand", "p_type").alias("uniprot_ids"))
    prot = part.select(F.col("p_brand").alias("protein"), F.col("p_type").alias("symbol"))
    return mapping.enrich_symbols(marks, prot)


def alias_names(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("accession"), F.col("n_name").alias("name"))
    a = table(spark, sf, "region").select(F.col("r_regionkey").alias("accession"), F.concat_ws(";", "r_name", F.lower("r_name")).alias("names"))
    return mapping.alias_join(n, a)


def term_names(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot").where("concept_id is not null").select("row_id", F.when(F.col("row_id") % 2 == 0, F.regexp_replace("concept_id", ":", "_")).otherwise(F.col("concept_id")).alias("concept_id"))
    t = table(spark, sf, "mx_annot").where("concept <> ''").groupBy(F.col("concept_id").alias("term_id")).agg(F.min("concept").alias("name"))
    return mapping.term_by_id(a, t).select("row_id", "term_name")


def merged_terms(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("term_id"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("synonyms"), F.array(F.substring("c_name", 1, 3)).alias("parents"), F.array().cast("array<string>").alias("children"))
    m = ontology.merge_terms(c)
    return m.select("term_id", "name", F.array_join("synonyms", "|").alias("synonyms"), F.size("children").cast("long").alias("n"))


def ancestors_by_level(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "part").where("p_partkey > 1").select(F.col("p_partkey").alias("node"))
    lv = ontology.by_level(ontology.closure(seeds, tree(spark, sf), max_depth=3, up=True))
    return lv.select("seed", "level", F.array_join(F.transform("nodes", lambda x: x.cast("string")), ",").alias("nodes"))


def excluded_annotations(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot").where("doc_id is not null and concept_id is not null").select("row_id", "doc_id", F.when(F.col("row_id") % 7 == 0, F.concat("concept_id", F.lit("_excl"))).otherwise(F.col("concept_id")).alias("concept_id"))
    return annotate.suppress_excluded(a).select("row_id", "doc_id", "concept_id")


def entity_spans(spark: SparkSession, sf: str) -> DataFrame:
    ev = evidence(spark, sf).select("sent_id", F.when(F.col("direction") == "A", "GENE_MIR").otherwise("MIR_GENE").alias("direction"), F.length("mirna_family").alias("loc1"), F.length("gene_family").alias("loc2"))
    s = consensus.spans_by_entity(ev)
    return s.groupBy("direction").agg(F.sum("loc_mirna").alias("mir"), F.sum("loc_gene").alias("gene"))


def site_tracks(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    s = li.select(F.col("l_partkey").cast("string").alias("gene"), F.col("l_returnflag").alias("mirna"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("end"), F.col("l_linenumber").alias("score"))
    t = genome.site_tracks(s)
    return t.select("gene", "mirna", F.array_join(F.transform("sites", lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("sites"))


def dna_complement(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", F.translate("p_name", "abcdefghijklmnopqrstuvwxyz ", "ACGTACGTACGTACGTACGTACGTACG").alias("dna"))
    return p.select("p_partkey", tx.complement(F.col("dna")).alias("rc"))


def text_around(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    a = (F.col("doc_id") % 20).cast("int")
    b = (F.col("doc_id") % 31).cast("int")
    return d.select("doc_id", tx.around(F.col("text"), a, a + 5, b, b + 4).alias("x")).select("doc_id", "x.before", "x.between", "x.after", "x.order")


def frame_append(spark: SparkSession, sf: str) -> DataFrame:
    r, n = table(spark, sf, "region"), table(spark, sf, "nation")
    both = frames.append(r.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("k")), n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")))
    return frames.rows_in(frames.add_columns(both, {"kind": "place"}), "k", [1, 2, 3])


def frame_map(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").withColumn("k", F.col("n_regionkey").cast("string"))
    return frames.to_map(n, "k", "n_name", "n_nationkey").select(F.explode("map").alias("k", "last"))


def frame_first(spark: SparkSession, sf: str) -> DataFrame:
    return frames.first_row(table(spark, sf, "customer"), "c_mktsegment", "BUILDING", ["c_custkey"]).select("c_custkey", "c_name")


def group_sets(spark: SparkSession, sf: str) -> DataFrame:
    g = frames.group_rows(table(spark, sf, "mx_annot").where("annotation is not null"), "annotation", "doc_id")
    return g.groupBy("annotation").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


def rank_documents(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "mx_annot").groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is not null")
    w = Window.partitionBy(F.substring("doc_id", 1, 4)).orderBy(F.desc("n"), "doc_id")
    return n.withColumn("place", F.row_number().over(w)).where("place <= 3").select("doc_id", "n", F.col("place").cast("long").alias("place"))


QUERIES = {
    f.__name__: f
    for f in (
        interaction_details, natural_order, chunk_sizes, document_sources, subtree_exclusion, symbol_merge, symbol_enrichment, alias_names, term_names, merged_terms, ancestors_by_level,
        excluded_annotations, entity_spans, site_tracks, dna_complement, text_around, frame_append, frame_map, frame_first, group_sets, rank_documents,
    )
}

ORACLE = {
    "interaction_details": """
SELECT article_id AS doc_id, CAST(d.doc_id AS VARCHAR) AS sent_id, text,
  coalesce((SELECT string_agg(DISTINCT concept, '#' ORDER BY concept) FROM mx_annot a WHERE a.doc_id = article_id AND concept <> ''), '') AS concepts FROM documents d WHERE text <> ''""",
    "natural_order": "SELECT DISTINCT doc_id, regexp_extract(doc_id, '^[^0-9]*') AS prefix, CAST(regexp_extract(doc_id, '[0-9]+') AS BIGINT) AS number FROM mx_dates WHERE doc_id <> ''",
    "chunk_sizes": "SELECT chunk, count(*) AS n FROM (SELECT (dense_rank() OVER (ORDER BY doc_id) - 1) // 40 AS chunk FROM mx_annot WHERE doc_id IS NOT NULL) GROUP BY 1",
    "document_sources": "SELECT row_id, CASE WHEN doc_id LIKE 'PMC%' THEN 'PMC' ELSE 'PUBMED' END AS source FROM mx_dates",
    "subtree_exclusion": f"""
WITH RECURSIVE {ONTOLOGY_SQL}, bad AS (SELECT 5 AS node UNION ALL SELECT 12 UNION ALL SELECT e.child FROM bad JOIN edge e ON e.parent = bad.node)
SELECT CAST(p_partkey AS VARCHAR) AS term_id, least(p_name, p_type) || CASE WHEN p_name <> p_type THEN '|' || greatest(p_name, p_type) ELSE '' END AS syns
FROM part WHERE p_size <> 13 AND p_partkey <> 9 AND p_partkey NOT IN (SELECT node FROM bad)""",
    "symbol_merge": "SELECT p_brand AS term_id, string_agg(DISTINCT s, '|' ORDER BY s) AS syns FROM (SELECT p_brand, p_type AS s FROM part UNION ALL SELECT p_brand, p_name FROM part) GROUP BY 1",
    "symbol_enrichment": """
WITH m AS (SELECT p_partkey AS marker_id, p_name, p_brand, p_type FROM part), u AS (SELECT p_brand AS protein, p_type AS symbol FROM part)
SELECT marker_id, p_name AS symbol FROM m UNION SELECT marker_id, symbol FROM m JOIN u ON protein IN (p_brand, p_type)""",
    "alias_names": """
SELECT n_nationkey AS accession, n_name AS name, alias FROM nation LEFT JOIN (SELECT r_regionkey, r_name AS alias FROM region UNION ALL SELECT r_regionkey, lower(r_name) FROM region) ON r_regionkey = n_nationkey""",
    "term_names": "SELECT row_id, name AS term_name FROM mx_annot LEFT JOIN (SELECT concept_id, min(concept) AS name FROM mx_annot WHERE concept <> '' GROUP BY 1) USING (concept_id) WHERE concept_id IS NOT NULL",
    "merged_terms": "SELECT CAST(c_nationkey AS VARCHAR) AS term_id, min(c_name) AS name, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS synonyms, CAST(0 AS BIGINT) AS n FROM customer GROUP BY 1",
    "ancestors_by_level": "SELECT p_partkey AS seed, CAST(l AS BIGINT) AS level, CAST(p_partkey // (2 ** l)::BIGINT AS VARCHAR) AS nodes FROM part, (SELECT unnest([1, 2, 3]) AS l) WHERE p_partkey > 1 AND p_partkey // (2 ** l)::BIGINT >= 1",
    "excluded_annotations": """
WITH a AS (SELECT row_id, doc_id, CASE WHEN row_id % 7 = 0 THEN concept_id || '_excl' ELSE concept_id END AS c FROM mx_annot WHERE doc_id IS NOT NULL AND concept_id IS NOT NULL)
SELECT row_id, doc_id, c AS concept_id FROM a WHERE row_id % 7 <> 0 AND NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.c = a.c || '_excl')""",
    "entity_spans": f"""WITH {EVIDENCE_SQL} SELECT CASE WHEN direction = 'A' THEN 'GENE_MIR' ELSE 'MIR_GENE' END AS direction, CAST(sum(CASE WHEN direction = 'A' THEN length(gene_family) ELSE length(mirna_family) END) AS BIGINT) AS mir,
  CAST(sum(CASE WHEN direction = 'A' THEN length(mirna_family) ELSE length(gene_family) END) AS BIGINT) AS gene FROM ev GROUP BY 1""",
    "site_tracks": """SELECT CAST(l_partkey AS VARCHAR) AS gene, l_returnflag AS mirna, string_agg(l_orderkey || '-' || (l_orderkey + l_linenumber), ',' ORDER BY l_orderkey, l_linenumber) AS sites
FROM lineitem GROUP BY 1, 2""",
    "dna_complement": "SELECT p_partkey, reverse(translate(translate(p_name, 'abcdefghijklmnopqrstuvwxyz ', 'ACGTACGTACGTACGTACGTACGTACG'), 'ACGT', 'TGCA')) AS rc FROM part",
    "text_around": """WITH x AS (SELECT doc_id, text AS t, CAST(doc_id % 20 AS INT) AS a, CAST(doc_id % 31 AS INT) AS b FROM documents WHERE text IS NOT NULL)
SELECT doc_id, substr(t, 1, least(a, b)) AS "before", substr(t, least(a + 5, b + 4) + 1, greatest(greatest(a, b) - least(a + 5, b + 4), 0)) AS "between", substr(t, greatest(a + 5, b + 4) + 1) AS "after",
  CASE WHEN a + 5 <= b THEN 'AB' WHEN b + 4 <= a THEN 'BA' END AS "order" FROM x""",
    "frame_append": "SELECT r_name AS name, r_regionkey AS k, 'place' AS kind FROM region WHERE r_regionkey IN (1, 2, 3) UNION ALL SELECT n_name, n_nationkey, 'place' FROM nation WHERE n_nationkey IN (1, 2, 3)",
    "frame_map": "SELECT CAST(n_regionkey AS VARCHAR) AS k, arg_max(n_name, n_nationkey) AS last FROM nation GROUP BY 1",
    "frame_first": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 1",
    "group_sets": "SELECT annotation, count(DISTINCT doc_id) AS n, min(doc_id) AS first FROM mx_annot WHERE annotation IS NOT NULL GROUP BY 1",
    "rank_documents": """SELECT doc_id, n, place FROM (SELECT *, row_number() OVER (PARTITION BY substr(doc_id, 1, 4) ORDER BY n DESC, doc_id) AS place
FROM (SELECT doc_id, count(*) AS n FROM mx_annot WHERE doc_id IS NOT NULL GROUP BY 1)) WHERE place <= 3""",
}
