"""Queries over the serving tables: search, facets, statistics, documents, timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.operators import annotate, documents, ontology, serve, timeline
from litweft.operators.consensus import consensus_rows
from litweft.operators.serve import TableQuery
from litweft.operators.unpack import IDS, unpack
from litweft.plans.project import ONTOLOGY_SQL, ontology as part_tree
from litweft.session import table

STOP = ["Grade 2 Mogodru", "likrisoation, stage 2"]
MX = ["row_id", "mirna_family", "gene_family", "interaction", "evidence_count"]


def statistics(spark: SparkSession, sf: str) -> DataFrame:
    return serve.statistics(table(spark, sf, "mx"))


def evidence_by_interaction(spark: SparkSession, sf: str) -> DataFrame:
    return serve.evidence_by_interaction(table(spark, sf, "mx"))


def consensus_flag(spark: SparkSession, sf: str) -> DataFrame:
    mx = table(spark, sf, "mx").select("row_id", "mirna_family", "gene_family", "evidence_count")
    return consensus_rows(mx).select("row_id", F.col("is_consensus").alias("flag"))


def top_genes(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "mx").where("gene_family <> ''").groupBy("gene_family").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "gene_family").limit(50)


def concept_counts(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.concept_counts(annotate.without_concepts(table(spark, sf, "mx_annot"), STOP))


def doc_annotations(spark: SparkSession, sf: str) -> DataFrame:
    a = annotate.annotations(table(spark, sf, "mx_annot"))
    return a.select(*annotate.KEY, F.array_join("evidences", "#").alias("evidences"), F.size("evidences").cast("long").alias("n"))


def vocabulary_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.drop_shared_names(table(spark, sf, "mx_annot")).select("row_id", "annotation", "concept")


def vocabulary_exclusion_by_source(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot").withColumn("source", documents.source_of(F.col("doc_id")))
    return annotate.drop_shared_names(a, source="source").select("row_id", "source", "concept")


def organism_sets(spark: SparkSession, sf: str) -> DataFrame:
    o = F.array_join(F.array_sort(F.array_distinct(F.filter(F.split("organisms", ";"), lambda x: x != ""))), ";")
    return table(spark, sf, "mx").where("organisms is not null").select(o.alias("organisms")).groupBy("organisms").agg(F.count("*").alias("n"))


def relevant_docs_semi(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "mx_annot").where("annotation = 'disease'").select("doc_id")
    return documents.relevant(table(spark, sf, "mx_dates"), docs).select("row_id", "doc_id", "pub_date")


def fulltext_dedupe_anti(spark: SparkSession, sf: str) -> DataFrame:
    full = table(spark, sf, "mx_journals").where("doc_id like 'PMC%'").select(F.regexp_replace("doc_id", "^PMC7", "9").alias("pmid"))
    return documents.without_fulltext(table(spark, sf, "mx_journals").where("doc_id not like 'PMC%'"), full).select("row_id", "doc_id")


def annotated_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one document, by the article of the corpus, with the document's disease annotations."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("article_id"))
    inter = docs.select(F.col("doc_id").alias("text_id"), F.col("article_id").alias("doc_id"))
    ann = table(spark, sf, "mx_annot").where("annotation = 'disease'").select("doc_id", "concept_id")
    return annotate.with_interactions(inter, ann).select("text_id", "doc_id", "concept_id")


def first_last_author(spark: SparkSession, sf: str) -> DataFrame:
    return documents.first_last_author(table(spark, sf, "mx_authors"))


def valid_dates(spark: SparkSession, sf: str) -> DataFrame:
    return documents.earliest_date(table(spark, sf, "mx_dates"))


def pubdate_normalise(spark: SparkSession, sf: str) -> DataFrame:
    p = F.split("pub_date", "-")
    d = table(spark, sf, "mx_dates").where("pub_date rlike '^[0-9]+-[0-9]+-[0-9]+$'")
    return d.select("row_id", documents.normal_date(p[0].cast("int"), p[1].cast("int"), p[2].cast("int")).alias("pub_date"))


def journal_names(spark: SparkSession, sf: str) -> DataFrame:
    return documents.journal_names(table(spark, sf, "mx_journals"))


def doc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return documents.chunks(table(spark, sf, "mx_dates").select("row_id", "doc_id"), 50).select("row_id", "chunk")


def table_search_anchor(spark: SparkSession, sf: str) -> DataFrame:
    return serve.matching(table(spark, sf, "mx"), TableQuery(search="^mir-3", columns={"interaction": "up$"})).select(*MX)


def table_filter_page(spark: SparkSession, sf: str) -> DataFrame:
    q = TableQuery(ranges={"evidence_count": (2, 40)}, equals={"is_consensus": "yes"}, order=[("evidence_count", True), ("gene_family", False)], start=20, length=30)
    return serve.page(table(spark, sf, "mx"), q).select(*MX)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return serve.counts(table(spark, sf, "mx"), TableQuery(columns={"gene_family": "x"}, ranges={"evidence_count": (3, None)}))


def _mx_int(spark: SparkSession, sf: str) -> DataFrame:
    """Interactions by document: the values packed in evidence_documents; what follows a blank in a quoted value is a
    remark on the document and no part of its id."""
    values = unpack(table(spark, sf, "mx"), {"evidence_documents": IDS}, ["mirna_family", "gene_family", "interaction"])
    return values.select("mirna_family", "gene_family", "interaction", F.regexp_extract("val", "^(\\S+)", 1).alias("doc_id"))


def interaction_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _mx_int(spark, sf).dropDuplicates()


def context_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "mx_annot").where("annotation = 'celllines' and concept like 'F%'").select("doc_id")
    return serve.by_context(table(spark, sf, "mx"), _mx_int(spark, sf), docs).select("row_id")


def facet_and(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot")
    return serve.facet_documents(a, [(("celllines",), None), (("GeneOntology", "ModelAnatomy", "ncit"), None), (("disease",), None)])


def relation_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return serve.relation(table(spark, sf, "mx"), interaction="MIR_GENE;DOWN").select(*MX)


def annotation_lookup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("lang = 'de'").select(F.col("article_id").alias("doc_id"))
    return serve.lookup(table(spark, sf, "mx_annot"), docs, ["celllines", "disease", "GeneOntology"]).select("row_id", "doc_id", "concept_id")


def wordcloud(spark: SparkSession, sf: str) -> DataFrame:
    return serve.word_cloud(table(spark, sf, "mx_annot"))


def wordcloud_by_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return serve.word_cloud(table(spark, sf, "mx_annot").where("annotation is not null"), ["annotation"], top=20)


def doc_context_top2(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "mx_annot").where("annotation is not null and concept_id is not null")
    top = timeline.top_contexts(timeline.context_counts(a))
    return top.select("doc_id", "annotation", "concept_id", "n", F.col("place").cast("long").alias("place"))


def doc_context_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Roll-up over a two-level hierarchy: a concept id without its last three digits is its parent."""
    a = table(spark, sf, "mx_annot").where("annotation = 'disease' and concept_id is not null")
    up = a.select(F.col("concept_id").alias("child")).distinct().withColumn("parent", F.regexp_replace("child", "[0-9]{3}$", ""))
    return timeline.context_counts(a, up)


def main_interaction_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.main_interaction(_mx_int(spark, sf))


def timeline_rows(spark: SparkSession, sf: str) -> DataFrame:
    t = timeline.timeline(
        table(spark, sf, "documents").select(F.col("article_id").alias("doc_id")), documents.earliest_date(table(spark, sf, "mx_dates")),
        documents.first_last_author(table(spark, sf, "mx_authors")), documents.journal_names(table(spark, sf, "mx_journals")),
    )
    return t.select("doc_id", "pub_date", "month", "authors", "journal")


def shortened_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "mx_annot").where("concept <> ''").select(timeline.shorten(F.col("concept"), 20, 12).alias("label")).distinct()


def ontology_context_docs(spark: SparkSession, sf: str) -> DataFrame:
    terms = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("node"))
    ctx = table(spark, sf, "part").where("p_partkey in (3, 5)").select(F.col("p_partkey").alias("node"))
    return ontology.context_documents(terms, ctx, part_tree(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        statistics, evidence_by_interaction, consensus_flag, top_genes, concept_counts, doc_annotations, vocabulary_exclusion, vocabulary_exclusion_by_source,
        organism_sets, relevant_docs_semi, fulltext_dedupe_anti, annotated_interactions, first_last_author, valid_dates, pubdate_normalise, journal_names, doc_chunks,
        table_search_anchor, table_filter_page, table_counts, interaction_documents, context_search, facet_and, relation_lookup, annotation_lookup, wordcloud,
        wordcloud_by_vocabulary, doc_context_top2, doc_context_rollup, main_interaction_per_doc, timeline_rows, shortened_names, ontology_context_docs,
    )
}

# a value is a quoted text, a doubled mark inside standing for one, or a run without blanks and separating marks; its id is its first word
_INT = r"""
packed AS (SELECT mirna_family, gene_family, interaction, unnest(regexp_extract_all(evidence_documents, '"(?:[^"]|"")*"|''(?:[^'']|'''')*''|[^;,|/\s\[\]"'']+')) AS v FROM mx),
mx_int AS (SELECT mirna_family, gene_family, interaction, string_split(trim(trim(v, '"'''), ' '), ' ')[1] AS doc_id FROM packed WHERE trim(v, '"'' ') <> '')"""

_AUTH = """
named AS (SELECT doc_id, author_ord, row_id, trim(concat_ws(' ', firstname, lastname)) AS name FROM mx_authors),
auth AS (SELECT doc_id, arg_min(name, (author_ord, row_id)) AS first_author, arg_max(name, (author_ord, -row_id)) AS last_author FROM named WHERE name <> '' GROUP BY doc_id)"""
_DATE = """
dat AS (SELECT doc_id, min(pub_date) AS pub_date FROM mx_dates
        WHERE regexp_matches(pub_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND pub_date NOT LIKE '0000%' AND pub_date <> '0001-01-01' AND try_cast(pub_date AS DATE) IS NOT NULL GROUP BY doc_id)"""
_JOUR = "jour AS (SELECT doc_id, min(trim(journal)) AS journal FROM mx_journals WHERE trim(journal) <> '' GROUP BY doc_id)"
_MXCOLS = "row_id, mirna_family, gene_family, interaction, evidence_count"
_CLOUD = "c AS (SELECT {k} concept, count(*) AS n FROM mx_annot WHERE concept <> '' {w} GROUP BY ALL)"

ORACLE = {
    "statistics": """
SELECT count(DISTINCT mirna_family) AS mirnas, count(DISTINCT gene_family) AS genes,
       count(DISTINCT CASE WHEN mirna_family IS NOT NULL AND gene_family IS NOT NULL THEN (mirna_family, gene_family) END) AS pairs,
       count(DISTINCT CASE WHEN mirna_family IS NOT NULL AND gene_family IS NOT NULL AND is_consensus = 1 THEN (mirna_family, gene_family) END) AS consensus_pairs FROM mx""",
    "evidence_by_interaction": "SELECT interaction, count(*) AS n FROM mx WHERE is_consensus = 1 GROUP BY 1",
    "consensus_flag": "SELECT row_id, CASE WHEN evidence_count = max(evidence_count) OVER (PARTITION BY mirna_family, gene_family) THEN 1 ELSE 0 END AS flag FROM mx",
    "top_genes": "SELECT gene_family, count(*) AS n FROM mx WHERE gene_family <> '' GROUP BY 1 ORDER BY n DESC, gene_family LIMIT 50",
    "concept_counts": "SELECT annotation, concept_id, concept, count(*) AS n FROM mx_annot WHERE concept IS NULL OR concept NOT IN ('Grade 2 Mogodru', 'likrisoation, stage 2') GROUP BY ALL",
    "doc_annotations": "SELECT doc_id, annotation, concept_id, concept, coalesce(string_agg(DISTINCT sent_evidences, '#' ORDER BY sent_evidences), '') AS evidences, count(DISTINCT sent_evidences) AS n FROM mx_annot GROUP BY ALL",
    "vocabulary_exclusion": """
SELECT row_id, annotation, concept FROM mx_annot a WHERE annotation IS DISTINCT FROM 'ncit'
   OR NOT EXISTS (SELECT 1 FROM mx_annot b WHERE b.annotation <> 'ncit' AND b.concept <> '' AND upper(replace(b.concept, 'ß', 'ẞ')) = upper(replace(a.concept, 'ß', 'ẞ')))""",
    "vocabulary_exclusion_by_source": """
WITH s AS (SELECT *, CASE WHEN doc_id LIKE 'PMC%' THEN 'PMC' WHEN doc_id IS NOT NULL THEN 'PUBMED' END AS source FROM mx_annot)
SELECT row_id, source, concept FROM s a WHERE annotation IS DISTINCT FROM 'ncit'
   OR NOT EXISTS (SELECT 1 FROM s b WHERE b.annotation <> 'ncit' AND b.concept <> '' AND b.source = a.source AND upper(replace(b.concept, 'ß', 'ẞ')) = upper(replace(a.concept, 'ß', 'ẞ')))""",
    "organism_sets": """
SELECT array_to_string(list_sort(list_distinct(list_filter(string_split(organisms, ';'), lambda x: x <> ''))), ';') AS organisms, count(*) AS n
FROM mx WHERE organisms IS NOT NULL GROUP BY 1""",
    "relevant_docs_semi": "SELECT row_id, doc_id, pub_date FROM mx_dates d WHERE EXISTS (SELECT 1 FROM mx_annot a WHERE a.doc_id = d.doc_id AND a.annotation = 'disease')",
    "fulltext_dedupe_anti": """
SELECT row_id, doc_id FROM mx_journals a WHERE doc_id NOT LIKE 'PMC%'
  AND NOT EXISTS (SELECT 1 FROM mx_journals f WHERE f.doc_id LIKE 'PMC%' AND regexp_replace(f.doc_id, '^PMC7', '9') = a.doc_id)""",
    "annotated_interactions": "SELECT d.doc_id AS text_id, a.doc_id, a.concept_id FROM documents d JOIN mx_annot a ON a.doc_id = d.article_id WHERE a.annotation = 'disease'",
    "first_last_author": f"WITH {_AUTH} SELECT * FROM auth",
    "valid_dates": f"WITH {_DATE} SELECT * FROM dat",
    "pubdate_normalise": """
SELECT row_id, lpad(y, 4, '0') || '-' || lpad(CAST(greatest(CAST(m AS INT), 1) AS VARCHAR), 2, '0') || '-' || lpad(CAST(greatest(CAST(d AS INT), 1) AS VARCHAR), 2, '0') AS pub_date
FROM (SELECT row_id, split_part(pub_date, '-', 1) AS y, split_part(pub_date, '-', 2) AS m, split_part(pub_date, '-', 3) AS d FROM mx_dates WHERE regexp_matches(pub_date, '^[0-9]+-[0-9]+-[0-9]+$'))""",
    "journal_names": f"WITH {_JOUR} SELECT * FROM jour",
    "doc_chunks": "SELECT row_id, (dense_rank() OVER (ORDER BY doc_id) - 1) // 50 AS chunk FROM mx_dates WHERE doc_id IS NOT NULL",
    "table_search_anchor": f"SELECT {_MXCOLS} FROM mx WHERE (mirna_family ILIKE 'mir-3%' OR gene_family ILIKE 'mir-3%') AND interaction ILIKE '%up'",
    "table_filter_page": f"SELECT {_MXCOLS} FROM mx WHERE evidence_count BETWEEN 2 AND 40 AND is_consensus = 1 ORDER BY evidence_count DESC NULLS LAST, gene_family NULLS LAST, row_id LIMIT 30 OFFSET 20",
    "table_counts": "SELECT count(*) AS total, count(*) FILTER (gene_family ILIKE '%x%' AND evidence_count >= 3) AS filtered FROM mx",
    "interaction_documents": f"WITH {_INT} SELECT DISTINCT * FROM mx_int",
    "context_search": f"""WITH {_INT} SELECT row_id FROM mx m WHERE EXISTS (
  SELECT 1 FROM mx_int i WHERE i.mirna_family = m.mirna_family AND i.gene_family = m.gene_family AND i.interaction = m.interaction
     AND i.doc_id IN (SELECT doc_id FROM mx_annot WHERE annotation = 'celllines' AND concept LIKE 'F%'))""",
    "facet_and": """
SELECT doc_id FROM mx_annot GROUP BY doc_id HAVING bool_or(annotation = 'celllines')
   AND bool_or(annotation IN ('GeneOntology', 'ModelAnatomy', 'ncit')) AND bool_or(annotation = 'disease')""",
    "relation_lookup": f"SELECT {_MXCOLS} FROM mx WHERE interaction = 'MIR_GENE;DOWN'",
    "annotation_lookup": "SELECT row_id, doc_id, concept_id FROM mx_annot WHERE annotation IN ('celllines', 'disease', 'GeneOntology') AND doc_id IN (SELECT article_id FROM documents WHERE lang = 'de')",
    "wordcloud": "WITH " + _CLOUD.format(k="", w="") + """
SELECT concept, n FROM c WHERE NOT ((SELECT count(*) FROM c) > 100 AND (SELECT max(n) FROM c) >= 2) OR n > 2 ORDER BY n DESC, concept LIMIT 250""",
    "wordcloud_by_vocabulary": "WITH " + _CLOUD.format(k="annotation,", w="AND annotation IS NOT NULL") + """
SELECT annotation, concept, n FROM (SELECT *, row_number() OVER (PARTITION BY annotation ORDER BY n DESC, concept) AS r FROM (
  SELECT *, count(*) OVER (PARTITION BY annotation) AS d, max(n) OVER (PARTITION BY annotation) AS m FROM c) WHERE NOT (d > 100 AND m >= 2) OR n > 2) WHERE r <= 20""",
    "doc_context_top2": """
SELECT doc_id, annotation, concept_id, n, place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, annotation ORDER BY n DESC, concept_id) AS place
  FROM (SELECT doc_id, annotation, concept_id, count(*) AS n FROM mx_annot WHERE annotation IS NOT NULL AND concept_id IS NOT NULL GROUP BY ALL)) WHERE place <= 2""",
    "doc_context_rollup": """
WITH own AS (SELECT doc_id, annotation, concept_id, count(*) AS n FROM mx_annot WHERE annotation = 'disease' AND concept_id IS NOT NULL GROUP BY ALL)
SELECT doc_id, annotation, concept_id, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM own UNION ALL SELECT doc_id, annotation, regexp_replace(concept_id, '[0-9]{3}$', ''), 2 FROM own) GROUP BY ALL""",
    "main_interaction_per_doc": f"""WITH {_INT} SELECT doc_id, interaction, n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, interaction) AS r
  FROM (SELECT doc_id, interaction, count(*) AS n FROM mx_int GROUP BY ALL)) WHERE r = 1""",
    "timeline_rows": f"""WITH {_AUTH}, {_DATE}, {_JOUR}
SELECT doc_id, pub_date, strftime(CAST(pub_date AS DATE), '%B %Y') AS month, coalesce(first_author || ' / ' || last_author, '-/-') AS authors, coalesce(journal, '-') AS journal
FROM (SELECT DISTINCT article_id AS doc_id FROM documents) JOIN dat USING (doc_id) LEFT JOIN auth USING (doc_id) LEFT JOIN jour USING (doc_id)""",
    "shortened_names": "SELECT DISTINCT CASE WHEN length(concept) > 20 THEN substr(concept, 1, 12) || ' ...' ELSE concept END AS label FROM mx_annot WHERE concept <> ''",
    "ontology_context_docs": f"""WITH RECURSIVE {ONTOLOGY_SQL},
c AS (SELECT p_partkey AS seed, p_partkey AS node FROM part WHERE p_partkey IN (3, 5) UNION ALL SELECT c.seed, e.child FROM c JOIN edge e ON e.parent = c.node)
SELECT l_orderkey AS doc_id FROM lineitem JOIN c ON l_partkey = node GROUP BY 1 HAVING count(DISTINCT seed) = 2""",
}
