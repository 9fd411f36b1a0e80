"""Sources and sinks, written and read again: what comes back is compared with the tables it was made of."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.operators import matcher, ontology
from litweft.plans.project import ONTOLOGY_SQL, SENTENCES_SQL, SPANS_SQL, sentences, spans
from litweft.plans.project import ontology as tree
from litweft.plans.text import _EXACT, lexicon
from litweft.session import spread, table, temporary_root
from litweft.sources import obo, pubmed, sinks, tables


def _folder(spark: SparkSession) -> str:
    return f"{temporary_root(spark)}/round-{uuid.uuid4().hex}"


def _written(df: DataFrame, line: Column) -> str:
    """Text files of one line per row."""
    path = _folder(df.sparkSession)
    df.select(line.alias("value")).write.text(path)
    return path


def _xml(c: Column | str) -> Column:
    text = F.col(c) if isinstance(c, str) else c
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


_PLAIN = "[^A-Za-z0-9 ]+"


def side_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentence files: the side file sink and the sentence scan."""
    root = _folder(spark)
    sinks.lines(sentences(spark, sf).select("sent_id", "text"), f"{root}/sent")
    return tables.sentences(spark, f"{root}/sent").select("sent_id", "doc_id", F.col("par_id").cast("long").alias("par_id"), F.col("sen_id").cast("long").alias("sen_id"), F.length("text").cast("long").alias("n_chars"))


def side_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Date files, zeros and placeholders included."""
    root = _folder(spark)
    d = table(spark, sf, "mx_dates").where("doc_id <> '' and pub_date rlike '^[0-9]+-[0-9]+-[0-9]+$'")
    p = F.split("pub_date", "-")
    sinks.lines(d.select("doc_id", *(p[i].cast("int") for i in range(3))), f"{root}/date")
    return tables.side_file(spark, f"{root}/date", "date")


def side_authors(spark: SparkSession, sf: str) -> DataFrame:
    """Author files, of the documents that have a journal (semi-join)."""
    root = _folder(spark)
    a = table(spark, sf, "mx_authors").where("doc_id <> ''")
    sinks.lines(a.select("doc_id", "firstname", F.substring("firstname", 1, 1).alias("initials"), "lastname"), f"{root}/author")
    docs = table(spark, sf, "mx_journals").where("journal is not null").select("doc_id").distinct()
    return tables.side_file(spark, f"{root}/author", "author", docs).select("doc_id", "firstname", "initials", "lastname")


def side_journals(spark: SparkSession, sf: str) -> DataFrame:
    root = _folder(spark)
    sinks.lines(table(spark, sf, "mx_journals").where("doc_id <> '' and journal is not null").select("doc_id", "journal"), f"{root}/journal")
    return tables.side_file(spark, f"{root}/journal", "journal").select("doc_id", "journal")


def hit_files(spark: SparkSession, sf: str) -> DataFrame:
    """Hit files of the exact hits."""
    h = matcher.match(sentences(spark, sf), lexicon(spark), only_longest=False).where("exact")
    root = _folder(spark)
    sinks.lines(h.select("sent_id", F.concat_ws(":", "dict_id", "syn_idx"), "matched", "start", (F.col("end") - F.col("start")).alias("n"), "syn", F.initcap(F.col("exact").cast("string")), "prefix", "suffix", "variant"), root)
    return tables.hits(spark, root).where("exact").select("sent_id", "dict_id", "syn", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


def context_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence lists written as literals and parsed again, one row per evidence."""
    a = spread(table(spark, sf, "mx_annot").select("row_id", "sent_evidences")).where("sent_evidences <> ''")
    one = F.transform(F.split("sent_evidences", "\\|"), lambda e: F.concat(F.lit("('"), F.split(e, ",")[0], F.lit("', "), F.split(e, ",")[1], F.lit(", "), F.split(e, ",")[2], F.lit(", \"it's\")")))
    lit = a.select("row_id", F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]")).alias("ev"))
    read = tables.literal_column(lit, "ev", "array<struct<sent:string,start:int,end:int,syn:string>>")
    return read.select("row_id", F.explode("ev").alias("e")).select("row_id", "e.sent", "e.start", "e.end", "e.syn")


def pubmed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Article XML of the documents, scanned and taken apart."""
    plain = F.trim(F.regexp_replace("text", _PLAIN, " "))
    d = spread(table(spark, sf, "documents")).select("doc_id", plain.alias("t"), F.coalesce("journal", F.lit("")).alias("j"), F.coalesce("source", F.lit("nobody")).alias("s"), F.to_date("loaded_at").alias("day")).where("t <> ''")
    tag = lambda n, c, a="": F.concat(F.lit(f"<{n}{a}>"), c, F.lit(f"</{n}>"))
    when = F.concat(tag("Year", F.year("day").cast("string")), tag("Month", F.month("day").cast("string")), tag("Day", F.day("day").cast("string")))
    art = F.concat(
        tag("Journal", tag("Title", _xml("j"))), tag("ArticleTitle", F.concat(F.lit("["), F.left("t", F.lit(40)), F.lit("].")), ""), tag("Abstract", F.concat(tag("AbstractText", F.lit("old"), " Label='MAIN'"), tag("AbstractText", F.col("t"), " Label='main'"))),
        tag("AuthorList", F.concat(tag("Author", tag("LastName", _xml("s")), " ValidYN='Y'"), tag("Author", tag("LastName", F.lit("Wrong")), " ValidYN='N'"))), tag("ArticleDate", when),
    )
    path = _written(d, tag("PubmedArticle", tag("MedlineCitation", F.concat(tag("PMID", F.col("doc_id").cast("string")), tag("Article", art)))))
    f = pubmed.fields(pubmed.articles(spark, path))
    last = F.element_at("abstract", -1)
    return f.select("doc_id", F.trim("title").alias("title"), "journal", "pub_date", last["label"].alias("label"), last["text"].alias("abstract"), F.get("authors", F.lit(0))["lastname"].alias("author"), F.size("authors").cast("long").alias("authors"))


def obo_edges(spark: SparkSession, sf: str) -> DataFrame:
    """An ontology written as OBO terms with parents, scanned for its edges."""
    part = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").cast("string").alias("term_id"), F.col("p_name").alias("name"))
    edges = tree(spark, sf).select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent"))
    path = _written(obo.text(part, ontology.parents(edges)), F.col("value"))
    return obo.edges(obo.blocks(spark, path))


def obo_terms(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").where("p_partkey > 0").select(F.col("p_partkey").cast("string").alias("term_id"), F.col("p_name").alias("name"))
    none = spark.createDataFrame([], "child string, parents array<string>")
    return obo.terms(obo.blocks(spark, _written(obo.text(part, none), F.col("value")))).select("term_id", "name", "is_obsolete")


def synonym_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Synonym files: ids whose colon becomes '_', and their words."""
    path = _folder(spark)
    df = table(spark, sf, "part").select(F.concat(F.lit("P:"), "p_partkey").alias("term_id"), F.array("p_name", "p_type").alias("syns"))
    sinks.synonym_file(df.coalesce(1), path)
    return tables.synonym_file(spark, path).select("syn_id", "syn")


def exclude_words(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(table(spark, sf, "nation"), F.concat(F.lit(" "), F.initcap("n_name")))
    return tables.exclude_lists(spark, {"common": path, "manual": path})


def gtf_lines(spark: SparkSession, sf: str) -> DataFrame:
    s = spans(spark, sf)
    line = F.concat_ws("\t", F.lit("chr1"), F.lit("made"), F.lit("exon"), "start", "end", F.lit("."), F.when(F.col("grp") % 2 == 0, "+").otherwise("-"), F.lit("."), F.concat(F.lit('gene_id "G'), "grp", F.lit('"; gene_type "'), "label", F.lit('";')))
    return tables.gtf(spark, _written(s, line)).select("feature", "start", "end", "strand", "gene_id", "gene_type")


def bed_lines(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    line = F.concat_ws("\t", F.lit("chr2"), "p_partkey", F.col("p_partkey") + F.col("p_size"), F.concat_ws(":", "p_name", "p_brand"), "p_size", F.lit("+"), "p_partkey", F.col("p_partkey") + 1, F.lit("0"), F.lit("1"), F.lit("1"), F.lit("0"))
    return tables.bed(spark, _written(p, line)).select("start", "end", "gene_mir", F.col("score").cast("long").alias("score"), "strand")


def fasta_records(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return tables.fasta(spark, _written(p, F.concat(F.lit(">P"), "p_partkey", F.lit(" remark\n"), F.upper("p_type"), F.lit("\n"), F.lower("p_type"))))


def family_lines(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_brand", (F.col("p_size") % 3 + 9605).alias("sp"), "p_name")
    path = _folder(spark)
    p.select(F.col("p_brand").alias("miR family"), F.col("sp").alias("Species ID"), F.col("p_name").alias("MiRBase ID")).write.option("sep", "\t").option("header", True).csv(path)
    return tables.mirna_families(spark, path, 9606)


def corpus_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs of an evaluation corpus in XML."""
    p = table(spark, sf, "part")
    ent = lambda i, t, kind, at: F.concat(F.lit(f"<entity id='{i}' text='"), t, F.lit(f"' type='{kind}' charOffset='"), at.cast("string"), F.lit("-"), (at + F.length(t) - 1).cast("string"), F.lit("'/>"))
    at = F.length("p_brand") + 6
    sent = F.concat(F.lit("<sentence id='s' text='"), "p_brand", F.lit(" hits "), "p_type", F.lit("'>"), ent("e1", F.col("p_brand"), "m", F.lit(0)), ent("e2", F.col("p_type"), "g", at), F.lit("<pair id='p' e1='e1' e2='e2' interaction='"), F.when(F.col("p_size") > 25, "True").otherwise("False"), F.lit("'/></sentence>"))
    doc = F.concat(F.lit("<document origId='"), "p_partkey", F.lit("'>"), sent, F.lit("</document>"))
    # a file is one corpus of some thousand documents
    corpus = p.groupBy(F.floor(F.col("p_partkey") / 1000).alias("part")).agg(F.concat(F.lit("<corpus>"), F.array_join(F.collect_list(doc), ""), F.lit("</corpus>")).alias("value"))
    path = _folder(spark)
    corpus.write.partitionBy("part").text(path)
    c = tables.corpus_pairs(spark, path)
    return c.select("doc_id", "interaction", "e1", "e2", *(F.col(f"loc{i}.{b}").cast("long").alias(f"{b}{i}") for i in (1, 2) for b in ("start", "end")))


QUERIES = {
    f.__name__: f
    for f in (
        side_sentences, side_dates, side_authors, side_journals, hit_files, context_literals, pubmed_files, obo_edges, obo_terms, synonym_lines, exclude_words, gtf_lines, bed_lines, fasta_records, family_lines, corpus_xml,
    )
}

_EV = "SELECT row_id, unnest(string_split(sent_evidences, '|')) AS e FROM mx_annot WHERE sent_evidences <> ''"
ORACLE = {
    "side_sentences": f"""WITH {SENTENCES_SQL}, w AS (SELECT sent_id, doc_id, sen_id, regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g') AS t FROM sent)
SELECT sent_id, CAST(doc_id AS VARCHAR) AS doc_id, CAST(2 AS BIGINT) AS par_id, sen_id, length(t) AS n_chars FROM w""",
    "side_dates": """SELECT doc_id, CAST(split_part(pub_date, '-', 1) AS INTEGER) AS "year", CAST(split_part(pub_date, '-', 2) AS INTEGER) AS "month", CAST(split_part(pub_date, '-', 3) AS INTEGER) AS "day"
FROM mx_dates WHERE doc_id <> '' AND regexp_matches(pub_date, '^[0-9]+-[0-9]+-[0-9]+$')""",
    "side_authors": """SELECT doc_id, coalesce(firstname, '') AS firstname, coalesce(substr(firstname, 1, 1), '') AS initials, coalesce(lastname, '') AS lastname FROM mx_authors
WHERE doc_id <> '' AND doc_id IN (SELECT doc_id FROM mx_journals WHERE journal IS NOT NULL)""",
    "side_journals": "SELECT doc_id, journal FROM mx_journals WHERE doc_id <> '' AND journal IS NOT NULL",
    "hit_files": _EXACT + 'SELECT DISTINCT sent_id, dict_id, syn, start, "end" FROM hit',
    "context_literals": f"""SELECT row_id, split_part(e, ',', 1) AS sent, CAST(split_part(e, ',', 2) AS INTEGER) AS start, CAST(split_part(e, ',', 3) AS INTEGER) AS "end", 'it''s' AS syn FROM ({_EV})""",
    "pubmed_files": f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, trim(substr(t, 1, 40)) AS title, trim(j) AS journal, strftime(loaded_at, '%Y-%m-%d') AS pub_date, 'MAIN' AS label, t AS abstract, s AS author, CAST(1 AS BIGINT) AS authors
FROM (SELECT doc_id, trim(regexp_replace(text, '{_PLAIN}', ' ', 'g'), ' ') AS t, coalesce(journal, '') AS j, coalesce(source, 'nobody') AS s, loaded_at FROM documents) WHERE t <> ''""",
    "obo_edges": f"WITH {ONTOLOGY_SQL} SELECT CAST(child AS VARCHAR) AS child, CAST(parent AS VARCHAR) AS parent, 'is_a' AS rel FROM edge",
    "obo_terms": "SELECT CAST(p_partkey AS VARCHAR) AS term_id, p_name AS name, false AS is_obsolete FROM part WHERE p_partkey > 0",
    "synonym_lines": """SELECT 'P_' || p_partkey AS syn_id, unnest(list_distinct(['P_' || p_partkey, p_name, p_type])) AS syn FROM part""",
    "exclude_words": """WITH v AS (SELECT array_to_string(list_transform(string_split(n_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS word FROM nation)
SELECT 'manual' AS category, word FROM v UNION SELECT 'common', word FROM v UNION SELECT 'common', upper(word) FROM v""",
    "gtf_lines": f"""WITH {SPANS_SQL} SELECT 'exon' AS feature, start, "end", CASE WHEN grp % 2 = 0 THEN '+' ELSE '-' END AS strand, 'G' || grp AS gene_id, label AS gene_type FROM sp""",
    "bed_lines": """SELECT p_partkey AS start, p_partkey + p_size AS "end", p_name || ':' || p_brand AS gene_mir, CAST(p_size AS BIGINT) AS score, '+' AS strand FROM part""",
    "fasta_records": "SELECT 'P' || p_partkey AS name, upper(p_type) || lower(p_type) AS sequence FROM part",
    "family_lines": "SELECT DISTINCT p_brand AS family, p_name AS mirna FROM part WHERE p_size % 3 + 9605 = 9606",
    "corpus_xml": """SELECT CAST(p_partkey AS VARCHAR) AS doc_id, p_size > 25 AS interaction, p_brand AS e1, p_type AS e2, CAST(0 AS BIGINT) AS start1, length(p_brand) AS end1, length(p_brand) + 6 AS start2,
  length(p_brand) + 6 + length(p_type) AS end2 FROM part""",
}
