"""PubMed XML: one row per article, fields by xpath and from_xml, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.operators.documents import journal_or_iso, month_number, normal_date

_CITATION = "PubmedArticle/MedlineCitation"
_ARTICLE = f"{_CITATION}/Article"
_NESTED = """
MedlineCitation struct<
  Article: struct<
    AuthorList: struct<Author: array<struct<_ValidYN: string, LastName: string, ForeName: string, Initials: string, CollectiveName: string>>>,
    Abstract: struct<AbstractText: array<struct<_Label: string, _VALUE: string>>>,
    PublicationTypeList: struct<PublicationType: array<string>>>,
  CommentsCorrectionsList: struct<CommentsCorrections: array<struct<_RefType: string, PMID: string>>>>
"""


def articles(spark: SparkSession, path: str, first_file: int | None = None, last_file: int | None = None) -> DataFrame:
    """``(file, xml)``: one row per PubmedArticle of the (compressed) XML files under ``path``.

    Files are cut at the closing tag while they are read, so a file never has to fit in memory. File
    numbers (the last digits of a name) can be limited.
    """
    raw = spark.read.option("lineSep", "</PubmedArticle>").text(path).withColumn("file", F.col("_metadata.file_name"))
    number = F.regexp_extract("file", "([0-9]+)\\.xml", 1).try_cast("int")
    if first_file is not None:
        raw = raw.where(number >= first_file)
    if last_file is not None:
        raw = raw.where(number <= last_file)
    body = F.regexp_extract("value", "(?s)(<PubmedArticle[ >].*)", 1)
    return raw.select("file", body.alias("xml")).where("xml <> ''").withColumn("xml", F.concat("xml", F.lit("</PubmedArticle>")))


def plain(xml: Column) -> Column:
    """XML without inline mark-up and line breaks, so that texts are single nodes."""
    return F.regexp_replace(F.regexp_replace(xml, "</?(?:i|b|u|sup|sub|italic|bold)>", ""), "[\\r\\n]+", " ")


def _text(path: str) -> Column:
    return F.nullif(F.trim(F.xpath_string("xml", F.lit(path))), F.lit(""))


def fields(arts: DataFrame) -> DataFrame:
    """Fields of every article with a PMID.

    ``(doc_id, title, journal, doi, pub_date, authors, abstract, pub_types, citations)``. A title in
    square brackets loses them; authors marked invalid are dropped, the order is kept; of abstract
    parts with one label the last counts, the default label is GENERAL; citations are references of
    type Cites. The date is the article's, else the journal's, else zeros; months may be names.
    """
    a = arts.select(plain(F.col("xml")).alias("xml"))
    n = F.from_xml("xml", _NESTED.replace("\n", " ").strip(), {"rowTag": "PubmedArticle"})
    a = a.select("xml", n.alias("n")).select("xml", "n.MedlineCitation.*")
    title = _text(f"{_ARTICLE}/ArticleTitle")
    date = lambda base: [_text(f"{_ARTICLE}/{base}/{p}") for p in ("Year", "Month", "Day")]
    own, print_ = date("ArticleDate"), date("Journal/JournalIssue/PubDate")
    y, m, d = (F.when(own[0].isNotNull(), o).otherwise(p) for o, p in zip(own, print_))
    authors = F.filter("Article.AuthorList.Author", lambda x: F.coalesce(x["_ValidYN"], F.lit("Y")) == "Y")
    authors = F.transform(authors, lambda x, i: F.struct((i + 1).alias("author_ord"), F.coalesce(x["ForeName"], F.lit("")).alias("firstname"), F.coalesce(x["Initials"], F.lit("")).alias("initials"), F.coalesce(x["LastName"], x["CollectiveName"], F.lit("")).alias("lastname")))
    parts = F.transform("Article.Abstract.AbstractText", lambda x: F.struct(F.upper(F.coalesce(x["_Label"], F.lit("GENERAL"))).alias("label"), F.trim(x["_VALUE"]).alias("text")))
    return a.select(
        _text(f"{_CITATION}/PMID").alias("doc_id"), F.regexp_replace(title, "^\\[(.*?)\\]\\.?$", "$1").alias("title"),
        journal_or_iso(_text(f"{_ARTICLE}/Journal/Title"), _text(f"{_ARTICLE}/Journal/ISOAbbreviation")).alias("journal"), _text(f"{_ARTICLE}/ELocationID[@EIdType='doi']").alias("doi"),
        normal_date(y.try_cast("int"), month_number(m), d.try_cast("int")).alias("pub_date"), authors.alias("authors"), last_by_label(parts).alias("abstract"),
        F.col("Article.PublicationTypeList.PublicationType").alias("pub_types"),
        F.transform(F.filter("CommentsCorrectionsList.CommentsCorrections", lambda x: x["_RefType"] == "Cites"), lambda x: x["PMID"]).alias("citations"),
    ).where("doc_id is not null")


def last_by_label(parts: Column) -> Column:
    """Of array<struct<label,text>>: one entry a label, in order of first appearance, with the label's last text."""
    labels = F.array_distinct(F.transform(parts, lambda x: x["label"]))
    return F.transform(labels, lambda n: F.struct(n.alias("label"), F.element_at(F.filter(parts, lambda x: x["label"] == n), -1)["text"].alias("text")))


def joined_by_label(parts: Column) -> Column:
    """As ``last_by_label``, with all texts of the label joined by a blank (the rule for full texts)."""
    labels = F.array_distinct(F.transform(parts, lambda x: x["label"]))
    return F.transform(labels, lambda n: F.struct(n.alias("label"), F.array_join(F.transform(F.filter(parts, lambda x: x["label"] == n), lambda x: x["text"]), " ").alias("text")))


# Words that end in a full stop inside a sentence.
ABBREVIATIONS = "vs e.g i.e cf ca al Fig Figs Tab Ref Refs No Nos Dr Prof St Mr Mrs sp spp subsp var approx resp incl etc Inc Ltd Co"
#: Sentence ends: '.', '!' or '?' before white space and a capital or digit, but not after an abbreviation or a single capital.
SENTENCE_END = f"(?<=[.!?])(?<!\\b(?:{'|'.join(w.replace('.', '[.]') for w in ABBREVIATIONS.split())})[.])(?<!\\b[A-Z][.])\\s+(?=[A-Z0-9])"


def sentences(docs: DataFrame, splitter: Column | None = None) -> DataFrame:
    """``(sent_id, doc_id, par_id, sen_id, text)``: paragraph 1 is the title, 2 the abstract, 3 the ``body`` if there is one.

    The default splitter cuts at SENTENCE_END; ``splitter`` is any expression that makes an array of ``text``.
    """
    body = F.array_join(F.transform("body", lambda x: x["text"]), " ") if "body" in docs.columns else F.lit(None).cast("string")
    pars = F.array(F.col("title"), F.array_join(F.transform("abstract", lambda x: x["text"]), " "), body)
    p = docs.select("doc_id", F.posexplode(pars).alias("par_id", "text")).where("text <> ''").withColumn("par_id", F.col("par_id") + 1)
    cut = splitter if splitter is not None else F.split("text", SENTENCE_END)
    s = p.select("doc_id", "par_id", F.posexplode(cut).alias("sen_id", "text")).withColumn("sen_id", F.col("sen_id") + 1)
    s = s.withColumn("text", F.trim("text")).where(F.length("text") > F.when(F.col("doc_id").startswith("PMC"), 5).otherwise(0))
    return s.select(F.concat_ws(".", "doc_id", "par_id", "sen_id").alias("sent_id"), "doc_id", "par_id", "sen_id", "text")
