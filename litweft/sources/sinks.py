"""Sinks: Parquet tables, side files, dumps, synonym files, track JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table; sorted files make min/max statistics work as an index for point lookups."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def serving_tables(tables: dict[str, DataFrame], root: str, keys: dict[str, Sequence[str]]) -> None:
    """Serving tables, each range-partitioned and sorted by its lookup key (the role of secondary indexes)."""
    for name, df in tables.items():
        k = list(keys.get(name, ()))
        (df.repartitionByRange(*k).sortWithinPartitions(*k) if k else df).write.mode("overwrite").parquet(f"{root}/{name}")


def tsv(df: DataFrame, path: str, header: bool = False) -> None:
    """Tab-separated files, one per task; nested columns must be flattened before."""
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option("emptyValue", "").csv(path)


def single_file(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One delimited file with a header (the download dump). One task writes it: for results of a page's size."""
    df.coalesce(1).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def lines(df: DataFrame, path: str) -> None:
    """Lines of tab-separated columns, without quoting, as the side files are; a null is '', and tabs and line ends inside
    a value become a blank."""
    cells = [F.coalesce(F.regexp_replace(df[c].cast("string"), "[\\t\\r\\n]+", " "), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *cells).alias("value")).write.mode("overwrite").text(path)


def side_files(docs: DataFrame, sentences: DataFrame, root: str) -> None:
    """Sentence, title, author, journal, citation, date, type and, where ``docs`` has ``pmid``, id map files of parsed articles.

    Their columns are those of ``tables.SIDE_FILES``, so ``tables.side_file`` reads them back. A missing month or day is 0.
    """
    has = set(docs.columns)
    lines(sentences.select("sent_id", "text"), f"{root}/sent")
    lines(docs.where("title is not null").select("doc_id", "title"), f"{root}/title")
    # one task per article writes its authors in order
    person = docs.select("doc_id", F.explode("authors").alias("a"))
    initials = F.col("a.initials") if "initials" in docs.select(F.explode("authors").alias("a")).select("a.*").columns else F.lit("")
    lines(person.select("doc_id", "a.firstname", initials.alias("initials"), "a.lastname"), f"{root}/author")
    iso = F.col("journal_iso") if "journal_iso" in has else F.lit("")
    lines(docs.where("journal is not null").select("doc_id", "journal", iso.alias("journal_iso")), f"{root}/journal")
    lines(docs.select("doc_id", F.explode("citations").alias("cited_id")), f"{root}/citation")
    part = F.split("pub_date", "-")
    number = lambda i: F.coalesce(F.get(part, F.lit(i)).try_cast("int"), F.lit(0))
    lines(docs.where("pub_date is not null").select("doc_id", number(0).alias("year"), number(1).alias("month"), number(2).alias("day")), f"{root}/date")
    if "pub_types" in has:
        lines(docs.select("doc_id", F.explode("pub_types").alias("pub_type")), f"{root}/pubtype")
    if "pmid" in has:
        lines(docs.where("pmid is not null").select("doc_id", "pmid"), f"{root}/pmid")


def synonym_file(df: DataFrame, path: str) -> None:
    """Lines 'id:syn|syn' of (term_id, syns)."""
    from litweft.functions.synonyms import line

    df.select(line(F.col("term_id"), F.col("syns")).alias("value")).write.mode("overwrite").text(path)


def by_namespace(df: DataFrame, path: str) -> None:
    """Synonym lines in one folder per namespace; a term in several namespaces is in each."""
    from litweft.functions.synonyms import line

    df.select(F.explode("namespaces").alias("namespace"), line(F.col("term_id"), F.col("syns")).alias("value")).write.mode("overwrite").partitionBy("namespace").text(path)


def accepted(relations: DataFrame, path: str) -> None:
    """Accepted relations only."""
    relations.where("accepted").write.mode("overwrite").parquet(path)


def json_tracks(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
