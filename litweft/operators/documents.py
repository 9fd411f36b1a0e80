"""Document metadata: relevant documents, authors, dates, journals, chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litweft.session import materialise


def relevant(df: DataFrame, docs: DataFrame, on: str = "doc_id") -> DataFrame:
    """Rows of documents in ``docs`` (semi-join; nothing is collected)."""
    return df.join(docs.select(on), on, "left_semi")


def without_fulltext(abstracts: DataFrame, mapping: DataFrame, pmid: str = "doc_id", mapped: str = "pmid") -> DataFrame:
    """Abstract rows whose article has no full text in ``mapping`` (anti-join)."""
    return abstracts.join(mapping.select(F.col(mapped).alias(pmid)), pmid, "left_anti")


def source_of(doc: Column) -> Column:
    """'PMC' for full texts, 'PUBMED' for abstracts."""
    return F.when(doc.startswith("PMC"), "PMC").when(doc.isNotNull(), "PUBMED")


def first_last_author(authors: DataFrame, doc: str = "doc_id", order: str = "author_ord", row: str = "row_id") -> DataFrame:
    """``(doc, first_author, last_author)``: names at the smallest and largest position, ties by row.

    Names are 'first last' without outer blanks; authors without any name do not count.
    """
    name = F.trim(F.concat_ws(" ", F.col("firstname"), F.col("lastname")))
    named = authors.select(doc, order, row, name.alias("name")).where("name <> ''")
    return named.groupBy(doc).agg(
        F.min_by("name", F.struct(order, row)).alias("first_author"),
        F.max_by("name", F.struct(F.col(order), -F.col(row))).alias("last_author"),
    )


def normal_date(year: Column, month: Column, day: Column) -> Column:
    """'YYYY-MM-DD' as text; missing or zero months and days become 01, a missing year 0000."""
    part = lambda c, low: F.when(c.isNull() | (c < low), F.lit(low)).otherwise(c)
    return F.format_string("%04d-%02d-%02d", part(year, 0), part(month, 1), part(day, 1))


def month_number(text: Column) -> Column:
    """1..12 of a number or an English month name (three letters suffice), else null."""
    names = "jan feb mar apr may jun jul aug sep oct nov dec".split()
    lookup = F.create_map(*(x for i, m in enumerate(names) for x in (F.lit(m), F.lit(i + 1))))
    number = text.try_cast("int")
    return F.coalesce(F.when(number.between(1, 12), number), F.try_element_at(lookup, F.lower(F.substring(F.trim(text), 1, 3))))


def valid_dates(dates: DataFrame, date: str = "pub_date") -> DataFrame:
    """Rows with a real calendar day; year 0000, placeholders such as 0001-01-01, zero parts, null and '' go."""
    d = F.col(date)
    ok = d.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & ~d.startswith("0000") & (d != "0001-01-01") & d.try_cast("date").isNotNull()
    return dates.where(ok)


def earliest_date(dates: DataFrame, doc: str = "doc_id", date: str = "pub_date") -> DataFrame:
    """``(doc, pub_date)``: the earliest valid date of every document that has one."""
    return valid_dates(dates, date).groupBy(doc).agg(F.min(date).alias(date))


def journal_names(journals: DataFrame, doc: str = "doc_id", journal: str = "journal") -> DataFrame:
    """``(doc, journal)``: one journal a document, without outer blanks; the smallest by code point where several differ."""
    return journals.select(doc, F.trim(journal).alias(journal)).where(F.col(journal) != "").groupBy(doc).agg(F.min(journal).alias(journal))


def journal_or_iso(long_name: Column, iso: Column) -> Column:
    """The short name where there is one, else the long name, else ''."""
    return F.coalesce(F.nullif(F.trim(iso), F.lit("")), F.nullif(F.trim(long_name), F.lit("")), F.lit(""))


def chunks(docs: DataFrame, per_chunk: int, order: str = "doc_id") -> DataFrame:
    """Adds ``chunk``: documents in ``order`` in runs of at most ``per_chunk``.

    Every row of a document gets the document's chunk, so side tables follow by a join. The global rank
    is made without one big sort task: documents are range-partitioned by ``order``, ranked inside
    their partition, and shifted by the sizes of the partitions before.
    """
    ids = docs.select(order).where(F.col(order).isNotNull()).distinct()
    ranged = ids.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))  # one row per partition
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    numbered = ranged.withColumn("_r", rank).join(F.broadcast(offsets), "_part").select(order, F.floor((F.col("_r") + F.col("_before")) / per_chunk).cast("long").alias("chunk"))
    return docs.join(numbered, order)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (of some columns)."""
    return (df.select(*columns) if columns else df).dropDuplicates()
