"""Timelines of interactions and per-document context summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shorten(name: Column, longest: int = 30, keep: int = 17) -> Column:
    """Names of over ``longest`` characters are cut to ``keep`` and ' ...'."""
    return F.when(F.length(name) > longest, F.concat(F.substring(name, F.lit(1), F.lit(keep)), F.lit(" ..."))).otherwise(name)


def context_counts(annots: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """``(doc_id, annotation, concept_id, n)``: one per annotation row; every direct parent (child, parent, in the
    same vocabulary) of each distinct concept adds two."""
    own = annots.groupBy("doc_id", "annotation", "concept_id").agg(F.count("*").alias("n"))
    if parents is None:
        return own
    up = own.join(parents.select(F.col("child").alias("concept_id"), "parent"), "concept_id").select("doc_id", "annotation", F.col("parent").alias("concept_id"), F.lit(2).cast("long").alias("n"))
    return own.unionByName(up).groupBy("doc_id", "annotation", "concept_id").agg(F.sum("n").alias("n"))


def top_contexts(counts: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` most frequent concepts of every document and vocabulary, ties by id; the limit is applied
    before the exchange (rank-limited window)."""
    w = Window.partitionBy("doc_id", "annotation").orderBy(F.desc("n"), F.col("concept_id"))
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def main_interaction(mx_int: DataFrame) -> DataFrame:
    """``(doc_id, interaction, n)``: the most frequent interaction of every document, ties by name."""
    n = mx_int.groupBy("doc_id", "interaction").agg(F.count("*").alias("n"))
    best = n.groupBy("doc_id").agg(F.max_by(F.struct("interaction", "n"), F.struct(F.col("n"), _descending(F.col("interaction")))).alias("_b"))
    return best.select("doc_id", "_b.interaction", "_b.n")


def _descending(text: Column) -> Column:
    """A key whose order is the reverse of the text's, for bytes: complement of each byte, closed by FF."""
    return F.concat(F.unhex(F.translate(F.hex(text.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210")), F.unhex(F.lit("FF")))


def timeline(docs: DataFrame, dates: DataFrame, authors: DataFrame, journals: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``(doc_id, pub_date, month, authors, journal[, contexts])`` of documents with a date, in order of date.

    Authors and journal default to '-/-' and '-', contexts to an empty list. ``dates``, ``authors`` and
    ``journals`` have one row per document.
    """
    who = F.coalesce(F.concat_ws(" / ", "first_author", "last_author"), F.lit("-/-"))
    out = docs.select("doc_id").distinct().join(dates, "doc_id").join(authors, "doc_id", "left").join(journals, "doc_id", "left")
    out = out.select("doc_id", "pub_date", F.date_format(F.col("pub_date").cast("date"), "MMMM yyyy").alias("month"), F.when(F.col("first_author").isNull(), "-/-").otherwise(who).alias("authors"), F.coalesce("journal", F.lit("-")).alias("journal"))
    if contexts is not None:
        per = contexts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("annotation", "concept_id", "n"))).alias("contexts"))
        out = out.join(per, "doc_id", "left").withColumn("contexts", F.coalesce("contexts", F.array().cast(per.schema["contexts"].dataType)))
    return out.orderBy("pub_date", "doc_id")
