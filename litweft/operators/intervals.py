"""Interval operators: islands of overlapping spans, range joins, overlap predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", closed: bool = False) -> DataFrame:
    """Adds ``island``: the number of the group of overlapping spans within ``keys``, from 0.

    Spans are half-open, so touching spans are apart; ``closed`` joins them. Rows without a start or
    end have no island (null). One exchange on ``keys`` and one sort serve both running windows.
    """
    before = Window.partitionBy(*keys).orderBy(F.col(start), F.col(end)).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(F.col(start), F.col(end)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.max(end).over(before)
    opens = seen.isNull() | (F.col(start) > seen if closed else F.col(start) >= seen)
    df = df.withColumn("_new", F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), opens.cast("int")))
    return df.withColumn("island", F.when(F.col("_new").isNotNull(), F.sum("_new").over(upto) - 1)).drop("_new")


def merge_spans(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", closed: bool = False) -> DataFrame:
    """``(*keys, start, end, n)``: overlapping spans merged."""
    return islands(df.where(F.col(start).isNotNull() & F.col(end).isNotNull()), keys, start, end, closed).groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("island")


def dedupe_overlaps(df: DataFrame, keys: Sequence[str], order: str, start: str = "start", end: str = "end", organism: str | None = None) -> DataFrame:
    """One row per group of overlapping spans: the first by ``order``, with the organisms of the group united.

    Groups of one row pass unchanged. ``organism`` may hold several values joined by ';'.
    """
    placed = islands(df, keys, start, end)
    rest = [c for c in df.columns if c not in keys and c != organism]
    aggs = [F.min_by(F.struct(*rest), F.col(order)).alias("_r")]
    if organism:
        aggs.append(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split(organism, ";"))))), ";").alias(organism))
    out = placed.groupBy(*keys, "island").agg(*aggs)
    return out.select(*keys, "_r.*", *([organism] if organism else []))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column, closed: bool = False) -> Column:
    """Do two spans share a position? ``closed`` counts touching ends as shared."""
    return (a_start <= b_end) & (b_start <= a_end) if closed else (a_start < b_end) & (b_start < a_end)


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], width: int, start: str = "start", end: str = "end") -> DataFrame:
    """Pairs of rows of ``a`` and ``b`` with equal ``keys`` whose half-open spans overlap.

    Other columns get the suffixes _a and _b. Spans are cut into bins of ``width``: the join is an equi
    join on (keys, bin), so that long groups do not meet all against all; a pair is kept in the bin
    where its common part begins, hence once. Spans with start >= end match nothing.
    """
    side = lambda df, s: df.where(F.col(start) < F.col(end)).select(*keys, *(F.col(c).alias(f"{c}_{s}") for c in df.columns if c not in keys)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(f"{start}_{s}") / width), F.floor((F.col(f"{end}_{s}") - 1) / width))))
    joined = side(a, "a").join(side(b, "b"), [*keys, "_bin"])
    hit = overlap(F.col(f"{start}_a"), F.col(f"{end}_a"), F.col(f"{start}_b"), F.col(f"{end}_b"))
    return joined.where(hit & (F.col("_bin") == F.floor(F.greatest(f"{start}_a", f"{start}_b") / width))).drop("_bin")


def exon_union(exons: DataFrame, gene: str = "gene_id", start: str = "start", end: str = "end", strand: str = "strand") -> DataFrame:
    """``(gene, strand, pos, start, end)``: the union of a gene's exons (inclusive ends), numbered in reading order."""
    half = exons.withColumn("_end", F.col(end) + 1)
    u = merge_spans(half, [gene, strand], start, "_end", closed=True)
    reading = Window.partitionBy(gene, strand).orderBy(F.when(F.col(strand) == "-", -F.col(start)).otherwise(F.col(start)))
    return u.select(gene, strand, (F.row_number().over(reading) - 1).cast("long").alias("pos"), start, (F.col("_end") - 1).alias(end))
