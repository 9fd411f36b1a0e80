"""Frequency of every distinct value: occurrences, records, and a mark for too rare or too common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def record_key(*columns: str) -> Column:
    """One string per distinct value of ``columns``, null and '' told apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("~")) for c in columns]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def term_rows(df: DataFrame, record: Column, fields: Sequence[str]) -> DataFrame:
    """``(field_name, val, record)`` of every non-empty value of ``fields``."""
    cells = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("val")) for f in fields))
    return df.select(record.alias("record"), F.explode(cells).alias("_e")).select("_e.field_name", "_e.val", "record").where("val is not null and val <> ''")


def term_counts(rows: DataFrame, salts: int = 64) -> DataFrame:
    """``(field_name, val, occurrences, records)`` of ``term_rows``.

    Last-seen counters: tokens are hash-partitioned by (field, term, salt of the record), ordered by
    record, and each term keeps its occurrences, its records and the last record identifier; a token
    raises the records only if its record is not the last one seen. No set of records is kept. The salt
    spreads a term with a third of all rows over ``salts`` counters whose records are disjoint, so they
    add up. Counters run in the JVM as a window with a one-row memory over a spilling sort.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("record"), F.lit(salts)).cast("short"))
    seen = Window.partitionBy("field_name", "val", "_salt").orderBy("record")
    last = F.lag("record").over(seen)
    fresh = F.when(last.isNull() | (last != F.col("record")), 1).otherwise(0)
    return (
        salted.select("field_name", "val", "_salt", fresh.alias("_fresh"))
        .groupBy("field_name", "val", "_salt").agg(F.count("*").alias("_n"), F.sum("_fresh").alias("_r"))
        .groupBy("field_name", "val").agg(F.sum("_n").alias("occurrences"), F.sum("_r").alias("records"))
    )


def record_totals(rows: DataFrame) -> DataFrame:
    """``(field_name, n_records)``: records with at least one value, combined map-side."""
    return rows.select("field_name", "record").distinct().groupBy("field_name").agg(F.count("*").alias("n_records"))


def mark_terms(rows: DataFrame, rare_below: int = 3, common_over: int = 20) -> DataFrame:
    """``(field_name, val, occurrences, records, n_records, mark)`` of every value.

    ``mark`` is 'rare' in fewer than ``rare_below`` records, else 'common' in more than
    n_records / ``common_over`` of them, else null. Nulls and '' are no values; repeated rows add to
    the occurrences only; a field without any value gives no row.
    """
    totals = F.broadcast(record_totals(rows))  # one row per field
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") * common_over > F.col("n_records"), "common")
    return term_counts(rows).join(totals, "field_name").withColumn("mark", mark)
