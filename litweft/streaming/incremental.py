"""Incremental forms (an extension: the batch pipeline re-reads update files by hand)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``(start, key, n)`` per tumbling window; rows later than ``late`` are dropped by the watermark. Works on
    batch frames too."""
    t = stream.withColumn("_t", F.col(time).cast("timestamp"))
    g = t.withWatermark("_t", late) if stream.isStreaming else t
    return g.groupBy(F.window("_t", window).alias("_w"), key).agg(F.count("*").alias("n")).select(F.col("_w.start").alias("start"), key, "n")


def session_counts(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """``(key, start, end, n)`` per session of a key: runs of rows closer than ``gap``."""
    t = stream.withColumn("_t", F.col(time).cast("timestamp"))
    g = t.withWatermark("_t", late) if stream.isStreaming else t
    return g.groupBy(F.session_window("_t", gap).alias("_w"), key).agg(F.count("*").alias("n")).select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n")


def new_files(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """A stream over the Parquet files that arrive under ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def upsert_each(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands every batch of changed rows to ``merge(rows, batch id)``, once per batch id after a restart."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
