"""Queries of the windowed extension, run in batch over the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.session import table
from litweft.streaming.incremental import session_counts, windowed_counts


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = windowed_counts(table(spark, sf, "events"), "ts", "event_type")
    return w.select(F.unix_seconds("start").alias("start"), "event_type", "n")


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    s = session_counts(table(spark, sf, "events"), "ts", "user_id", gap="3 hours")
    return s.select("user_id", F.unix_micros("start").alias("start"), "n")


QUERIES = {f.__name__: f for f in (stream_windows, stream_sessions)}

ORACLE = {
    "stream_windows": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_sessions": """
WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 3 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM o)
SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, i""",
}
