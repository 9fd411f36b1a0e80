"""Projections of the driver's tables onto the shapes that the operators read, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.session import spread, table


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """One row per piece of evidence: who, what, where, in which organism and document."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    place = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = li.join(part, F.col("l_partkey") == F.col("p_partkey")).join(place.select("s_suppkey", "n_name", "r_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(
        F.col("p_brand").alias("mirna_family"), F.col("n_name").alias("gene_family"), F.col("l_returnflag").alias("direction"), F.col("l_linestatus").alias("regulation"),
        F.col("r_name").alias("organism"), F.col("l_orderkey").cast("string").alias("doc_id"), F.concat_ws(".", F.col("l_orderkey"), F.lit("2"), F.col("l_linenumber")).alias("sent_id"),
    )


EVIDENCE_SQL = """
ev AS (
  SELECT p_brand AS mirna_family, n_name AS gene_family, l_returnflag AS direction, l_linestatus AS regulation, r_name AS organism,
         CAST(l_orderkey AS VARCHAR) AS doc_id, l_orderkey || '.2.' || l_linenumber AS sent_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def spans(spark: SparkSession, sf: str) -> DataFrame:
    """Half-open intervals (grp, start, end, label, ord) from the events table."""
    ev = table(spark, sf, "events")
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select(F.col("user_id").alias("grp"), start.alias("start"), (start + F.floor("value").cast("long") * 60).alias("end"), F.col("event_type").alias("label"), F.col("event_id").alias("ord"))


SPANS_SQL = """
sp AS (SELECT user_id AS grp, CAST(floor(epoch(ts)) AS BIGINT) AS start, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) * 60 AS "end", event_type AS label, event_id AS ord FROM events)"""


def ontology(spark: SparkSession, sf: str) -> DataFrame:
    """Edges (child, parent) of a tree over the parts: the parent of p is p / 2, part 1 is the root."""
    p = table(spark, sf, "part").select("p_partkey").where("p_partkey > 1")
    return p.select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).cast("long").alias("parent"))


ONTOLOGY_SQL = "edge AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey > 1)"


ENDS = "[.!?][ \\t\\r\\n]+"


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences (doc_id, sen_id, sent_id, text): the non-empty parts of every text between '.', '!' or '?' and the white
    space after it. A rule that both engines know; ``sources.pubmed.sentences`` also minds abbreviations."""
    d = spread(table(spark, sf, "documents").select("doc_id", "text")).where("text is not null")
    parts = d.select("doc_id", F.posexplode(F.split("text", ENDS)).alias("sen_id", "text")).where("length(text) > 0")
    return parts.select("doc_id", F.col("sen_id").cast("long").alias("sen_id"), F.concat_ws(".", "doc_id", F.lit("2"), "sen_id").alias("sent_id"), "text")


SENTENCES_SQL = f"""
parts AS (SELECT doc_id, regexp_split_to_array(text, '{ENDS}') AS xs FROM documents WHERE text IS NOT NULL),
sent AS (SELECT doc_id, i - 1 AS sen_id, doc_id || '.2.' || (i - 1) AS sent_id, xs[i] AS text
         FROM (SELECT doc_id, xs, unnest(generate_series(1, len(xs))) AS i FROM parts) WHERE length(xs[i]) > 0)"""
