"""OBO ontologies: term, edge and synonym tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per [Term] block, as a list of its 'key: value' lines; other stanzas and the header are left out."""
    raw = spark.read.option("lineSep", "\n[").text(path)
    term = raw.where(F.col("value").rlike("^\\[?Term\\]"))
    return term.select(F.filter(F.transform(F.split("value", "\r?\n"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit(": "))).alias("lines"))


def _all(key: str) -> Column:
    """Values of every line with ``key``, without trailing comments."""
    hit = F.filter("lines", lambda x: F.startswith(x, F.lit(f"{key}: ")))
    return F.transform(hit, lambda x: F.trim(F.regexp_replace(F.substring(x, F.lit(len(key) + 3), F.length(x)), " ! .*$", "")))


def _one(key: str) -> Column:
    return F.get(_all(key), F.lit(0))


def terms(b: DataFrame) -> DataFrame:
    """``(term_id, name, namespaces, def, is_obsolete, alt_ids, subsets, xrefs, comment, property_values)``."""
    quoted = F.regexp_extract(_one("def"), '^"((?:[^"\\\\]|\\\\.)*)"', 1)
    return b.select(
        _one("id").alias("term_id"), _one("name").alias("name"), _all("namespace").alias("namespaces"), quoted.alias("def"), F.coalesce(_one("is_obsolete") == "true", F.lit(False)).alias("is_obsolete"),
        _all("alt_id").alias("alt_ids"), _all("subset").alias("subsets"), _all("xref").alias("xrefs"), _one("comment").alias("comment"), _all("property_value").alias("property_values"),
    ).where("term_id is not null")


def edges(b: DataFrame) -> DataFrame:
    """``(child, parent, rel)``: is_a lines, and relationships; 'derived_from' counts as is_a."""
    isa = b.select(_one("id").alias("child"), F.explode(_all("is_a")).alias("v")).select("child", F.split("v", " ")[0].alias("parent"), F.lit("is_a").alias("rel"))
    rel = b.select(_one("id").alias("child"), F.explode(_all("relationship")).alias("v")).select("child", F.get(F.split("v", " "), F.lit(1)).alias("parent"), F.split("v", " ")[0].alias("rel"))
    return isa.unionByName(rel.withColumn("rel", F.when(F.col("rel") == "derived_from", "is_a").otherwise(F.col("rel")))).where("parent is not null").distinct()


def synonyms(b: DataFrame) -> DataFrame:
    """``(term_id, syn, scope)``: synonym lines and quoted property values whose name ends in 'synonym' (any case)."""
    s = b.select(_one("id").alias("term_id"), F.explode(_all("synonym")).alias("v"))
    s = s.select("term_id", F.regexp_replace(F.regexp_extract("v", '^"((?:[^"\\\\]|\\\\.)*)"', 1), '\\\\(.)', "$1").alias("syn"), F.nullif(F.regexp_extract("v", '" ([A-Z]+)', 1), F.lit("")).alias("scope"))
    p = b.select(_one("id").alias("term_id"), F.explode(_all("property_value")).alias("v")).where(F.col("v").rlike('(?i)^\\S*synonym "'))
    p = p.select("term_id", F.regexp_extract("v", '"((?:[^"\\\\]|\\\\.)*)"', 1).alias("syn"), F.lit("EXACT").alias("scope"))
    return s.unionByName(p).where("syn <> ''").distinct()


def text(terms_: DataFrame, parents: DataFrame) -> DataFrame:
    """[Term] blocks as text (column ``value``) of terms and their sorted parents (child, parents)."""
    p = terms_.join(parents.withColumnRenamed("child", "term_id"), "term_id", "left")
    isa = F.array_join(F.transform(F.coalesce("parents", F.array().cast("array<string>")), lambda x: F.concat(F.lit("\nis_a: "), x)), "")
    return p.select(F.concat(F.lit("[Term]\nid: "), "term_id", F.lit("\nname: "), F.coalesce("name", F.lit("")), isa, F.lit("\n")).alias("value"))
