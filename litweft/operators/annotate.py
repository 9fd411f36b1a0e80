"""Document annotations with ontology concepts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("doc_id", "annotation", "concept_id", "concept")


def annotations(hits: DataFrame, evidence: str = "sent_evidences") -> DataFrame:
    """``(doc_id, annotation, concept_id, concept, evidences)``: the set of evidences per key."""
    return hits.groupBy(*KEY).agg(F.array_sort(F.collect_set(evidence)).alias("evidences"))


def without_concepts(df: DataFrame, stop: Sequence[str], concept: str = "concept") -> DataFrame:
    """Rows whose concept is not in the stop list; null concepts stay."""
    return df.where(F.col(concept).isNull() | ~F.col(concept).isin(list(stop))) if stop else df


def concept_counts(df: DataFrame) -> DataFrame:
    """``(annotation, concept_id, concept, n)``: rows per concept, combined map-side."""
    return df.groupBy("annotation", "concept_id", "concept").agg(F.count("*").alias("n"))


def drop_shared_names(df: DataFrame, vocabulary: str = "ncit", source: str | None = None) -> DataFrame:
    """Rows of ``vocabulary`` go if their concept's name, in upper case, occurs in another vocabulary (of the
    same ``source``); all other rows stay. Null and '' names never clash."""
    on = ["_u", *([source] if source else [])]
    named = df.withColumn("_u", F.upper(F.translate("concept", "ß", "ẞ")))
    others = named.where(F.coalesce(F.col("annotation") != vocabulary, F.lit(False)) & (F.col("concept") != "")).select(*on).distinct()
    mine = F.coalesce(F.col("annotation") == vocabulary, F.lit(False))
    return named.where(~mine).drop("_u").unionByName(named.where(mine).join(others, on, "left_anti").drop("_u"))


def suppress_excluded(df: DataFrame, marker: str = "_excl") -> DataFrame:
    """Annotations whose document also has the concept's ``<concept_id><marker>`` entry go, and so do the entries."""
    bad = df.where(F.endswith("concept_id", F.lit(marker))).select("doc_id", F.regexp_replace("concept_id", f"{marker}$", "").alias("concept_id")).distinct()
    return df.where(~F.endswith("concept_id", F.lit(marker))).join(bad, ["doc_id", "concept_id"], "left_anti")


def with_interactions(interactions: DataFrame, annots: DataFrame, on: str = "doc_id") -> DataFrame:
    """Interactions with the annotations of their documents (inner join on the document)."""
    return interactions.join(annots, on)
