"""Identifier mapping chains and expansions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chain(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """``(id, targets)``: ids of ``start`` followed through mapping tables.

    A step is (table, from column, to column). Each is an equi-join on distinct pairs; null and '' never
    map. Ids that get lost on the way have no row. ``targets`` is sorted.
    """
    at = start.select(F.col(start.columns[0]).alias("id")).where("id is not null").distinct().withColumn("_at", F.col("id"))
    for df, a, b in steps:
        pairs = df.select(F.col(a).alias("_at"), F.col(b).alias("_to")).where("_at is not null and _to is not null and cast(_to as string) <> ''").distinct()
        at = at.join(pairs, "_at").select("id", F.col("_to").alias("_at")).distinct()
    return at.groupBy("id").agg(F.array_sort(F.collect_set("_at")).alias("targets"))


def expand_targets(sites: DataFrame, families: DataFrame, packed: str = "gene_mir", mark: str = ":") -> DataFrame:
    """Target sites 'gene:family' -> one row per miRNA of the family: (gene, family, mirna, other columns)."""
    parts = F.split(packed, mark, 2)
    split = sites.withColumn("gene", parts[0]).withColumn("family", F.get(parts, F.lit(1)))
    return split.join(families.select("family", "mirna").distinct(), "family")


def enrich_symbols(markers: DataFrame, uniprot: DataFrame, packed: str = "uniprot_ids", mark: str = "|") -> DataFrame:
    """Markers with the symbols of their '|'-packed protein ids: (marker_id, symbol), own symbol included."""
    ids = markers.select("marker_id", F.explode(F.split(packed, f"\\{mark}")).alias("protein")).where("protein <> ''")
    extra = ids.join(uniprot.select("protein", F.col("symbol").alias("_s")).distinct(), "protein").select("marker_id", F.col("_s").alias("symbol"))
    return markers.select("marker_id", "symbol").unionByName(extra).where("symbol <> ''").distinct()


def alias_join(entries: DataFrame, aliases: DataFrame) -> DataFrame:
    """miRNA entries with their ';'-packed aliases: (accession, name, alias), alias null where there is none."""
    a = aliases.select("accession", F.explode(F.split("names", ";")).alias("alias")).where("alias <> ''")
    return entries.select("accession", "name").join(a, "accession", "left")


def term_by_id(hits: DataFrame, terms: DataFrame, on: str = "concept_id") -> DataFrame:
    """Term lookup with a fallback: the id as it is, else with its first '_' read as ':'."""
    alt = F.regexp_replace(on, "^([^_]*)_", "$1:")
    direct = terms.select(F.col("term_id").alias(on), F.col("name").alias("_n1"))
    other = terms.select(F.col("term_id").alias("_alt"), F.col("name").alias("_n2"))
    return hits.withColumn("_alt", alt).join(direct, on, "left").join(other, "_alt", "left").withColumn("term_name", F.coalesce("_n1", "_n2")).drop("_alt", "_n1", "_n2")
