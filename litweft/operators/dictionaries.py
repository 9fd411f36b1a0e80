"""Builders of synonym dictionaries from gene tables, ontologies and name lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litweft.functions import synonyms as sy
from litweft.operators.documents import chunks
from litweft.operators.ontology import closure


def _listed(name: str, mark: str = ",") -> Column:
    """Values of a delimited cell; marks inside double quotes do not split."""
    text = F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return F.transform(F.regexp_extract_all(text, F.lit(f'("(?:[^"]|"")*"|[^{mark}]+)'), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, '^\\s*"|"\\s*$', "")))


def merge_symbols(entries: DataFrame) -> DataFrame:
    """``(term_id, syns)``: one row an id, synonyms of all its rows cleaned and united in sorted order."""
    per = entries.groupBy("term_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("syns")))).alias("syns"))
    return per.select("term_id", sy.clean_list(F.col("syns")).alias("syns")).where(F.size("syns") > 0)


def from_hgnc(table: DataFrame) -> DataFrame:
    """Human gene dictionary: approved, previous and alias symbols and names; withdrawn entries pass their
    symbols on to nobody, miRNA genes other than host genes are left out."""
    live = table.where(F.coalesce(~F.contains(F.lower("Status"), F.lit("withdrawn")), F.lit(True)) & ~F.contains(F.coalesce("Approved symbol", F.lit("")), F.lit("~withdrawn")))
    live = live.where(sy.is_gene_symbol(F.coalesce("Approved symbol", F.lit(""))))
    cells = [F.array(F.col("Approved symbol"), F.col("Approved name")), _listed("Previous symbols"), _listed("Previous name"), _listed("Alias symbols"), _listed("Alias names")]
    return merge_symbols(live.select(F.col("HGNC ID").alias("term_id"), sy.hyphen_variants(F.filter(F.concat(*cells), lambda x: x.isNotNull())).alias("syns")))


def from_mgi(markers: DataFrame, enriched: DataFrame | None = None) -> DataFrame:
    """Mouse gene dictionary of (marker_id, symbol); ``enriched`` adds further (marker_id, symbol) rows."""
    all_ = markers.select("marker_id", "symbol") if enriched is None else markers.select("marker_id", "symbol").unionByName(enriched.select("marker_id", "symbol"))
    good = all_.where(F.col("symbol").isNotNull() & sy.is_gene_symbol(F.col("symbol")))
    return merge_symbols(good.select(F.col("marker_id").alias("term_id"), sy.hyphen_variants(F.array("symbol")).alias("syns")))


def from_mirbase(entries: DataFrame, aliases: DataFrame) -> DataFrame:
    """miRNA dictionary of (accession, name) and ';'-packed aliases (accession, names)."""
    more = aliases.select(F.col("accession").alias("term_id"), F.split("names", ";").alias("syns"))
    return merge_symbols(entries.select(F.col("accession").alias("term_id"), F.array("name").alias("syns")).unionByName(more))


def from_ontology(terms: DataFrame, synonyms: DataFrame, edges: DataFrame | None = None, excluded_roots: Sequence[str] = (), excluded_terms: Sequence[str] = (), names: bool = True) -> DataFrame:
    """Dictionary of an ontology: names and synonyms of terms that are not obsolete, without the sub-trees below
    ``excluded_roots`` (roots included) and single ``excluded_terms``."""
    live = terms.where("not is_obsolete").select("term_id", "name")
    if excluded_terms:
        live = live.where(~F.col("term_id").isin(list(excluded_terms)))
    if excluded_roots and edges is not None:
        seeds = edges.sparkSession.createDataFrame([(r,) for r in excluded_roots], "node string")
        live = live.join(closure(seeds, edges, include_self=True).select(F.col("node").alias("term_id")), "term_id", "left_anti")
    own = live.select("term_id", F.array("name").alias("syns")) if names else live.select("term_id", F.array().cast("array<string>").alias("syns"))
    more = synonyms.join(live.select("term_id"), "term_id", "left_semi").select("term_id", F.array("syn").alias("syns"))
    return merge_symbols(own.unionByName(more))


def with_variants(d: DataFrame, greek: bool = False, cells: bool = False, acronyms: bool = False) -> DataFrame:
    """Adds Greek letters, inverted cell names ('X cell of Y') and acronyms of cell names."""
    s = F.col("syns")
    if greek:
        s = sy.greek_variants(s)
    if cells:
        s = F.array_distinct(F.concat(s, F.transform(s, sy.invert_cell)))
    if acronyms:
        s = F.array_distinct(F.concat(s, F.filter(F.transform(s, sy.acronym), lambda x: x.isNotNull())))
    return d.withColumn("syns", s)


def finish(d: DataFrame, excluded: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exclude lists, numbers and single characters out; an id that is itself excluded becomes unfindable."""
    s = sy.without_numbers(sy.without_excluded(F.col("syns"), excluded))
    bad = sorted({w for words in excluded.values() for w in words})
    ident = F.when(F.col("term_id").isin(bad), sy.unfindable(F.col("term_id"))).otherwise(F.col("term_id")) if bad else F.col("term_id")
    return d.select(ident.alias("term_id"), s.alias("syns")).where(F.size("syns") > 0)


def as_rows(d: DataFrame, dict_id: int) -> DataFrame:
    """``(dict_id, syn_idx, syn_id, syn)`` for the matcher; entries are numbered in order of their id, by ranges
    (no single task sorts them all)."""
    numbered = chunks(d, 1, order="term_id").withColumnRenamed("chunk", "syn_idx")
    return numbered.select(F.lit(dict_id).alias("dict_id"), F.col("syn_idx").cast("int"), F.translate("term_id", ":", "_").alias("syn_id"), F.explode("syns").alias("syn"))
