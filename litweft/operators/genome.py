"""Genome annotation tracks."""

from __future__ import annotations

import base64
import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litweft.functions.text import complement


def gtf_line(seqname: str, feature: str, offset: str = "0", padding: int = 0) -> Column:
    """A GTF line of columns start, end, strand, gene_id with positions relative to ``offset``."""
    shift = lambda c: (F.col(c) - F.expr(offset) + padding).cast("string")
    return F.concat_ws("\t", F.lit(seqname), F.lit("."), F.lit(feature), shift("start"), shift("end"), F.lit("."), F.col("strand"), F.lit("."), F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('"')))


def site_tracks(sites: DataFrame) -> DataFrame:
    """``(gene, mirna, sites)``: binding sites of a gene by miRNA, in order of position."""
    return sites.groupBy("gene", "mirna").agg(F.array_sort(F.collect_list(F.struct("start", "end", "score"))).alias("sites"))


def gene_json(tracks: DataFrame) -> DataFrame:
    """``(gene, json)``: one JSON document per gene with the sites of every miRNA."""
    per = tracks.groupBy("gene").agg(F.array_sort(F.collect_list(F.struct("mirna", "sites"))).alias("tracks"))
    return per.select("gene", F.to_json(F.struct("gene", "tracks")).alias("json"))


def lookup(human: DataFrame, mouse: DataFrame, request: DataFrame) -> DataFrame:
    """Tracks of requests (gene, mirna, organism): human tables if the organism names hsa, else mouse ones with the
    gene in capitals; the miRNA's track is added only if both exist."""
    r = request.withColumn("_h", F.contains("organism", F.lit("hsa"))).withColumn("_g", F.when(F.col("_h"), F.col("gene")).otherwise(F.upper("gene")))
    both = human.withColumn("_h", F.lit(True)).unionByName(mouse.withColumn("_h", F.lit(False))).select("_h", F.col("gene").alias("_g"), F.col("mirna").alias("_m"), "sites")
    genes = both.select("_h", "_g").distinct().withColumn("found", F.lit(True))
    out = r.join(genes, ["_h", "_g"], "left").join(both.withColumnRenamed("_m", "mirna"), ["_h", "_g", "mirna"], "left")
    return out.select("gene", "mirna", "organism", F.coalesce("found", F.lit(False)).alias("gene_found"), "sites")


def gene_sequence(genes: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """``(gene_id, sequence)`` of genes (seqname, start, end inclusive, strand); the other strand reversed and complemented."""
    j = genes.join(chromosomes.withColumnRenamed("name", "seqname"), "seqname")
    s = F.substring("sequence", F.col("start"), F.col("end") - F.col("start") + 1)
    return j.select("gene_id", F.when(F.col("strand") == "-", complement(s)).otherwise(s).alias("sequence"))


def data_uri(df: DataFrame, column: str, mime: str = "application/gzip") -> DataFrame:
    """The column gzipped and written as a data URI; null stays null. Time stamps are left out, so equal texts are equal."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b[column] = [None if x is None else f"data:{mime};base64," + base64.b64encode(gzip.compress(x.encode(), mtime=0)).decode() for x in b[column]]
            yield b

    return df.mapInPandas(run, df.schema)
