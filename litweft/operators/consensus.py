"""Evidence rows -> consensus interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ("mirna_family", "gene_family")


def clean_family(name: Column) -> Column:
    """Family names without the '__' that marks names not to be searched for."""
    return F.regexp_replace(name, "__", "")


def reject_rows(df: DataFrame, gene: str = "gene_family", bad_names: Sequence[str] = (), regulation: str | None = None) -> DataFrame:
    """Row-level rejects: genes that are miRNAs themselves and literal stop names; a misspelt class is mended.

    Null genes are rejected too (they name nothing).
    """
    out = df.where(F.col(gene).isNotNull() & ~F.upper(gene).startswith("MIR-"))
    if bad_names:
        out = out.where(~F.col(gene).isin(list(bad_names)))
    if regulation:
        out = out.withColumn(regulation, F.when(F.col(regulation) == "CHNAGE", "CHANGE").otherwise(F.col(regulation)))
    return out


def spans_by_entity(df: DataFrame, direction: str = "direction", first: str = "loc1", second: str = "loc2") -> DataFrame:
    """``loc_mirna`` and ``loc_gene``: the spans by kind of entity, whatever the direction of the relation."""
    mir_first = F.coalesce(F.col(direction) == "MIR_GENE", F.lit(True))
    return df.withColumn("loc_mirna", F.when(mir_first, F.col(first)).otherwise(F.col(second))).withColumn("loc_gene", F.when(mir_first, F.col(second)).otherwise(F.col(first)))


def consensus(ev: DataFrame, sent_struct: Column | None = None) -> DataFrame:
    """One row per (miRNA family, gene family, direction, regulation).

    Organisms are split, united, sorted and joined by ';'. Documents and sentence evidences are sets,
    counted. ``is_consensus`` is 1 for every interaction tied at the largest document count of its
    pair. Aggregation and window share one exchange: rows are hash-partitioned by the pair, which also
    clusters the wider grouping key.
    """
    sent = sent_struct if sent_struct is not None else F.col("sent_id")
    orgs = F.array_join(F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(F.split("organism", ";"))), lambda x: x != ""))), ";")
    g = ev.groupBy(*PAIR, "direction", "regulation").agg(
        orgs.alias("organisms"), F.array_sort(F.collect_set("doc_id")).alias("evidence_documents"), F.array_sort(F.collect_set(sent)).alias("sent_evidences")
    )
    g = g.withColumn("evidence_count", F.size("evidence_documents").cast("long")).withColumn("sent_count", F.size("sent_evidences").cast("long"))
    return with_consensus_flag(g)


def consensus_counts(ev: DataFrame) -> DataFrame:
    """As ``consensus`` without the lists: organisms, counts and flag, for groups of any size.

    Every row is split into its evidence and its organism; distinct ones are combined map-side and then
    counted document by document, so a group with a third of all rows is spread over its documents, the
    organisms of a group meet as a handful of rows, and every large step is a hash aggregation in
    generated code. A sentence id belongs to one document.
    """
    group = [*PAIR, "direction", "regulation"]
    none = F.lit(None).cast("string")
    halves = F.array(F.struct("doc_id", "sent_id", none.alias("organism")), F.struct(none.alias("doc_id"), none.alias("sent_id"), "organism"))
    facts = ev.select(*group, F.explode(halves).alias("_x")).select(*group, "_x.*").distinct()
    per_doc = facts.groupBy(*group, "doc_id", "organism").agg(F.count("sent_id").alias("_s"))
    few = per_doc.groupBy(*group, "organism").agg(F.count("doc_id").alias("_d"), F.sum("_s").alias("_s"))
    names = F.array_distinct(F.filter(F.flatten(F.transform(F.collect_set("organism"), lambda x: F.split(x, ";"))), lambda x: x != ""))
    g = few.groupBy(*group).agg(F.array_join(F.array_sort(names), ";").alias("organisms"), F.sum("_d").alias("evidence_count"), F.sum("_s").alias("sent_count"))
    return with_consensus_flag(g)


def with_consensus_flag(df: DataFrame, pair: Sequence[str] = PAIR, count: str = "evidence_count") -> DataFrame:
    """Adds ``is_consensus``: 1 where ``count`` is the largest of its pair (ties all 1), else 0 (null counts 0)."""
    top = F.max(count).over(Window.partitionBy(*pair))
    return df.withColumn("is_consensus", F.coalesce((F.col(count) == top).cast("int"), F.lit(0)))


def consensus_rows(df: DataFrame, pair: Sequence[str] = PAIR, count: str = "evidence_count") -> DataFrame:
    """As ``with_consensus_flag`` for raw rows, of which one pair may hold very many: the largest count of every pair is
    combined map-side and joined back (null keys are equal), so no pair is brought together in one task."""
    top = df.groupBy(*pair).agg(F.max(count).alias("_top")).select(*(F.col(c).alias(f"_{c}") for c in pair), "_top")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in pair]
    flag = F.coalesce((F.col(count) == F.col("_top")).cast("int"), F.lit(0)).alias("is_consensus")
    return df.join(top, same).select(*(c for c in df.columns if c != "is_consensus"), flag)


def serving_rows(cons: DataFrame) -> DataFrame:
    """The flat form: interaction as 'DIR;REG', documents ';'-joined, evidences joined by ';'."""
    return cons.select(
        *PAIR, F.concat_ws(";", "direction", "regulation").alias("interaction"), "organisms", F.array_join("evidence_documents", ";").alias("evidence_documents"),
        F.array_join(F.transform("sent_evidences", lambda x: x.cast("string")), ";").alias("sent_evidences"), "evidence_count", "sent_count", "is_consensus",
    )


def interaction_documents(ev: DataFrame) -> DataFrame:
    """One row per (pair, interaction, document) of evidence rows; no lists in between, so no group is brought together."""
    return ev.select(*PAIR, F.concat_ws(";", "direction", "regulation").alias("interaction"), "doc_id").where("doc_id is not null").distinct()


def pack_evidence(df: DataFrame) -> DataFrame:
    """Nested form: ``evidence`` struct(sent, loc_mirna, loc_gene) and ``interaction`` struct(dir, type); flat columns go."""
    return df.withColumn("evidence", F.struct(F.col("sent_id").alias("sent"), "loc_mirna", "loc_gene")).withColumn("interaction", F.struct(F.col("direction").alias("int_dir"), F.col("regulation").alias("int_type"))).drop("sent_id", "loc_mirna", "loc_gene", "direction", "regulation")
