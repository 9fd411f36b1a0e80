"""Evaluation: confusion counts, scores, ablations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gold_labels(df: DataFrame) -> DataFrame:
    """Gold labels with the classes that stand for a neutral relation written NEU."""
    return df.withColumn("dir", F.when(F.col("dir").isin("TARGET", "INVCORR", "REGULATE"), "NEU").otherwise(F.col("dir")))


def confusion(df: DataFrame, truth: Column, predicted: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, tp, fp, fn, tn)``; null counts as false."""
    t, p = F.coalesce(truth, F.lit(False)), F.coalesce(predicted, F.lit(False))
    n = lambda c: F.sum(c.cast("long"))
    return df.groupBy(*keys).agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(t & ~p).alias("fn"), n(~t & ~p).alias("tn"))


def scores(conf: DataFrame) -> DataFrame:
    """Adds precision tp/(tp+fp), recall tp/(tp+fn), specificity tn/(tn+fp) and F1; null where undefined."""
    ratio = lambda a, b: F.round(F.col(a) / F.nullif(b, F.lit(0)), 6)
    c = F.col
    return (
        conf.withColumn("precision", ratio("tp", c("tp") + c("fp"))).withColumn("recall", ratio("tp", c("tp") + c("fn")))
        .withColumn("specificity", ratio("tn", c("tn") + c("fp"))).withColumn("f1", F.round(2 * c("tp") / F.nullif(2 * c("tp") + c("fp") + c("fn"), F.lit(0)), 6))
    )


def by_label(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row per label: support, tp, fp, fn, scores. Labels of either column."""
    t = df.groupBy(F.col(truth).alias("label")).agg(F.count("*").alias("support"), F.sum((F.col(truth) == F.coalesce(F.col(predicted), F.lit(""))).cast("long")).alias("tp"))
    p = df.groupBy(F.col(predicted).alias("label")).agg(F.count("*").alias("claimed"))
    full = t.join(p, "label", "full").fillna(0, ["support", "tp", "claimed"]).where("label is not null")
    conf = full.select("label", "support", "tp", (F.col("claimed") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn"), F.lit(0).cast("long").alias("tn"))
    return scores(conf).drop("tn", "specificity")


def ablation(df: DataFrame, checks: Mapping[str, Column], truth: Column) -> DataFrame:
    """``(subset, ...scores)`` for every subset of ``checks``; a row is accepted if all checks of the subset hold.

    The subsets are a generated array per row, so the data are read once; counts combine map-side.
    """
    names = list(checks)
    bits = F.array(*(F.coalesce(checks[n], F.lit(False)) for n in names))
    flagged = df.select(truth.alias("_t"), bits.alias("_bits")).select("_t", "_bits", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(names) - 1))).alias("mask"))
    ok = F.lit(True)
    for i in range(len(names)):
        ok = ok & (F.col("_bits")[i] | (F.col("mask").bitwiseAND(F.lit(1 << i)) == 0))
    label = F.array_join(F.array(*(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, n) for i, n in enumerate(names))), "+")
    conf = confusion(flagged.withColumn("_p", ok), F.col("_t"), F.col("_p"), ["mask"])
    return scores(conf.withColumn("subset", label)).drop("mask")


def weighted_by_subset(df: DataFrame, checks: Mapping[str, Column], truth: str, predicted: Column) -> DataFrame:
    """``(subset, support, precision, recall, f1)`` for every subset of ``checks``: the scores of all true labels, weighted
    by their support. A row that fails a check of the subset has the label 'NA'; rows without a truth do not count; a
    label that is never predicted has precision 0. The data are read once; counts combine map-side.
    """
    names = list(checks)
    bits = F.array(*(F.coalesce(checks[n], F.lit(False)) for n in names))
    flagged = df.where(F.col(truth).isNotNull()).select(F.col(truth).alias("_t"), predicted.alias("_p"), bits.alias("_bits")).withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(names) - 1))))
    ok = F.lit(True)
    for i in range(len(names)):
        ok = ok & (F.col("_bits")[i] | (F.col("mask").bitwiseAND(F.lit(1 << i)) == 0))
    cells = flagged.groupBy("mask", "_t", F.when(ok, F.col("_p")).otherwise("NA").alias("_p")).agg(F.count("*").alias("_n"))
    true = cells.groupBy("mask", F.col("_t").alias("label")).agg(F.sum("_n").alias("support"), F.sum(F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0)).alias("tp"))
    said = cells.groupBy("mask", F.col("_p").alias("label")).agg(F.sum("_n").alias("claimed"))
    one = true.join(said, ["mask", "label"], "left").fillna(0, ["claimed"])
    mean = lambda x: F.round(F.sum(F.coalesce(x, F.lit(0.0)) * F.col("support")) / F.sum("support"), 6)
    c = F.col
    got = one.groupBy("mask").agg(
        F.sum("support").alias("support"), mean(c("tp") / F.nullif(c("claimed"), F.lit(0))).alias("precision"), mean(c("tp") / c("support")).alias("recall"), mean(2 * c("tp") / (c("support") + c("claimed"))).alias("f1")
    )
    label = F.array_join(F.array(*(F.when(c("mask").bitwiseAND(F.lit(1 << i)) != 0, n) for i, n in enumerate(names))), "+")
    return got.select(label.alias("subset"), "support", "precision", "recall", "f1")


def blame(df: DataFrame, rule: str, truth: str, predicted: str) -> DataFrame:
    """``(rule, n_right, n_wrong)``: which rule decided right or wrong how often."""
    right = F.coalesce(F.col(truth) == F.col(predicted), F.lit(False))
    return df.groupBy(rule).agg(F.sum(right.cast("long")).alias("n_right"), F.sum((~right).cast("long")).alias("n_wrong"))


def f1_curve(f1: float, points: Sequence[float]) -> list[tuple[float, float]]:
    """Points (precision, recall) of equal F1; precisions that cannot reach it are left out."""
    return [(p, f1 * p / (2 * p - f1)) for p in points if 2 * p > f1 and f1 * p / (2 * p - f1) <= 1]
