"""Co-occurrence of two kinds of entities in a sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litweft.functions.text import usable_sentence
from litweft.operators.intervals import overlap


def dense_sentences_out(hits: DataFrame, most: int = 30) -> DataFrame:
    """Hits of sentences with at most ``most`` hits. Counted map-side and joined back, so that one sentence with
    very many hits is never brought together."""
    crowded = hits.groupBy("sent_id").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    return hits.join(crowded.select("sent_id"), "sent_id", "left_anti")


def pairs(a: DataFrame, b: DataFrame, sentences: DataFrame | None = None, longest: int = 500) -> DataFrame:
    """Pairs of hits of ``a`` and ``b`` in one sentence, columns suffixed _a and _b.

    The entities must differ in synonym, position and surface, and must not overlap; touching spans count
    as overlapping. With ``sentences`` (sent_id, text) captions and sentences over ``longest`` go too.
    """
    side = lambda d, s: d.select("sent_id", *(F.col(c).alias(f"{c}_{s}") for c in ("dict_id", "syn_idx", "syn", "matched", "start", "end")))
    j = side(a, "a").join(side(b, "b"), "sent_id")
    same_syn = (F.col("dict_id_a") == F.col("dict_id_b")) & (F.col("syn_idx_a") == F.col("syn_idx_b"))
    out = j.where(~same_syn & (F.col("syn_a") != F.col("syn_b")) & ~overlap(F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b"), closed=True))
    if sentences is not None:
        out = out.join(sentences.where(usable_sentence(F.col("text"), longest)).select("sent_id", "text"), "sent_id")
    return out


def distinct_pairs(pairs_: DataFrame) -> DataFrame:
    """One row per sentence and pair of synonyms: the leftmost pair of hits."""
    w = Window.partitionBy("sent_id", "syn_a", "syn_b").orderBy("start_a", "start_b", "end_a", "end_b")
    return pairs_.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
