"""Per-key results when a handful of keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweft.session import exchange_partitions


def frequent_candidates(df: DataFrame, key_columns: list[str], counters: int = 400) -> DataFrame:
    """Candidates ``(field_name, key, at_least)`` for heavy values of each of ``key_columns``.

    Misra-Gries summaries with ``counters`` counters per column: one per task, merged pairwise in a
    single small task (at most tasks x counters rows reach it; larger inputs merge in two levels).
    Guarantee, at every size: each value held by more than 1/counters of a column's rows is among the
    candidates; ``at_least`` is a lower bound of its count. Nulls and '' are no values. Values appear
    once per column. Empty input gives no candidates.
    """
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("key")) for c in key_columns))).alias("_e")).select("_e.*")
    long = long.where("key is not null and key <> ''").select("field_name", "key", F.lit(1).cast("long").alias("at_least"))
    schema = "field_name string, key string, at_least long"

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, dict[str, int]] = {}
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["field_name", "key"]).aggregate([("at_least", "sum")])
            for f, k, n in zip(t["field_name"].to_pylist(), t["key"].to_pylist(), t["at_least_sum"].to_pylist()):
                s = state.setdefault(f, {})
                s[k] = s.get(k, 0) + n
            for f, s in state.items():
                if len(s) > counters:
                    # subtracting the (counters+1)-th largest count keeps the summary mergeable
                    cut = sorted(s.values(), reverse=True)[counters]
                    state[f] = {k: n - cut for k, n in s.items() if n > cut}
        rows = [(f, k, n) for f, s in state.items() for k, n in s.items()]
        cols = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["field_name", "key", "at_least"])

    local = long.mapInArrow(summarise, schema)
    width = max(1, exchange_partitions(df.sparkSession) // 8)
    return local.repartition(width).mapInArrow(summarise, schema).coalesce(1).mapInArrow(summarise, schema)


def heavy_keys(df: DataFrame, key_columns: list[str], one_in: int, counters: int | None = None) -> DataFrame:
    """Exactly the values ``(field_name, family, n_rows, n_all)`` held by at least one in ``one_in`` rows of ``df``.

    The sketch proposes, a second pass counts the proposals exactly: the candidate list has at most
    ``counters`` rows per column by construction, so it is broadcast; the counts are combined map-side.
    Rows without a value count in ``n_all``. Repeated rows count as stored. Empty input gives no row.
    """
    counters = counters or 4 * one_in
    if counters < one_in:
        raise ValueError("the guarantee needs at least one_in counters")
    cand = frequent_candidates(df, key_columns, counters).select("field_name", F.col("key").alias("family"))
    vals = F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("family")) for c in key_columns))
    long = df.select(F.explode(vals).alias("_e")).select("_e.*")
    counted = long.join(F.broadcast(cand), ["field_name", "family"], "left_semi").groupBy("field_name", "family").agg(F.count("*").alias("n_rows"))
    total = df.agg(F.count("*").alias("n_all"))  # one row
    return counted.crossJoin(F.broadcast(total)).where(F.col("n_rows") * one_in >= F.col("n_all"))


def per_key_summary(df: DataFrame, key: str, partner: str, weight: str, one_in: int = 200) -> DataFrame:
    """``(family, n_rows, partners, evidence)`` for every value of ``key``, whatever its share of the rows.

    Heavy values (the sketch finds all with more than one in ``one_in`` rows) are tagged by a broadcast
    join of the bounded candidate list. Their rows are aggregated by (key, partner) first: combined
    map-side and exchanged on both columns, so a value with a third of all rows is spread over its
    partners, and only one row per partner and task meets at the key. All other values take the
    ordinary single shuffle on the key. Both parts are unioned.

    ``partners`` counts distinct non-empty partners, ``evidence`` sums ``weight`` with null as 0. Null
    and '' keys are no values. Repeated rows count as stored; empty input gives no row.
    """
    src = df.select(F.col(key).cast("string").alias("family"), F.col(partner).cast("string").alias("_p"), F.col(weight).cast("long").alias("_w")).where("family is not null and family <> ''")
    src = src.withColumn("_p", F.when(F.col("_p") != "", F.col("_p")))
    heavy = frequent_candidates(src, ["family"], max(16, one_in)).select(F.col("key").alias("family"), F.lit(True).alias("_heavy"))
    tagged = src.join(F.broadcast(heavy), "family", "left")
    by_partner = [F.count("*").alias("_n"), F.sum("_w").alias("_s")]
    by_family = [F.sum("_n").alias("n_rows"), F.count("_p").alias("partners"), F.coalesce(F.sum("_s"), F.lit(0)).cast("long").alias("evidence")]
    hot = tagged.where("_heavy").groupBy("family", "_p").agg(*by_partner).groupBy("family").agg(*by_family)
    # the exchange on the key alone also clusters (key, partner): one shuffle for both levels
    cold = tagged.where("_heavy is null").select("family", "_p", "_w").repartition("family").groupBy("family", "_p").agg(*by_partner).groupBy("family").agg(*by_family)
    return hot.unionByName(cold)
