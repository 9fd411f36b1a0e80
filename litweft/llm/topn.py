"""Top N items within every group by mergeable bounded heaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries that one task's heaps may hold before they are handed on and started afresh.
HELD = 2_000_000


def _best(t: pa.Table, n: int) -> pa.Table:
    """The N best distinct items of every group: falling score, then rising item by code point, with their place.

    An item that occurs several times counts once, with its largest score.
    """
    t = t.group_by(["grp", "item"], use_threads=False).aggregate([("score", "max")]).rename_columns({"score_max": "score"}).select(["grp", "item", "score"])
    t = t.sort_by([("grp", "ascending"), ("score", "descending"), ("item", "ascending")])
    g = t["grp"].combine_chunks()
    first = np.concatenate([np.ones(min(len(g), 1), bool), pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)]) if len(g) > 1 else np.ones(len(g), bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    keep = rank < n
    return t.filter(pa.array(keep)).append_column("place", pa.array((rank[keep] + 1).astype("int32")))


def _local_heaps(n: int):
    """Size-N heaps of all groups of a task. Each batch is reduced to its own heaps and merged into the
    held ones; the vectorised merge keeps exactly what a heap per group would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = settled = 0
        for b in batches:
            t = _best(pa.Table.from_batches([b]), n).drop_columns(["place"])
            held.append(t)
            rows += t.num_rows
            if rows > max(500_000, 2 * settled):
                held = [_best(pa.concat_tables(held), n).drop_columns(["place"])]
                rows = settled = held[0].num_rows
                if settled > HELD:
                    yield from held[0].combine_chunks().to_batches()
                    held, rows, settled = [], 0, 0
        if held:
            yield from _best(pa.concat_tables(held), n).drop_columns(["place"]).combine_chunks().to_batches()

    return run


def _merged_heaps(n: int):
    """Heaps of all tasks, sorted by group, merged into one per group. A group is handed on as soon as the
    next one begins, so a task holds one group's heap and one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = _best(t if held is None else pa.concat_tables([held, t]), n)
            last = pc.equal(t["grp"], t["grp"][-1]) if t.num_rows else pa.array([], pa.bool_())
            held = t.filter(last).drop_columns(["place"])
            yield from t.filter(pc.invert(last)).combine_chunks().to_batches()
        if held is not None:
            yield from _best(held, n).combine_chunks().to_batches()

    return run


def top_n(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """``(group, place int, item, score)``: the N best distinct items of every group.

    The score of an item is its largest ``score`` among all its rows of the group; rows with a null
    score, or a null or empty group or item, do not count. Order: falling score, then rising item by
    code point, so ties have one result. Repeated rows change nothing; extra columns are not read.

    Every task keeps a heap of the N best distinct items per group while it reads, and only heaps are
    exchanged, once: an item of the final N is among the N best of the task that holds its best row, as
    whatever precedes it there precedes it overall. A group with a third of all rows sends at most N
    rows per task. After the exchange rows come sorted by group (a spilling sort), so memory does not
    grow with the number of groups. ``group`` and ``item`` must be named otherwise than ``place``.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    src = df.select(F.col(group).cast("string").alias("grp"), F.col(item).cast("string").alias("item"), F.col(score).cast("long").alias("score"))
    src = src.where("score is not null and grp is not null and grp <> '' and item is not null and item <> ''")
    schema = "grp string, item string, score long"
    local = src.mapInArrow(_local_heaps(n), schema)
    merged = local.repartition("grp").sortWithinPartitions("grp").mapInArrow(_merged_heaps(n), schema + ", place int")
    return merged.select(F.col("grp").alias(group), "place", F.col("item").alias(item), F.col("score").alias(score))
