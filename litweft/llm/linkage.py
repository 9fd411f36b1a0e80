"""Average-linkage clustering of a sparse similarity graph."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweft.llm.simjoin import components
from litweft.session import materialise

#: Components of up to so many edges are clustered in one task each, larger ones by distributed rounds.
LOCAL_EDGES = 200_000


def average_linkage(edges: Iterable[tuple[int, int, float]], threshold: float) -> dict[int, int]:
    """id -> smallest id of its cluster.

    The closest two clusters are joined while the mean similarity over all their pairs reaches
    ``threshold``; pairs without an edge count as 0. Ties go to the smaller ids.
    """
    total: dict[int, dict[int, float]] = {}
    for a, b, s in edges:
        total.setdefault(a, {})[b] = total.setdefault(b, {})[a] = s
    size = dict.fromkeys(total, 1)
    members = {a: [a] for a in total}
    heap = [(-s, min(a, b), max(a, b)) for a, row in total.items() for b, s in row.items() if a < b]
    heapq.heapify(heap)
    while heap:
        neg, a, b = heapq.heappop(heap)
        if a not in total or b not in total or b not in total[a]:
            continue
        now = total[a][b] / (size[a] * size[b])
        if abs(now + neg) > 1e-12:
            continue  # an entry of before a merge
        if now < threshold:
            break
        row = total.pop(b)
        row.pop(a)
        total[a].pop(b)
        size[a] += size.pop(b)
        members[a] += members.pop(b)
        for c, s in row.items():
            total[c].pop(b)
            total[a][c] = total[c][a] = total[a].get(c, 0.0) + s
        for c, s in total[a].items():
            heapq.heappush(heap, (-s / (size[a] * size[c]), min(a, c), max(a, c)))
    return {m: min(ms) for ms in members.values() for m in ms}


def _by_component(threshold: float):
    """Clusters of rows (component, a, b, sim) that come sorted by component; one component is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, edges = None, []
        ids: list[int] = []
        names: list[int] = []

        def settle() -> None:
            found = average_linkage(edges, threshold)
            ids.extend(found)
            names.extend(found.values())
            edges.clear()

        for b in batches:
            for c, *edge in zip(*(col.to_pylist() for col in b.columns)):
                if c != open_ and edges:
                    settle()
                open_ = c
                edges.append(tuple(edge))
            if len(ids) > 50_000:
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "cluster": pa.array(names, pa.int64())})
                ids.clear()
                names.clear()
        if edges:
            settle()
        if ids:
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "cluster": pa.array(names, pa.int64())})

    return run


def _rounds(edges: DataFrame, threshold: float, max_rounds: int = 200) -> DataFrame:
    """The same clusters for components of any size: in each round all pairs of clusters that are each
    other's nearest are joined (average linkage is reducible, so the order among them does not matter)."""
    ids = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    label = materialise(ids.select("id", F.col("id").alias("cluster")), "linkage")
    links = materialise(edges.select("a", "b", F.col("sim").alias("total")), "linkage")
    for _ in range(max_rounds):
        size = label.groupBy("cluster").agg(F.count("*").alias("n"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "total"))
        mean = both.join(size.select(F.col("cluster").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("cluster").alias("b"), F.col("n").alias("nb")), "b")
        mean = mean.select("a", "b", (F.col("total") / (F.col("na") * F.col("nb"))).alias("s")).where(F.col("s") >= threshold)
        # nearest: falling similarity, then the smaller pair of ids, one order for both sides
        key = F.struct(F.col("s"), -F.least("a", "b"), -F.greatest("a", "b"))
        best = mean.groupBy("a").agg(F.max_by("b", key).alias("b"))
        mutual = best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi").where("a < b")
        move = materialise(mutual.select(F.col("b").alias("old"), F.col("a").alias("new")), "linkage")
        if move.isEmpty():
            return label
        label = materialise(label.join(move, label["cluster"] == move["old"], "left").select("id", F.coalesce("new", "cluster").alias("cluster")), "linkage")
        ma, mb = move.select(F.col("old").alias("a"), F.col("new").alias("xa")), move.select(F.col("old").alias("b"), F.col("new").alias("xb"))
        moved = links.join(ma, "a", "left").join(mb, "b", "left").select(F.coalesce("xa", "a").alias("a"), F.coalesce("xb", "b").alias("b"), "total").where("a <> b")
        links = materialise(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total")), "linkage")
    raise RuntimeError("linkage did not settle")


def cluster(edges: DataFrame, threshold: float, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``(id, cluster)`` of every id in ``edges`` (a, b longs, sim double; each pair once, a <> b).

    Clusters never leave a connected component. Components of at most ``local_edges`` edges are brought
    together and clustered one after the other in tasks that hold many; larger ones go through distributed rounds with the same result.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim"), "edges")
    comp = components(edges)
    placed = edges.join(comp.withColumnRenamed("id", "a"), "a")
    weight = placed.groupBy("component").agg(F.count("*").alias("_e"))
    placed = materialise(placed.join(weight, "component"), "edges")
    small = placed.where(F.col("_e") <= local_edges).select("component", "a", "b", "sim")
    out = small.repartition("component").sortWithinPartitions("component", "a", "b").mapInArrow(_by_component(threshold), "id long, cluster long")
    large = placed.where(F.col("_e") > local_edges).select("a", "b", "sim")
    return out if large.isEmpty() else out.unionByName(_rounds(large, threshold))
