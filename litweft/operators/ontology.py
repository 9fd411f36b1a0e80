"""Ontology graphs: closures, levels, roots, roll-ups."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litweft.session import materialise

#: Graphs of up to so many distinct edges are walked inside the tasks that hold the seeds, larger ones level by level.
LOCAL_EDGES = 200_000


def closure(seeds: DataFrame, edges: DataFrame, max_depth: int | None = None, up: bool = False, include_self: bool = False) -> DataFrame:
    """``(seed, node, level)``: everything below (or above) every seed, at its shortest distance.

    ``seeds`` has a column ``node``; ``edges`` has ``child`` and ``parent``. Terms unknown to the edges
    have only themselves. A seed met again is not below itself.

    A graph of at most LOCAL_EDGES edges (counted first) is broadcast and walked breadth first from every seed, in
    one pass over the distinct seeds. A larger one goes by semi-naive iteration: each round joins only the frontier
    with the edges and drops what is known, so cycles and diamonds end; the frontier is written to shared storage,
    which keeps the plan short. Both ways have the same result.
    """
    src, dst = ("child", "parent") if up else ("parent", "child")
    few = edges.where("child is not null and parent is not null and child <> parent").select(src, dst).distinct().limit(LOCAL_EDGES + 1).collect()
    if len(few) <= LOCAL_EDGES:
        return _walk(seeds, few, max_depth, include_self)
    step = materialise(edges.where("child is not null and parent is not null and child <> parent").select(F.col(src).alias("node"), F.col(dst).alias("next")).distinct(), "edges")
    front = materialise(seeds.select(F.col("node").alias("seed"), "node", F.lit(0).cast("long").alias("level")).where("node is not null").distinct(), "closure")
    known, depth = front, 0
    parts = [front] if include_self else []
    while max_depth is None or depth < max_depth:
        depth += 1
        nxt = front.join(step, "node").select("seed", F.col("next").alias("node")).distinct().join(known.select("seed", "node"), ["seed", "node"], "left_anti")
        nxt = materialise(nxt.select("seed", "node", F.lit(depth).cast("long").alias("level")), "closure")
        if nxt.isEmpty():
            break
        parts.append(nxt)
        known = known.unionByName(nxt)
        front = nxt
    if not parts:
        return front.limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _walk(seeds: DataFrame, edges: list[tuple], max_depth: int | None, include_self: bool) -> DataFrame:
    """``closure`` where the edges, as (from, to), are at hand."""
    start = seeds.select(F.col("node").alias("seed")).where("seed is not null").distinct()
    steps: dict[object, list] = defaultdict(list)
    for a, b in edges:
        steps[a].append(b)
    held = seeds.sparkSession.sparkContext.broadcast(dict(steps))
    kind = start.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nexts = held.value
        rows: tuple[list, list, list] = ([], [], [])
        type_ = None

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(rows[0], type_), pa.array(rows[1], type_), pa.array(rows[2], pa.int64())], names=["seed", "node", "level"])
            for r in rows:
                r.clear()
            return out

        for b in batches:
            type_ = b.column(0).type
            for seed in b.column(0).to_pylist():
                seen, front, level = {seed}, [seed], 0
                found = front if include_self else []
                while True:
                    rows[0].extend([seed] * len(found))
                    rows[1].extend(found)
                    rows[2].extend([level] * len(found))
                    if len(rows[0]) >= 50_000:
                        yield batch()
                    if not front or level == max_depth:
                        break
                    level += 1
                    front = [n for n in dict.fromkeys(n for f in front for n in nexts.get(f, ())) if n not in seen]
                    seen.update(front)
                    found = front
        if rows[0]:
            yield batch()

    return start.mapInArrow(run, f"seed {kind}, node {kind}, level long")


def closure_sql(spark, seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """The bounded closure downwards as one recursive query, for trees and small depths.

    The query lifts the session's limits on recursion (a million rows, a hundred levels) for itself, as ``max_depth``
    ends it. Every level holds a pair once, however many paths lead to it.
    """
    query = f"""
      WITH RECURSIVE c (seed, node, level) MAX RECURSION LEVEL {int(max_depth) + 1} AS (
        SELECT DISTINCT node, node, CAST(0 AS BIGINT) FROM {{seeds}}
        UNION ALL SELECT DISTINCT c.seed, e.child, c.level + 1 FROM c JOIN {{edges}} e ON e.parent = c.node WHERE c.level < {int(max_depth)})
      SELECT seed, node, min(level) AS level FROM (SELECT * FROM c LIMIT ALL) WHERE level > 0 GROUP BY seed, node"""
    return spark.sql(query, seeds=seeds.select("node"), edges=edges.select("child", "parent"))


def at_level(seeds: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """``(seed, node)``: descendants exactly ``level`` down; leaves reached earlier count as well."""
    all_ = closure(seeds, edges, max_depth=level, include_self=True)
    inner = edges.select(F.col("parent").alias("node")).distinct()
    return all_.where(F.col("level") == level).select("seed", "node").unionByName(all_.where((F.col("level") < level) & (F.col("level") > 0)).join(inner, "node", "left_anti").select("seed", "node"))


def roots(edges: DataFrame) -> DataFrame:
    """``node`` of terms that have children but no parent."""
    return edges.select(F.col("parent").alias("node")).distinct().join(edges.select(F.col("child").alias("node")), "node", "left_anti")


def parents(edges: DataFrame) -> DataFrame:
    """``(child, parents)``: the sorted direct parents."""
    return edges.groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("parents"))


def root_of(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every term's roots; roots are their own. Terms above which there are only circles have none.

    Pointer doubling: every term points to what lies 2^k steps above it, roots to themselves, and each round follows
    the pointers of the pointers, so the rounds grow with the logarithm of the depth.
    """
    known = materialise(edges.where("child is not null and parent is not null and child <> parent").select("child", "parent").distinct(), "edges")
    tops = materialise(roots(known), "roots")
    links = materialise(known.select(F.col("child").alias("node"), F.col("parent").alias("up")).unionByName(tops.select("node", F.col("node").alias("up"))), "pointers")
    # no path without a circle is longer than the number of edges
    for _ in range(max(known.count(), 1).bit_length()):
        if links.select("up").distinct().join(tops.withColumnRenamed("node", "up"), "up", "left_anti").isEmpty():
            break
        links = materialise(links.join(links.select(F.col("node").alias("up"), F.col("up").alias("next")), "up").select("node", F.col("next").alias("up")).distinct(), "pointers")
    return links.join(tops.withColumnRenamed("node", "up"), "up", "left_semi").select("node", F.col("up").alias("root"))


def suppress_descendants(hits: DataFrame, edges: DataFrame, within: int = 2, active: bool = True) -> DataFrame:
    """Hits (doc_id, node, ...) without those at most ``within`` levels below another hit term of the same document.

    ``active=False`` keeps all, as the literal behaviour of the original does.
    """
    if not active:
        return hits
    terms = hits.select("doc_id", "node").distinct()
    below = closure(terms.select("node").distinct(), edges, max_depth=within).select("seed", F.col("node").alias("lower"))
    bad = terms.join(below, terms["node"] == below["seed"]).select("doc_id", F.col("lower").alias("node")).distinct()
    return hits.join(bad, ["doc_id", "node"], "left_anti")


def context_documents(terms: DataFrame, contexts: DataFrame, edges: DataFrame) -> DataFrame:
    """``doc_id`` of documents that have, for every wanted context (column ``node``), the term or a descendant of it.

    ``terms`` is (doc_id, node). The number of contexts is compared with the distinct contexts met.
    """
    wanted = contexts.select("node").distinct()
    full = closure(wanted, edges, include_self=True).select("seed", "node")
    met = terms.join(full, "node").groupBy("doc_id").agg(F.countDistinct("seed").alias("met"))
    return met.crossJoin(F.broadcast(wanted.agg(F.count("*").alias("want")))).where("met = want").select("doc_id")


def term_genes(annotations: DataFrame, terms: DataFrame, edges: DataFrame, taxa: Sequence | None = None) -> DataFrame:
    """``(term, taxon, gene)``: the genes that ``annotations`` (term, gene, taxon) have at every wanted term (column
    ``node``) or below it, of some organisms only."""
    below = closure(terms.select("node").distinct(), edges, include_self=True).select(F.col("seed").alias("_wanted"), F.col("node").alias("term"))
    a = annotations.where(F.col("taxon").isin(list(taxa))) if taxa is not None else annotations
    return a.join(below, "term").select(F.col("_wanted").alias("term"), "taxon", "gene").distinct()


def merge_terms(terms: DataFrame) -> DataFrame:
    """One row per ``term_id``: synonyms, parents and children (arrays) united and sorted; the first name by code point."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(F.col(c), F.array().cast("array<string>")))))).alias(c)
    return terms.groupBy("term_id").agg(F.min("name").alias("name"), union("synonyms"), union("parents"), union("children"))


def by_level(nodes: DataFrame) -> DataFrame:
    """``(seed, level, nodes)``: ancestors or descendants grouped by level."""
    return nodes.groupBy("seed", "level").agg(F.array_sort(F.collect_set("node")).alias("nodes"))


def rank_by_depth(nodes: DataFrame) -> DataFrame:
    """Adds ``place``: nearer nodes first, ties by node."""
    return nodes.withColumn("place", F.row_number().over(Window.partitionBy("seed").orderBy("level", "node")))
