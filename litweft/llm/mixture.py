"""Mixing sources to target weights under repetition caps."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litweft.session import materialise

#: Leaves of the tree are planned on the driver; more than this is refused.
MAX_LEAVES = 200_000
#: Hash ranges of a leaf for the distributed prefix sum.
RANGES = 4096


@dataclass
class Node:
    """A node of the weight tree: leaves have a capacity (size x allowed repeats), inner nodes children."""

    weight: float = 0.0
    capacity: float = 0.0
    children: dict[str, Node] = field(default_factory=dict)


def grow(leaves: list[tuple[tuple[str, ...], tuple[float, ...], float]]) -> Node:
    """Tree of ``(path, weight at each level, capacity)``; a child's weight is relative to its siblings'.

    Paths must have one length and be unique. Weights that differ for one inner node raise.
    """
    root = Node(1.0)
    for path, weights, capacity in leaves:
        at = root
        for name, w in zip(path, weights):
            if w < 0 or capacity < 0:
                raise ValueError("weights and sizes must not be negative")
            nxt = at.children.setdefault(name, Node(w))
            if nxt.weight != w:
                raise ValueError(f"two weights for {name}")
            at = nxt
        if at.children or at.capacity:
            raise ValueError(f"leaf {path} occurs twice")
        at.capacity = capacity

    def total(n: Node) -> float:
        if n.children:
            n.capacity = sum(total(c) for c in n.children.values())
        return n.capacity

    total(root)
    return root


def allocate(root: Node, amount: float) -> dict[tuple[str, ...], float]:
    """Budget of every leaf.

    A node's amount goes to its children by weight. A child that cannot take its part is filled and its
    shortage is shared by the weights of its siblings, again until nothing is left or all are full;
    only what a whole family cannot take remains with the ancestor, whose other families then get it.
    Children of weight 0 get nothing. The result never exceeds a capacity.
    """
    out: dict[tuple[str, ...], float] = {}

    def give(n: Node, amount: float, path: tuple[str, ...]) -> None:
        if not n.children:
            out[path] = min(amount, n.capacity)
            return
        usable = {k: _reach(c) for k, c in n.children.items()}
        share = dict.fromkeys(n.children, 0.0)
        open_ = {k for k, c in n.children.items() if c.weight > 0 and usable[k] > 0}
        left = min(amount, sum(usable[k] for k in open_))
        while open_ and left > 1e-9:
            w = sum(n.children[k].weight for k in open_)
            full = {k for k in open_ if usable[k] - share[k] <= left * n.children[k].weight / w + 1e-9}
            if not full:
                for k in open_:
                    share[k] += left * n.children[k].weight / w
                break
            for k in full:
                left -= usable[k] - share[k]
                share[k] = usable[k]
            open_ -= full
        for k, c in n.children.items():
            give(c, share[k], (*path, k))

    give(root, amount, ())
    return out


def _reach(n: Node) -> float:
    """What a node can take: capacities below children of weight 0 do not count."""
    return sum(_reach(c) for c in n.children.values() if c.weight > 0) if n.children else n.capacity


def feasible(n: Node) -> float:
    """The largest amount of which every child with text takes its full part by weight.

    Children of weight 0 and children without text are left out, as ``allocate`` leaves them out; where no
    child is left it is 0. At this amount or less the shares of those that have text are met exactly.
    """
    if not n.children:
        return n.capacity
    able = [c for c in n.children.values() if c.weight > 0 and _reach(c) > 0]
    whole = sum(c.weight for c in able)
    return min((feasible(c) * whole / c.weight for c in able), default=0.0)


def _tree(sizes: dict[tuple[str, ...], int], weight: dict[tuple[str, ...], float], repeats: dict[tuple[str, ...], int]) -> Node:
    """Tree of the leaves' sizes. ``weight`` maps prefixes of paths; where one is missing, siblings are
    weighted by their size. ``repeats`` is by the longest prefix given, 1 otherwise."""
    below: dict[tuple[str, ...], int] = defaultdict(int)
    for path, n in sizes.items():
        for k in range(1, len(path) + 1):
            below[path[:k]] += n
    reps = lambda path: next((repeats[path[:k]] for k in range(len(path), 0, -1) if path[:k] in repeats), 1)
    return grow([(path, tuple(weight.get(path[:k], float(below[path[:k]])) for k in range(1, len(path) + 1)), float(n * reps(path))) for path, n in sorted(sizes.items())])


def plan(sizes: dict[tuple[str, ...], int], weight: dict[tuple[str, ...], float], repeats: dict[tuple[str, ...], int], total: float | None = None) -> dict[tuple[str, ...], float]:
    """Budgets by leaf, of ``total`` or, if it is None, of the ``feasible`` amount; see ``_tree``."""
    tree = _tree(sizes, weight, repeats)
    return allocate(tree, feasible(tree) if total is None else total)


def mix(docs: DataFrame, size: str, levels: list[str], weights: dict[tuple[str, ...], float], repeats: dict[tuple[str, ...], int], total: int | None = None, seed: int = 7, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, *levels, size, epoch)``: the mixture, one row per use of a document.

    ``levels`` are the columns of the tree from root to leaf (null is a value there, named ''). ``weights``
    maps paths from the root to weights; where it names children of a node, its other children do not take
    part. ``total`` is the wanted size; if None, the largest at which every named node that has text meets
    its share under its cap, so that a source too small for its share bounds the mixture and not the shares.
    Every leaf gives its documents in whole epochs and then a
    prefix of one more epoch, in the order of a hash of (seed, epoch, document): the prefix that comes
    nearest to the budget. A document is used at most as often as ``repeats`` says. Documents of size 0
    or null are used as the order has them and add nothing. Empty input gives no rows.

    The prefix of a leaf is found without bringing the leaf together: hash ranges are summed, the range
    in which the budget ends is known from those few sums, and only that range is ordered.
    """
    spark = docs.sparkSession
    top = sorted({p[0] for p in weights})
    path_cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in levels]
    src = docs.select(*keep, *levels, F.coalesce(F.col(size), F.lit(0)).cast("long").alias(size), F.array(*path_cols).alias("_path"))
    src = src.where(F.col("_path")[0].isin(top)) if top else src.limit(0)
    sizes = {tuple(r["_path"]): r["n"] for r in src.groupBy("_path").agg(F.sum(size).alias("n")).limit(MAX_LEAVES + 1).collect()}
    if len(sizes) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    levelled = {n: {w[:-1] for w in weights if len(w) == n} for n in range(1, len(levels) + 1)}
    sizes = {p: n for p, n in sizes.items() if all(p[:k] in weights for k, parents in levelled.items() if p[: k - 1] in parents)}
    budgets = plan(sizes, weights, repeats, None if total is None else float(total))
    rows = [(list(p), int(budgets[p] // n) if n else 0, float(budgets[p] - (budgets[p] // n) * n) if n else 0.0) for p, n in sizes.items()]
    schema = T.StructType([T.StructField("_path", T.ArrayType(T.StringType())), T.StructField("_whole", T.IntegerType()), T.StructField("_rest", T.DoubleType())])
    leaf = F.broadcast(spark.createDataFrame(rows, schema))  # at most MAX_LEAVES rows, checked above
    placed = src.join(leaf, "_path").withColumn("_h", F.xxhash64(F.lit(seed), F.col("_whole"), *(F.col(k) for k in keep)))
    placed = placed.withColumn("_range", F.shiftrightunsigned("_h", 64 - RANGES.bit_length() + 1).cast("int"))
    sums = placed.groupBy("_path", "_range").agg(F.sum(size).alias("_n"))
    by_leaf = Window.partitionBy("_path").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialise(sums.withColumn("_before", F.coalesce(F.sum("_n").over(by_leaf), F.lit(0))), "ranges")  # leaves x RANGES rows at most
    at = placed.join(sums, ["_path", "_range"])
    inside = (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_n") > F.col("_rest"))
    order = Window.partitionBy("_path", "_range").orderBy("_h", *keep).rowsBetween(Window.unboundedPreceding, -1)
    edge = at.where(inside).withColumn("_b", F.col("_before") + F.coalesce(F.sum(size).over(order), F.lit(0)))
    edge = edge.withColumn("_more", (F.col("_b") + F.col(size) / 2 <= F.col("_rest")).cast("int"))
    plain = at.where(~inside).withColumn("_more", (F.col("_before") + F.col("_n") <= F.col("_rest")).cast("int") * (F.col("_rest") > 0).cast("int"))
    cols = [*keep, *levels, size, "_whole", "_more"]
    used = edge.select(*cols).unionByName(plain.select(*cols)).withColumn("_uses", F.col("_whole") + F.col("_more")).where("_uses > 0")
    return used.select(*keep, *levels, size, F.explode(F.sequence(F.lit(0), F.col("_uses") - 1)).alias("epoch"))


def target_tree(targets: list[tuple[str, float, int]], domain: Callable[[str], str]) -> tuple[dict[tuple[str, ...], float], dict[tuple[str, ...], int]]:
    """Weights and repeats of the tree domain / source, of (source, share, max_repeats): a domain weighs what
    its sources weigh together. Repeated sources raise."""
    weights: dict[tuple[str, ...], float] = {}
    repeats: dict[tuple[str, ...], int] = {}
    for source, share, most in targets:
        path = (domain(source), source)
        if path in weights:
            raise ValueError(f"source {source!r} occurs twice")
        weights[path], repeats[path] = float(share), int(most)
        weights[path[:1]] = weights.get(path[:1], 0.0) + float(share)
    return weights, repeats


def shares(docs: DataFrame, mixture: DataFrame, size: str, source: str, targets: DataFrame, share: str, repeats: str) -> DataFrame:
    """``(source, target_share, max_repeats, available, reached, share_reached, most_uses)`` of every source
    named in ``targets`` (its column ``source``), also of those without a document."""
    have = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("available"))
    got = mixture.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("reached"), (F.max("epoch") + 1).alias("most_uses"))
    # a mixture has as many sources as the targets name
    all_ = Window.partitionBy(F.lit(0))
    t = targets.select("source", F.col(share).alias("target_share"), F.col(repeats).alias("max_repeats"))
    full = t.join(have, "source", "left").join(got, "source", "left").fillna(0, ["available", "reached", "most_uses"])
    return full.withColumn("share_reached", F.col("reached") / F.nullif(F.sum("reached").over(all_), F.lit(0)))
