"""Sparse cosine similarity join over weighted character n-grams, and components of its links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litweft.session import materialise

#: Keys of one n-gram that meet in one group; longer posting lists are split into as many blocks as needed.
POSTINGS = 1000


def grams(key: Column, n: int) -> Column:
    """Distinct n-grams of ``^key$``."""
    padded = F.concat(F.lit("^"), key, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n))))


def vectors(keys: DataFrame, n: int = 3) -> DataFrame:
    """``(key, v array<df, gram, w>, norm)`` of the distinct non-null strings in column ``key``, written to shared storage.

    A gram weighs -ln(share of the keys that have it + 0.001), at least 0.1 (the share is taken of 1000
    keys where there are fewer), so weights mean the same at every size. Grams are ordered from rare to common.
    """
    total = keys.agg(F.count("*").alias("_all"))  # one row
    posted = keys.select("key", F.explode(grams(F.col("key"), n)).alias("gram"))
    df = posted.groupBy("gram").agg(F.count("*").alias("df"))
    weight = F.greatest(-F.log(F.col("df") / F.greatest(F.col("_all"), F.lit(1000)) + 0.001), F.lit(0.1))
    weighed = posted.join(df.crossJoin(F.broadcast(total)).select("gram", "df", weight.alias("w")), "gram")
    vec = weighed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("v"))
    return materialise(vec.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))), "vectors")


def cosines(pairs: DataFrame, vec: DataFrame) -> DataFrame:
    """``(key_a, key_b, cosine)`` of given pairs of keys of ``vec``."""
    va, vb = (vec.select(F.col("key").alias(f"key_{s}"), F.col("v").alias(f"v{s}"), F.col("norm").alias(f"n{s}")) for s in "ab")
    common = F.filter("va", lambda x: F.exists("vb", lambda y: y["gram"] == x["gram"]))
    cosine = F.aggregate(common, F.lit(0.0), lambda s, x: s + x["w"] * x["w"]) / (F.col("na") * F.col("nb"))
    return pairs.select("key_a", "key_b").join(va, "key_a").join(vb, "key_b").select("key_a", "key_b", F.least(cosine, F.lit(1.0)).alias("cosine"))


def similar_keys(vec: DataFrame, threshold: float, exact: Column | None = None, top: int | None = None) -> DataFrame:
    """``(key_a, key_b, cosine)``, key_a < key_b: keys whose ``vectors`` reach ``threshold``.

    ``exact`` is an optional further condition on key_a and key_b, evaluated inside the join. ``top`` keeps
    the pairs that are among the ``top`` nearest of either key (ties by key); None, the default, sets no cap on partners.

    Prefix filter, without loss: only those grams are indexed, rare ones first, whose removal would leave less
    than the threshold's length; two keys that reach the threshold share an indexed gram. Posting lists of over
    POSTINGS keys are split into blocks that meet pairwise, so no gram, however common, makes one long task.
    """
    # squared length that remains from each position on; a gram is indexed while that reaches the threshold
    rest = F.transform(F.sequence(F.lit(1), F.size("v")), lambda i: F.aggregate(F.slice("v", i, F.size("v")), F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
    cut = (F.lit(threshold) * F.col("norm")) ** 2 * 0.999999
    index = vec.select("key", F.explode(F.slice("v", F.lit(1), F.size(F.filter(rest, lambda r: r >= cut)))).alias("g"))
    index = index.select("key", "g.gram", F.ceil(F.col("g.df") / POSTINGS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    a = index.select("gram", F.col("key").alias("key_a"), block.alias("block"))
    b = index.select("gram", F.col("key").alias("key_b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    near = a.join(b, ["gram", "block"]).where("key_a < key_b")
    if exact is not None:
        near = near.where(exact)
    out = cosines(near.select("key_a", "key_b").distinct(), vec).where(F.col("cosine") >= threshold)
    if top is None:
        return out
    both = out.select("key_a", "key_b", "cosine", F.col("key_a").alias("k"), F.col("key_b").alias("o"))
    both = both.unionByName(out.select("key_a", "key_b", "cosine", F.col("key_b").alias("k"), F.col("key_a").alias("o")))
    order = Window.partitionBy("k").orderBy(F.desc("cosine"), "o")
    return both.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top).select("key_a", "key_b", "cosine").distinct()


def edit_keys(keys: DataFrame, exact: Column, also: Column | None = None) -> DataFrame:
    """``(key_a, key_b)``, key_a < key_b: distinct keys that share a deletion or their letters and fulfil ``exact``.

    Complete for one edit and for two letters swapped: keys one edit apart, or with two neighbours swapped, have a form
    in common when each may lose one letter (or none); keys with any two letters swapped have the same letters. Every
    key enters with its length + 2 forms, so the join grows with the number of keys. ``also`` is an array of further
    forms of a key (null ones are none).
    """
    key = F.col("key")
    cut = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, F.length(key))))
    letters = F.concat(F.lit("\n"), F.array_join(F.array_sort(F.split(key, "")), ""))
    forms = F.concat(cut, F.array(key, letters))
    forms = forms if also is None else F.concat(forms, F.filter(also, lambda x: x.isNotNull()))
    posted = materialise(keys.where("key <> ''").select("key", F.explode(F.array_distinct(forms)).alias("form")), "deletions")
    a, b = posted.select("form", F.col("key").alias("key_a")), posted.select("form", F.col("key").alias("key_b"))
    return a.join(b, "form").where("key_a < key_b").where(exact).select("key_a", "key_b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every id in ``edges`` (a, b longs); a component is named by its smallest id.

    Alternating star contraction: every round is two aggregations over the edges, written to shared
    storage; the number of rounds grows with the logarithm of a component's size. Nothing is collected.
    """
    links = materialise(edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u <> v").distinct(), "cc")
    for _ in range(max_rounds):
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: what is not larger goes to the smallest
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        nxt = materialise(small, "cc")
        # settled when every id has one smaller neighbour that has none itself
        open_ = nxt.groupBy("u").count().where("count > 1").limit(1).unionByName(nxt.join(nxt.select(F.col("u").alias("v")), "v", "left_semi").select("u", F.lit(1).cast("long").alias("count")).limit(1))
        links = nxt
        if open_.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
