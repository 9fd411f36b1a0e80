"""Items that appear together: an incremental table of pair counts and its association scores."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.session import materialise, temporary_root

#: Baskets with more items than this are cut into blocks of so many, and every two blocks meet in a task of their own.
WIDE = 256


def _record(columns: list[str]) -> Column:
    """One string per distinct value of ``columns``; null and '' are values and told apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("~")) for c in columns]
    return F.concat(*parts)


def baskets(df: DataFrame, kind: str, record: str, item: str) -> DataFrame:
    """``(kind, basket, items)``: the sorted distinct items of every record.

    Nulls and '' are neither records nor items; records without an item make no basket. Repeated rows
    count once, extra columns are not read. Items are collected as sets, combined map-side, so a record
    with a third of all rows sends its distinct items only.
    """
    src = df.select(F.col(record).cast("string").alias("basket"), F.col(item).cast("string").alias("item"))
    src = src.where("basket is not null and basket <> '' and item is not null and item <> ''")
    return src.groupBy("basket").agg(F.sort_array(F.collect_set("item")).alias("items")).select(F.lit(kind).alias("kind"), "basket", "items")


def row_baskets(df: DataFrame, kind: str, record: list[str], items: list[str]) -> DataFrame:
    """``(kind, basket, items)`` where every row names its items in columns of their own.

    Rows that lack one of the items make no basket; repeated records count once.
    """
    src = df.where(" and ".join(f"`{c}` is not null and `{c}` <> ''" for c in items))
    packed = F.sort_array(F.array_distinct(F.array(*(F.col(c).cast("string") for c in items))))
    return src.select(_record(record).alias("basket"), packed.alias("items")).distinct().select(F.lit(kind).alias("kind"), "basket", "items")


class PairTable:
    """Persistent counts of items and pairs, updated by signed deltas of changed baskets.

    The state is a folder of the tables ``item`` (kind, code, item, n), ``pair`` (a, b, n) and
    ``basket`` (kind, n), each hash-partitioned into ``buckets`` buckets. Inside the pair table an item
    is a 64-bit code of (kind, item), so a pair takes 16 bytes however long its items are. Codes are
    checked to be unique at every update; a collision raises rather than merging two items.

    ``update`` turns changed baskets into deltas (+1 for the items and pairs they have now, -1 for
    those they had), sums them, and rewrites only the buckets that the deltas touch. Every attempt writes into a folder
    of its own, and the manifest (bucket count, seed, where each bucket lies, the last delta of the items) is renamed
    into place at the end. So an update that fails or whose driver dies leaves the former state valid, and its
    leftovers meet nothing that is written later. Nothing is kept on executors: the state is Parquet in
    shared storage. A table has one writer at a time.

    The buckets are those of the aggregation's own exchange, so writing them needs no second shuffle.
    """

    SCHEMA = {"item": "kind string, code long, item string, n long", "pair": "a long, b long, n long", "basket": "kind string, n long"}
    KEY = {"item": ["code", "kind", "item"], "pair": ["a", "b"], "basket": ["kind"]}

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, seed: int = 11):
        self.spark, self.seed = spark, seed
        self.path = (path or f"{temporary_root(spark)}/pairs-{uuid.uuid4().hex}").rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        self.generation = 0
        self._where: dict[str, dict[int, str]] = {"item": {}, "pair": {}, "basket": {}}
        self._changed: list[str] = []

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None, seed: int | None = None) -> PairTable:
        """The table at ``path`` as of its last complete update; bucket count and seed are the table's own.

        Naming others raises. Where no update was ever completed, the table is new.
        """
        t = cls(spark, path, buckets, 11 if seed is None else seed)
        gens = [int(g.removesuffix(".json")) for g in t._listed(f"{t.path}/manifest", "gen=") if g.endswith(".json")]
        if gens:
            t.generation = max(gens)
            state = json.loads(spark.read.text(t._manifest(t.generation), wholetext=True).first()[0])
            for name, asked in (("buckets", buckets), ("seed", seed)):
                if asked not in (None, state[name]):
                    raise ValueError(f"the table has {name} {state[name]}, not {asked}")
            t.buckets, t.seed, t._changed = state["buckets"], state["seed"], state["changed"]
            t._where = {n: {int(b): g for b, g in w.items()} for n, w in state["where"].items()}
        return t

    def _manifest(self, generation: int) -> str:
        return f"{self.path}/manifest/gen={generation}.json"

    def _publish(self) -> None:
        """Write the manifest beside its place and rename it there."""
        state = {"buckets": self.buckets, "seed": self.seed, "where": self._where, "changed": self._changed}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        place, draft = path(self._manifest(self.generation)), path(f"{self.path}/manifest/draft-{uuid.uuid4().hex}")
        fs = draft.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(place) or not fs.rename(draft, place):
            raise RuntimeError(f"another writer has completed generation {self.generation} of {self.path}")

    # -- deltas -----------------------------------------------------------------------------------
    def _code(self, item: Column) -> Column:
        return F.xxhash64(F.col("kind"), item, F.lit(self.seed))

    def _marginals(self, signed: DataFrame) -> DataFrame:
        long = signed.select("kind", "sign", F.explode("items").alias("item"))
        return long.groupBy(self._code(F.col("item")).alias("code"), "kind", "item").agg(F.sum("sign").alias("n"))

    def _pairs(self, signed: DataFrame) -> DataFrame:
        coded = signed.where("size(items) > 1").select("b", "sign", F.transform("items", self._code).alias("codes"))
        narrow = coded.where(f"size(codes) <= {WIDE}").select("sign", F.col("codes").alias("left"), F.lit(None).cast("array<long>").alias("right"))
        cells = narrow.unionByName(self._cells(coded.where(f"size(codes) > {WIDE}")))
        # within one block every item meets those after it, of two blocks every item of one meets all of the other
        one = cells.select("sign", "left", "right", F.posexplode("left").alias("i", "x"))
        mates = F.coalesce("right", F.slice("left", F.col("i") + 2, F.size("left")))
        both = one.select("sign", "x", F.explode(mates).alias("y"))
        return both.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("sign").alias("n"))

    @staticmethod
    def _cells(wide: DataFrame) -> DataFrame:
        """``(sign, left, right)``: every two blocks of a wide basket in a row of their own; one block with itself has
        no right. A block travels alone to its cells, so no row is larger than two blocks."""
        n = F.ceil(F.size("codes") / WIDE).cast("int")
        parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice("codes", i * WIDE + 1, WIDE))
        block = wide.select("b", "sign", n.alias("n"), F.posexplode(parts).alias("i", "block"))
        spread = block.select("b", "sign", "i", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
        cell = [F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi")]
        met = spread.groupBy("b", "sign", *cell).agg(F.sort_array(F.collect_list(F.struct("i", "block"))).alias("two"))
        return met.select("sign", F.col("two")[0]["block"].alias("left"), F.get("two", F.lit(1))["block"].alias("right"))

    # -- state ------------------------------------------------------------------------------------
    def read(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        """The current rows of ``item``, ``pair`` or ``basket`` (of some buckets only)."""
        where = {b: g for b, g in self._where[name].items() if buckets is None or b in buckets}
        return self._rows(name, [f"{self.path}/{name}/{g}/bucket={b}" for b, g in sorted(where.items())])

    def _rows(self, name: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA[name])
        return self.spark.read.schema(self.SCHEMA[name]).parquet(*paths)

    def _bucketed(self, name: str, df: DataFrame, path: str) -> set[int]:
        bucket = F.pmod(F.hash(*self.KEY[name]), F.lit(self.buckets))
        df.where("n <> 0").withColumn("bucket", bucket).write.partitionBy("bucket").parquet(path)
        return {int(b) for b in self._listed(path, "bucket=")}

    def _merge(self, name: str, delta: DataFrame, attempt: str) -> list[str]:
        """Merge a delta into the touched buckets; the paths of the delta (of the new rows in the first load)."""
        key, path, touched = self.KEY[name], f"{self.path}/{name}/{attempt}", set()
        if self._where[name]:
            waiting = f"{self.path}/delta-{name}/{attempt}"
            touched = self._bucketed(name, delta, waiting)  # at most `buckets` numbers
            if not touched:
                return []
            delta = self._rows(name, [f"{waiting}/bucket={b}" for b in sorted(touched)])
            merged = self.read(name, touched).unionByName(delta).groupBy(*key).agg(F.sum("n").alias("n"))
        else:
            merged, waiting = delta, path
        left = self._bucketed(name, merged, path)
        self._where[name].update({b: attempt for b in left})
        for b in touched - left:
            self._where[name].pop(b, None)
        return [f"{waiting}/bucket={b}" for b in sorted(touched or left)]

    def _listed(self, path: str, prefix: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def update(self, new: DataFrame | None, old: DataFrame | None = None) -> PairTable:
        """Merge changed baskets: ``new`` as they are now, ``old`` as they were (None: none such).

        A basket in both with the same items cancels out; empty baskets count as records only.
        """
        parts = [d.select("kind", "items", F.lit(s).alias("sign")) for d, s in ((new, 1), (old, -1)) if d is not None]
        if not parts:
            raise ValueError("neither old nor new baskets")
        # read three times: written once, in shared storage, with a number for every basket
        signed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        signed = materialise(signed.withColumn("b", F.monotonically_increasing_id()), "baskets")
        before = self.generation, {k: dict(v) for k, v in self._where.items()}, self._changed
        self.generation += 1
        attempt = f"gen={self.generation}-{uuid.uuid4().hex[:12]}"
        try:
            self._merge("basket", signed.groupBy("kind").agg(F.sum("sign").alias("n")), attempt)
            self._changed = self._merge("item", self._marginals(signed), attempt)
            self._merge("pair", self._pairs(signed), attempt)
            if not self._clashes().isEmpty():
                raise ValueError("two items share a code; build the table with another seed")
            self._publish()
        except Exception:
            self.generation, self._where, self._changed = before
            raise
        return self

    def _clashes(self) -> DataFrame:
        """Codes of two items, among the codes that the update touched."""
        items = self.read("item").select("code")
        if self.generation > 1:
            items = items.join(self._rows("item", self._changed).select("code").distinct(), "code", "left_semi")
        return items.groupBy("code").agg(F.count("*").alias("n")).where("n > 1")

    def changed_items(self) -> DataFrame:
        """``(kind, item, n)``: the items whose records changed in the last update, with the signed change."""
        return self._rows("item", self._changed).select("kind", "item", "n")

    # -- scores -----------------------------------------------------------------------------------
    def scores(self, min_pair: int = 1, min_lift: int = 0, only: DataFrame | None = None, affected: bool = False) -> DataFrame:
        """``(kind, item_a, item_b, n_a, n_b, n_ab, n_records, lift)`` with item_a < item_b by code point.

        ``lift`` is n_ab * n_records / (n_a * n_b), the ratio to chance; the threshold is decided in
        exact decimals. ``only`` (kind, item) restricts to the pairs of these items, ``affected`` to those of
        the items that the last update changed: all pairs whose counts differ from before (a changed number of
        records scales every lift of its kind alike, so it is no change of the pair). Pairs meet
        their items by a join on the code, broadcast only if the item table is under the session's
        threshold; the filter on the count reaches the scan.
        """
        items = self.read("item")
        pairs = self.read("pair").where(F.col("n") >= min_pair)
        if affected:
            only = self.changed_items()
        if only is not None:
            hit = only.select(self._code(F.col("item")).alias("code")).distinct()
            a, b = hit.withColumnRenamed("code", "a"), hit.withColumnRenamed("code", "b")
            pairs = pairs.join(a, "a", "left_semi").unionByName(pairs.join(b, "b", "left_semi").join(a, "a", "left_anti"))
        side_a = items.select(F.col("code").alias("a"), "kind", F.col("item").alias("ia"), F.col("n").alias("na"))
        side_b = items.select(F.col("code").alias("b"), F.col("item").alias("ib"), F.col("n").alias("nb"))
        total = self.read("basket").withColumnRenamed("n", "n_records")  # one row per kind
        full = pairs.join(side_a, "a").join(side_b, "b").join(F.broadcast(total), "kind")
        wide = lambda c: F.col(c).cast("decimal(18,0)")
        kept = full.where(wide("n") * wide("n_records") >= F.lit(min_lift).cast("decimal(2,0)") * (wide("na") * wide("nb"))) if min_lift else full
        swap = F.col("ia") > F.col("ib")
        either = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
        return kept.select(
            "kind", either("ia", "ib").alias("item_a"), either("ib", "ia").alias("item_b"),
            either("na", "nb").alias("n_a"), either("nb", "na").alias("n_b"), F.col("n").alias("n_ab"), "n_records",
            (F.col("n") * F.col("n_records").cast("double") / (F.col("na") * F.col("nb").cast("double"))).alias("lift"),
        )
