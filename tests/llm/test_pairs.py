from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from conftest import rows

pairs = pytest.importorskip("litweft.llm.pairs")


def brute(baskets):
    """kind -> (n, marginals, pairs)"""
    out = defaultdict(lambda: [0, Counter(), Counter()])
    for kind, items in baskets:
        o = out[kind]
        o[0] += 1
        o[1].update(set(items))
        o[2].update(combinations(sorted(set(items)), 2))
    return out


def expect(baskets, min_pair=1, min_lift=0):
    return sorted(
        [(k, a, b, m[a], m[b], ab, n, round(ab * n / (m[a] * m[b]), 6)) for k, (n, m, p) in brute(baskets).items() for (a, b), ab in p.items() if ab >= min_pair and ab * n >= min_lift * m[a] * m[b]],
        key=repr,
    )


def frame(spark, baskets):
    return spark.createDataFrame([(k, str(i), sorted(set(x))) for i, (k, x) in enumerate(baskets)], "kind string, basket string, items array<string>")


def some(r, n):
    return [(r.choice("ab"), [f"i{min(r.randint(0, 30), r.randint(0, 30))}" for _ in range(r.randint(0, 7))]) for _ in range(n)]


def test_counts_equal_brute_force(spark):
    data = some(random.Random(1), 200)
    t = pairs.PairTable(spark).update(frame(spark, data))
    assert rows(t.scores()) == expect(data)
    assert rows(t.scores(min_pair=3, min_lift=2)) == expect(data, 3, 2)


def test_wide_baskets_take_the_spread_way(spark, monkeypatch):
    monkeypatch.setattr(pairs, "WIDE", 3)
    data = some(random.Random(2), 60) + [("a", [f"i{k}" for k in range(11)])] * 2
    assert rows(pairs.PairTable(spark).update(frame(spark, data)).scores()) == expect(data)


def test_incremental_equals_rebuilt(spark):
    r = random.Random(3)
    first, more = some(r, 120), some(r, 40)
    changed = {i: (first[i][0], some(r, 1)[0][1]) for i in r.sample(range(120), 30)}
    t = pairs.PairTable(spark, buckets=5).update(frame(spark, first))
    old = frame(spark, [first[i] for i in changed])
    t.update(frame(spark, [*changed.values(), *more]), old)
    now = [changed.get(i, b) for i, b in enumerate(first)] + more
    assert rows(t.scores()) == expect(now)
    again = pairs.PairTable.open(spark, t.path)
    assert again.buckets == 5 and again.generation == 2 and rows(again.scores()) == expect(now)
    # everything taken back leaves nothing
    t.update(None, frame(spark, now))
    assert rows(t.scores()) == [] and t.read("item").count() == 0


def test_only_touched_buckets_are_rewritten(spark):
    t = pairs.PairTable(spark, buckets=8).update(frame(spark, some(random.Random(4), 100)))
    before = dict(t._where["pair"])
    t.update(frame(spark, [("a", ["new1", "new2"])]))
    changed = {b for b, g in t._where["pair"].items() if before.get(b) != g}
    assert len(changed) == 1


@pytest.mark.parametrize("broken", ["basket", "item", "pair", "manifest"])
def test_crash_at_each_write_then_reopen_and_retry(spark, monkeypatch, broken):
    r = random.Random(8)
    first, more = some(r, 40), some(r, 20)
    path = pairs.PairTable(spark, buckets=4, seed=5).update(frame(spark, first)).path
    t = pairs.PairTable.open(spark, path)
    write, publish = pairs.PairTable._bucketed, pairs.PairTable._publish

    def dies_after(self, name, df, where):
        write(self, name, df, where)
        if name == broken:
            raise RuntimeError("driver lost")
        return {int(b) for b in self._listed(where, "bucket=")}

    def dies(self):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(pairs.PairTable, *(("_publish", dies) if broken == "manifest" else ("_bucketed", dies_after)))
        with pytest.raises(RuntimeError):
            t.update(frame(spark, more))
    assert pairs.PairTable._publish is publish
    again = pairs.PairTable.open(spark, path)
    assert again.generation == 1 and rows(again.scores()) == expect(first)
    assert rows(again.update(frame(spark, more)).scores()) == expect(first + more)
    assert rows(pairs.PairTable.open(spark, path).scores()) == expect(first + more)


def test_table_keeps_its_buckets_and_seed(spark):
    data = some(random.Random(9), 30)
    path = pairs.PairTable(spark, buckets=4, seed=3).update(frame(spark, data)).path
    t = pairs.PairTable.open(spark, path)
    assert (t.buckets, t.seed) == (4, 3)
    assert rows(t.update(frame(spark, data)).scores()) == expect(data + data)
    for odd in ({"buckets": 7}, {"seed": 4}):
        with pytest.raises(ValueError):
            pairs.PairTable.open(spark, path, **odd)


def test_affected_pairs_follow_from_the_delta(spark):
    data = [("a", ["x", "y", "z"]), ("a", ["x", "y"]), ("a", ["u", "v"])]
    t = pairs.PairTable(spark).update(frame(spark, data))
    assert {(r.item_a, r.item_b) for r in t.scores(affected=True).collect()} == {("x", "y"), ("x", "z"), ("y", "z"), ("u", "v")}
    t.update(frame(spark, [("a", ["z", "w"])]))
    t = pairs.PairTable.open(spark, t.path)
    assert rows(t.changed_items()) == [("a", "w", 1), ("a", "z", 1)]
    assert {(r.item_a, r.item_b) for r in t.scores(affected=True).collect()} == {("x", "z"), ("y", "z"), ("w", "z")}


def test_affected_pairs_only(spark):
    data = [("a", ["x", "y", "z"]), ("a", ["x", "y"]), ("a", ["u", "v"])]
    t = pairs.PairTable(spark).update(frame(spark, data))
    only = spark.createDataFrame([("a", "y")], "kind string, item string")
    assert {(r.item_a, r.item_b) for r in t.scores(only=only).collect()} == {("x", "y"), ("y", "z")}


def test_failed_update_keeps_the_former_state(spark):
    data = some(random.Random(5), 30)
    t = pairs.PairTable(spark).update(frame(spark, data))
    bad = spark.createDataFrame([("a", [1])], "kind string, items array<int>").selectExpr("kind", "transform(items, x -> raise_error('broken')) as items")
    with pytest.raises(Exception):  # noqa: B017
        t.update(bad)
    assert rows(t.scores()) == expect(data)
    with pytest.raises(ValueError):
        t.update(None)


def test_baskets_from_rows(spark):
    df = spark.createDataFrame([("d", "x", 1), ("d", "x", 2), ("d", "", 3), ("d", None, 4), (None, "x", 5), ("", "x", 6), ("e", "y", 7)], "doc string, c string, items int")
    assert rows(pairs.baskets(df, "k", "doc", "c")) == [("k", "d", ("x",)), ("k", "e", ("y",))]
    mx = spark.createDataFrame([("m", "g", None, 1), ("m", "g", None, 1), ("m", "g", "", 1), ("m", "", "u", 1), (None, "g", "u", 1), ("m", "m", "u", 2)], "m string, g string, i string, c int")
    assert [r[2] for r in rows(pairs.row_baskets(mx, "k", ["m", "g", "i", "c"], ["m", "g"]))] == [("g", "m"), ("g", "m"), ("m",)]


def test_empty(spark):
    t = pairs.PairTable(spark).update(frame(spark, []))
    assert t.scores().count() == 0
