from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import rows

from litweft.operators.skew import frequent_candidates, heavy_keys, per_key_summary


def skewed(n=6000, seed=3):
    r = random.Random(seed)
    pick = lambda: r.choice(["hot"] * 6 + ["warm"] * 2 + [None, ""] + [f"k{r.randint(0, 400)}" for _ in range(8)])
    return [(pick(), pick(), r.choice([None, 0, 1, 7])) for _ in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "a string, b string, w int").repartition(7)


def test_candidates_never_miss(spark):
    data = skewed()
    got = {(r.field_name, r.key): r.at_least for r in frequent_candidates(frame(spark, data), ["a", "b"], counters=40).collect()}
    for i, f in enumerate("ab"):
        n = Counter(d[i] for d in data if d[i])
        total = sum(n.values())
        assert {k for k, v in n.items() if v > total / 40} <= {k for g, k in got if g == f}
        assert all(got[f, k] <= n[k] for g, k in got if g == f)
        assert sum(g == f for g, _ in got) <= 40


def test_heavy_keys_exact(spark):
    data = skewed()
    want = [(f, k, v, len(data)) for i, f in enumerate("ab") for k, v in Counter(d[i] for d in data if d[i]).items() if v * 20 >= len(data)]
    assert rows(heavy_keys(frame(spark, data), ["a", "b"], one_in=20)) == sorted(want, key=repr)


def test_heavy_keys_on_the_edge(spark):
    data = [("x", None, 1)] * 2 + [(f"u{i}", None, 1) for i in range(98)]
    assert [r[1] for r in rows(heavy_keys(frame(spark, data), ["a"], one_in=50))] == ["x"]
    with pytest.raises(ValueError):
        heavy_keys(frame(spark, data), ["a"], one_in=50, counters=10)


def test_summary(spark):
    data = skewed()
    n, p, e = Counter(), defaultdict(set), Counter()
    for a, b, w in data:
        if a:
            n[a] += 1
            p[a].update([b] if b else [])
            e[a] += w or 0
    want = [(k, n[k], len(p[k]), e[k]) for k in n]
    assert rows(per_key_summary(frame(spark, data), "a", "b", "w", one_in=20)) == sorted(want, key=repr)


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "a string, b string, w int, family string, _p string")
    assert heavy_keys(df, ["a", "b"], 50).count() == 0
    assert per_key_summary(df, "a", "b", "w").count() == 0
    one = spark.createDataFrame([("x", "y", 1, "z", "q")], "a string, b string, w int, family string, _p string")
    assert rows(per_key_summary(one, "a", "b", "w")) == [("x", 1, 1, 1)]
