from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import rows

topn = pytest.importorskip("litweft.llm.topn")
terms = pytest.importorskip("litweft.llm.terms")


def brute(data, n):
    best = defaultdict(dict)
    for g, i, s in data:
        if g and i and s is not None:
            best[g][i] = max(best[g].get(i, s), s)
    return sorted([(g, p + 1, i, s) for g, d in best.items() for p, (i, s) in enumerate(sorted(d.items(), key=lambda x: (-x[1], x[0]))[:n])], key=repr)


def random_rows(seed, n=4000):
    r = random.Random(seed)
    return [(r.choice(["hot", "hot", "g1", "g2", "ä", None, ""]), r.choice([None, "", *(f"i{k}" for k in range(200)), "é", "z", "Z"]), r.choice([None, -1, 0, 1, 2, 3])) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 5])
def test_top_n(spark, n):
    data = random_rows(n)
    df = spark.createDataFrame(data, "g string, i string, s int").repartition(6)
    assert rows(topn.top_n(df, "g", "i", "s", n)) == brute(data, n)


def test_heaps_handed_on_early(spark, monkeypatch):
    run = topn._local_heaps(2)
    import pyarrow as pa

    monkeypatch.setattr(topn, "HELD", 0)
    b = pa.RecordBatch.from_pydict({"grp": ["a"] * 4, "item": list("wxyz"), "score": [1, 2, 3, 4]})
    assert sum(x.num_rows for x in run(iter([b, b]))) >= 2


def test_heaps_come_before_the_only_exchange(spark):
    df = spark.range(1000).selectExpr("'g' as g", "cast(id as string) as i", "id as s").repartition(8)
    plan = topn.top_n(df, "g", "i", "s", 3)._jdf.queryExecution().optimizedPlan().toString()
    heaps, exchanges = plan.count("MapInArrow"), plan.count("RepartitionByExpression [grp")
    assert (heaps, exchanges) == (2, 1) and "Aggregate" not in plan


def test_groups_across_batches(spark):
    data = [(f"g{k % 50:02d}", f"i{k % 977:04d}", k * 7919 % 101) for k in range(5000)]
    df = spark.createDataFrame(data, "g string, i string, s int").repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(topn.top_n(df, "g", "i", "s", 4)) == brute(data, 4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_top_n_empty_and_clash(spark):
    df = spark.createDataFrame([], "g string, i string, s int, grp string, item string, score int, place int")
    assert topn.top_n(df, "g", "i", "s", 3).count() == 0
    one = spark.createDataFrame([("a", "b", 1, "x", "y", 9, 9)], df.schema)
    assert rows(topn.top_n(one, "g", "i", "s", 3)) == [("a", 1, "b", 1)]


def test_terms_equal_brute_force(spark):
    r = random.Random(7)
    data = [(f"d{min(r.randint(0, 80), r.randint(0, 80))}", r.choice(["hot"] * 5 + [None, ""] + [f"t{k}" for k in range(60)])) for _ in range(1500)]
    df = spark.createDataFrame(data, "doc string, val string").repartition(5)
    out = terms.mark_terms(terms.term_rows(df, terms.record_key("doc"), ["val"]))
    docs = defaultdict(set)
    for d, v in data:
        if v:
            docs[v].add(d)
    n = len(set().union(*docs.values()))
    occ = Counter(v for _, v in data if v)
    want = [("val", v, occ[v], len(s), n, "rare" if len(s) < 3 else "common" if len(s) * 20 > n else None) for v, s in docs.items()]
    got = [(x.field_name, x.val, x.occurrences, x.records, x.n_records, x.mark) for x in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_record_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("a", ""), ("1:a", ""), (None, "a")], "x string, y string")
    assert df.select(terms.record_key("x", "y")).distinct().count() == 5


def test_terms_empty(spark):
    df = spark.createDataFrame([(None, None)], "doc string, val string")
    assert terms.mark_terms(terms.term_rows(df, terms.record_key("doc"), ["val"])).count() == 0
