from __future__ import annotations

import pytest
from conftest import SF, same

queries = pytest.importorskip("litweft.llm.queries")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    if name in queries.ORACLE:
        same(df, duck.sql(queries.ORACLE[name]))
    else:
        HOLDS[name](df, spark)


def table_(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def one_row_per_document(df, spark):
    docs = {r.doc_id: r.text for r in table_(spark, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in df.collect()}
    assert got.keys() == docs.keys() and df.count() == len(docs)
    return got, docs


def ids_decode(df, spark):
    from litweft.llm import tokens

    got, docs = one_row_per_document(df, spark)
    assert all((got[d].ids == []) == (not t) for d, t in docs.items())
    assert {r.doc_id: r.text for r in tokens.decode(df).collect()} == {d: t or "" for d, t in docs.items()}


def forms_are_fixed(df, spark):
    from litweft.llm.lookalike import Transducer, confusable_letters

    form = Transducer(alike=confusable_letters(spark))
    got, docs = one_row_per_document(df, spark)
    assert all(got[d].canon == form(t) and form(got[d].canon) == got[d].canon for d, t in docs.items())


def looks_alike(df, spark):
    from collections import defaultdict
    from itertools import combinations

    from litweft.llm.lookalike import Transducer, confusable_letters

    form, groups = Transducer(alike=confusable_letters(spark)), defaultdict(list)
    for r in table_(spark, "documents").collect():
        if r.text:
            groups[form(r.text)].append((r.doc_id, r.text))
    pairs = {tuple(sorted((a[0], b[0]))) for g in groups.values() for a, b in combinations(g, 2) if a[1] != b[1]}
    if "doc_id_a" in df.columns:
        assert {tuple(r) for r in df.collect()} == pairs and df.count() == len(pairs)
    else:
        assert sum(r.n_links for r in df.collect()) == 2 * len(pairs) and {r.doc_id for r in df.collect()} == {d for p in pairs for d in p}


def shares_hold(df, spark):
    got = df.collect()
    able = [r for r in got if r.available]
    whole = sum(r.target_share for r in able)
    assert abs(sum(r.share_reached for r in got) - 1) < 1e-9 and all(r.most_uses <= r.max_repeats for r in got)
    # the smallest source bounds the mixture; a source is off by no more than a document's half a language
    total = sum(r.reached for r in got)
    assert all(abs(r.reached - total * r.target_share / whole) < 0.1 * total for r in able) and any(r.reached > 0.8 * r.available * r.max_repeats for r in able)


def uses_are_epochs(df, spark):
    most = {r.source: r.max_repeats for r in table_(spark, "mix_targets").collect()}
    uses = {}
    for r in df.collect():
        uses.setdefault((r.doc_id, r.source), []).append(r.epoch)
    assert uses and all(sorted(e) == list(range(len(e))) and len(e) <= most[s] for (_, s), e in uses.items())


def clusters_are_named_by_their_least(df, spark):
    got = {r.row_id: r.cluster_id for r in df.collect()}
    assert got and all(c <= i and got[c] == c for i, c in got.items())


def pairs_are_ordered(df, spark):
    assert df.count() > 0 and df.where("row_id_a >= row_id_b").count() == 0 and df.count() == df.distinct().count()


HOLDS = {
    "p5_found": pairs_are_ordered, "p5_clusters": clusters_are_named_by_their_least, "p7_ids": ids_decode, "p8_mixture": uses_are_epochs, "p8_shares": shares_hold,
    "p9_found": looks_alike, "p9_classes": looks_alike, "p9_canonical": forms_are_fixed,
}


def test_p5_columns(spark):
    df = queries.QUERIES["p5_found"](spark, SF)
    assert df.dtypes == [("row_id_a", "bigint"), ("row_id_b", "bigint")]
    assert df.where("row_id_a >= row_id_b").count() == 0
