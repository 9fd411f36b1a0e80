from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from conftest import rows

names = pytest.importorskip("litweft.llm.names")
simjoin = pytest.importorskip("litweft.llm.simjoin")
linkage = pytest.importorskip("litweft.llm.linkage")

SHORT = [("Bob", "Robert"), ("Kati", "Katharina")]


def test_similar_keys_equal_brute_force(spark):
    r = random.Random(1)
    keys = sorted({"".join(r.choice(["fla", "gri", "mo", "stu", "ka"]) for _ in range(r.randint(1, 4))) for _ in range(150)})
    grams = {k: {f"^{k}$"[i : i + 3] for i in range(max(len(k), 1))} for k in keys}
    df = Counter(g for s in grams.values() for g in s)
    w = {g: max(-math.log(n / 1000 + 0.001), 0.1) for g, n in df.items()}
    norm = {k: math.sqrt(sum(w[g] ** 2 for g in s)) for k, s in grams.items()}
    want = {(a, b) for a, b in combinations(keys, 2) if sum(w[g] ** 2 for g in grams[a] & grams[b]) / norm[a] / norm[b] >= 0.6}
    got = simjoin.similar_keys(simjoin.vectors(spark.createDataFrame([(k,) for k in keys], "key string")), 0.6)
    assert {(r_.key_a, r_.key_b) for r_ in got.collect()} == want


def test_split_posting_lists_lose_nothing(spark, monkeypatch):
    keys = spark.createDataFrame([(f"common{i:03d}",) for i in range(60)], "key string")
    a = rows(simjoin.similar_keys(simjoin.vectors(keys), 0.1).select("key_a", "key_b"))
    monkeypatch.setattr(simjoin, "POSTINGS", 5)
    assert rows(simjoin.similar_keys(simjoin.vectors(keys), 0.1).select("key_a", "key_b")) == a


def test_components_equal_union_find(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 120), r.randint(0, 120)) for _ in range(80)] + [(i, i + 1) for i in range(200, 240)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = simjoin.components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(tuple(x) for x in got.collect()) == want


def test_linkage_local_equals_rounds(spark):
    r = random.Random(3)
    edges = sorted({tuple(sorted(r.sample(range(40), 2))) for _ in range(160)})
    sims = [(a, b, round(r.random(), 6)) for a, b in edges]
    df = spark.createDataFrame(sims, "a long, b long, sim double")
    assert rows(linkage.cluster(df, 0.3)) == rows(linkage.cluster(df, 0.3, local_edges=0))


def test_linkage_by_hand():
    assert linkage.average_linkage([(1, 2, 0.9), (2, 3, 0.9)], 0.5) == {1: 1, 2: 1, 3: 3}
    assert linkage.average_linkage([(1, 2, 0.9), (2, 3, 0.9), (1, 3, 0.4)], 0.5) == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize(
    ("first", "last", "kind", "given", "sur"),
    [
        ("Bob", "Müller", "p", ["bob"], ["muller"]), ("B.", "Müller", "p", ["b."], ["muller"]), ("BK", "Müller", "p", ["b.", "k."], ["muller"]), ("DE", "Müller", "p", ["d.", "e."], ["muller"]),
        ("Dr. Bob", "Müller, MD", "p", ["bob"], ["muller"]), (None, "Müller, Bob", "p", ["bob"], ["muller"]), ("Müller", "B.", "p", ["b."], ["muller"]), ("von Fluvo", "Bob", "p", ["bob"], ["fluvo"]),
        ("Bob", "von der Fluvo-Kremo", "p", ["bob"], ["fluvokremo"]), ("", "", "", [], []), (None, " .,", "", [], []), ("", "Fluvo", "p", [], ["fluvo"]),
        ("", "Univ. Hosp. Fluvo", "o", [], ["fluvo"]), (None, "The Fluvo-Genome-Initiative", "o", [], ["fluvo"]), (None, "University Hosptial Fluvo", "o", [], ["fluvo"]),
    ],
)
def test_parse(first, last, kind, given, sur):
    p = names.parse(first, last)
    assert (p["kind"], p["given"], p["sur"]) == (kind, given, sur)


def link(spark, spellings):
    df = spark.createDataFrame([(i, f, g) for i, (f, g) in enumerate(spellings)], "row_id long, firstname string, lastname string")
    out = names.link_names(df, spark.createDataFrame(SHORT, "short_name string, full_name string"))
    groups = defaultdict(set)
    for r in out.collect():
        groups[r.cluster].add(spellings[r.id])
    return sorted((frozenset(g) for g in groups.values()), key=sorted_key)


def sorted_key(g):
    return sorted(map(repr, g))


def test_variants_link_and_others_do_not(spark):
    robert = [("Robert", "Stakrene")] * 3 + [("Bob", "Stakrene"), ("R.", "Stakrene"), ("ROBERT", "STAKRENE"), ("Stakrene", "Robert"), (None, "Stakrene, R."), ("Robert", "Stakreme"), ("", "Stakrene")]
    others = [("Ulrike", "Stakxrene"), ("Katharina", "Brolimu"), ("Kati", "Brolimu"), ("Theodora", "Brolimu"), ("Robert", "Vluplivleta"), ("Katharina", "Ginobrepru"), ("Theodora", "Kestogro")]
    orgs = [(None, "Institute of Fluvo Research"), ("", "Fluvo Research Institute"), ("", "INST OF FLUVO RES"), (None, "University Hospital Fluvo")]
    got = link(spark, robert + others + orgs)
    assert frozenset(robert) in got
    assert frozenset({("Katharina", "Brolimu"), ("Kati", "Brolimu")}) in got
    assert frozenset(orgs[:3]) in got and frozenset(orgs[3:]) in got
    assert frozenset({("Theodora", "Brolimu")}) in got and frozenset({("Ulrike", "Stakxrene")}) in got


def test_ambiguous_initial_joins_nobody(spark):
    got = link(spark, [("Theodora", "Brolimu"), ("Tomas", "Brolimu"), ("T.", "Brolimu"), ("", "Brolimu")])
    assert all(len(g) == 1 for g in got)


def test_contradicting_initials_stay_apart(spark):
    got = link(spark, [("Robert H.", "Brolimu")] * 2 + [("Robert K.", "Brolimu"), ("R. H.", "Brolimu"), ("R.K.", "Brolimu")])
    assert sorted(map(sorted, got)) == [[("R. H.", "Brolimu"), ("Robert H.", "Brolimu")], [("R.K.", "Brolimu"), ("Robert K.", "Brolimu")]]


def test_chain_of_misspellings(spark):
    chain = [("Farida", "Guschotapri"), ("Farida", "Guschotypri"), ("Farida", "Guschoapri")]
    assert link(spark, chain) == [frozenset(chain)]


def test_nobody_and_empty(spark):
    assert link(spark, [("", ""), (None, None), ("", None)]) == []
    empty = spark.createDataFrame([], "row_id long, firstname string, lastname string")
    short = spark.createDataFrame(SHORT, "short_name string, full_name string")
    links = names.link_names(empty, short)
    assert links.count() == 0 and names.linked_pairs(links).count() == 0


def test_null_and_empty_are_two_spellings(spark):
    assert link(spark, [(None, "Fluvokre"), ("", "Fluvokre")]) == [frozenset({(None, "Fluvokre"), ("", "Fluvokre")})]


def test_pairs(spark):
    links = spark.createDataFrame([(1, 1), (4, 1), (2, 1), (3, 3)], "id long, cluster long")
    assert rows(names.linked_pairs(links)) == [(1, 2), (1, 4), (2, 4)]
