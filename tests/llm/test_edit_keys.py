"""Candidates of the name join are complete for one edit."""

from __future__ import annotations

import random

from conftest import rows
from pyspark.sql import functions as F

from litweft.llm import names, simjoin


def near(a, b):
    """One edit, or two letters swapped, or one letter moved (same letters, two edits)."""
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1] <= 1 or (d[-1] == 2 and len(a) == len(b) and sorted(a) == sorted(b))


def test_every_pair_one_edit_apart_is_a_candidate(spark):
    rng = random.Random(7)
    keys = {"".join(rng.choice(("ma", "rek", "lo", "tin", "sa", "bor")) for _ in range(rng.choice((2, 3))))[:8] for _ in range(60)}
    for k in sorted(keys):
        i = rng.randrange(len(k) - 1)
        keys |= {k[:i] + k[i + 1] + k[i] + k[i + 2 :], k[:i] + "x" + k[i + 1 :], k[:i] + k[i + 1 :], k[:i] + "y" + k[i:], k[-1] + k[1:-1] + k[0]}
    keys = sorted(keys)
    want = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if near(a, b)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    exact = names._near_sql(F.col("key_a"), F.col("key_b"))
    assert rows(simjoin.edit_keys(df, exact)) == want
    assert len(rows(simjoin.similar_keys(simjoin.vectors(df), 0.33, exact))) < len(want)


def test_swapped_letters_in_a_short_last_name_are_linked(spark):
    data = [(1, "Tomasz", "Marek"), (2, "Tomasz", "Marek"), (3, "Tomasz", "Mraek"), (4, "Tomasz", "Bolnik"), (5, "Joanna", "Mraek")]
    src = spark.createDataFrame(data, "row_id long, firstname string, lastname string")
    short = spark.createDataFrame([], "short_name string, full_name string")
    got = dict(rows(names.link_names(src, short)))
    assert got[3] == got[1] and got[4] != got[1] and got[5] != got[1]


def test_short_last_names_link_on_equal_given_names_and_many_more_rows(spark):
    data = [(i, "Tomasz", "Marek"[:4]) for i in range(10)] + [(20, "Tomasz", "Mark"), (21, "T.", "Marx"), (22, "Joanna", "Mara"), (23, "Piotr", "Lim"), (24, "Piotr", "Lin")]
    src = spark.createDataFrame(data, "row_id long, firstname string, lastname string")
    got = dict(rows(names.link_names(src, spark.createDataFrame([], "short_name string, full_name string"))))
    assert got[20] == got[0] and got[21] != got[0] and got[22] != got[0] and got[23] != got[24]


def test_glued_particles_and_many_persons_of_one_name(spark):
    given = ["Anna", "Berta", "Clara", "Dora", "Emma", "Frida", "Gerda", "Hanna"]
    data = [(i, g, "Vonstolmar") for i, g in enumerate(given)] + [(20 + i, g, "Stolmar") for i, g in enumerate(given)]
    src = spark.createDataFrame(data, "row_id long, firstname string, lastname string")
    got = dict(rows(names.link_names(src, spark.createDataFrame([], "short_name string, full_name string"))))
    assert all(got[i] == got[20 + i] == i for i in range(len(given)))


def test_nearest_partners_only_where_asked(spark):
    keys = spark.createDataFrame([("stolmar",), ("stolmarin",), ("stolmarek",), ("brenk",)], "key string")
    vec = simjoin.vectors(keys)
    every = rows(simjoin.similar_keys(vec, 0.3))
    best = rows(simjoin.similar_keys(vec, 0.3, top=1))
    nearest = {k: max((p for p in every if k in p[:2]), key=lambda p: (p[2], [-ord(c) for c in p[p[0] == k]])) for k in {x for p in every for x in p[:2]}}
    assert best == sorted(set(nearest.values()), key=repr) and len(every) == 3


def test_linkage_with_many_ties_is_the_same_both_ways(spark):
    from litweft.llm import linkage

    rng = random.Random(17)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(400)})
    df = spark.createDataFrame([(a, b, rng.choice([1.0, 0.9, 0.9, 0.8, -1.0])) for a, b in edges], "a long, b long, sim double")
    assert rows(linkage.cluster(df, 0.4)) == rows(linkage.cluster(df, 0.4, local_edges=0))
