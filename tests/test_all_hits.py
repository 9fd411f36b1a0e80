"""The queries over all accepted hits equal brute force."""

from __future__ import annotations

import re

import pytest
from conftest import rows

from litweft.functions.text import BOUNDARY, COLLAPSED
from litweft.plans import text as plans

TEXTS = ["Binding-site EXPRESSION in Cells", "RT PCR of luciferase REPORTERS, down regulates binding site.", "the expression of cells", "no entity here", "Target CELL target"]


def brute(text):
    """(dict_id, syn, start, end) by a regular expression per synonym: separators as one run, any case above four letters."""
    cls = "[" + re.escape(COLLAPSED) + " ]"
    edge = "[" + re.escape(BOUNDARY) + "]"
    out = set()
    for d, _, syn in plans.LEXICON:
        pattern = cls.join(re.escape(w) for w in re.split(cls, syn))
        for m in re.finditer(rf"(?:(?<=^)|(?<={edge})){pattern}(?={edge}|$)", text, re.I):
            if len(syn) > 4 or m.group() == syn:
                out.add((d, syn, m.start(), m.end()))
    return out


@pytest.fixture
def sents(spark, monkeypatch):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "sent_id string, text string")
    monkeypatch.setattr(plans, "sents", lambda *_: df)


def test_all_hits(spark, sents):
    got = plans.all_hits(spark, "")
    assert rows(got.select("sent_id", "dict_id", "syn", "start", "end")) == sorted(((str(i), *h) for i, t in enumerate(TEXTS) for h in brute(t)), key=repr)
    assert got.where("not exact").count() > 0 and got.where("syn = 'RT-PCR'").count() == 1


def test_all_pairs(spark, sents):
    want = []
    for i, t in enumerate(TEXTS):
        hits = brute(t)
        want += [(str(i), a[1], a[2], b[1], b[2]) for a in hits for b in hits if a[0] == 1 and b[0] == 2 and a[1] != b[1] and not (a[2] <= b[3] and b[2] <= a[3])]
    got = rows(plans.all_pairs(spark, "").select("sent_id", "syn_a", "start_a", "syn_b", "start_b"))
    assert got == sorted(want, key=repr) and any(r[0] == "0" for r in got)


def test_longest_of_all_hits(spark, sents):
    want = set()
    for i, t in enumerate(TEXTS):
        hits = brute(t)
        want |= {(str(i), *h) for h in hits if h[3] == max(x[3] for x in hits if x[0] == h[0] and x[2] == h[2])}
    assert rows(plans.all_longest(spark, "").select("sent_id", "dict_id", "syn", "start", "end")) == sorted(want, key=repr)


def test_blocked_words_among_all_hits(spark, sents):
    want = []
    for i, t in enumerate(TEXTS):
        blocked = {m.start() for w in plans.SUBMATCH for m in re.finditer(rf"(?<![^\W_]){w}(?![^\W_])", t, re.I)}
        want += [(str(i), *h) for h in brute(t) if h[2] not in blocked]
    got = rows(plans.all_submatch_excluded(spark, "").select("sent_id", "dict_id", "syn", "start", "end"))
    assert got == sorted(want, key=repr) and len(got) < sum(len(brute(t)) for t in TEXTS)


def test_first_pair_tagged(spark, sents):
    want = []
    for i, t in enumerate(TEXTS):
        ps = [(a[2], b[2], a, b) for a in brute(t) for b in brute(t) if a[0] == 1 and b[0] == 2 and a[1] != b[1] and not (a[2] <= b[3] and b[2] <= a[3])]
        for names in {(a[1], b[1]) for _, _, a, b in ps}:
            _, _, a, b = min(p for p in ps if (p[2][1], p[3][1]) == names)
            tagged = t
            for s, e, n in sorted([(a[2], a[3], "e1"), (b[2], b[3], "e2")], reverse=True):
                tagged = f"{tagged[:s]}<{n}>{tagged[s:e]}</{n}>{tagged[e:]}"
            want.append((str(i), tagged))
    assert rows(plans.all_tagged_pairs(spark, "").select("sent_id", "tagged")) == sorted(want, key=repr) and want


def test_frequent_surfaces_of_all_hits(spark, monkeypatch):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(["Binding-Site of CELLS"] * 21 + ["cells"] * 20)], "sent_id string, text string")
    monkeypatch.setattr(plans, "sents", lambda *_: df)
    assert {r.matched for r in plans.all_frequent_surfaces(spark, "").collect()} == {"Binding", "Binding-Site", "CELLS", "of"}
