from __future__ import annotations

import random

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from litweft.functions.packed import Grammar, evidence_spans, tokenize
from litweft.operators.unpack import IDS, NAMES, NESTED, SPANS, unpack


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []), ("", []), (" ;; , | ", []), ("hsa", ["hsa"]), ("hsa;mmu", ["hsa", "mmu"]), ("hsa, ,mmu,", ["hsa", "mmu"]), ('"";hsa', ["hsa"]),
        ("O'Brann hare;hsa", ["O'Brann hare", "hsa"]), ('hsa;"strain ""K7"", inbred"', ["hsa", 'strain "K7", inbred']), ("'l''ancien type, F2' | mmu", ["l'ancien type, F2", "mmu"]),
        ("['hsa', 'mmu']", ["hsa", "mmu"]), ('["hsa"]', ["hsa"]), (',  "hsa" ;', ["hsa"]), ('"open; ended', ["open; ended"]), ("hsa / mmu", ["hsa", "mmu"]),
    ],
)
def test_names(text, want):
    assert tokenize(text, NAMES) == want


def test_blanks_split_ids_only():
    assert tokenize('90 "91 | retracted"\tPMC1', IDS) == ["90", "91 | retracted", "PMC1"]
    assert tokenize("Mus velanus", NAMES) == ["Mus velanus"]


def test_nesting_protects_separators():
    assert tokenize("f(a, b); g[c; (d)], e", NESTED) == ["f(a, b)", "g[c; (d)]", "e"]
    assert tokenize("a); b", NESTED) == ["a)", "b"]


def test_escape():
    g = Grammar(escape="\\")
    assert tokenize(r'"a\"b;c";d', g) == ['a"b;c', "d"]


@pytest.mark.parametrize(
    "text",
    ["('9.2.1', (1, 2), (3, 4));('9.2.2', (5, 6), (7, 8))", '[["9.2.1",[1,2],[3,4]], ["9.2.2",[5,6],[7,8]]]', "9.2.1,1,2,3,4|9.2.2,5,6,7,8", "9.2.1:1-2:3-4 / 9.2.2:5-6:7-8", '"9.2.1,1,2,3,4", "9.2.2,5,6,7,8"', "('9.2.1', (1, 2), (3, 4))\n(\"9.2.2\", (5, 6), (7, 8));"],
)
def test_spans_of_any_packing(text):
    assert evidence_spans(text) == ["9.2.1,1,2,3,4", "9.2.2,5,6,7,8"]


def test_spans_incomplete_and_empty():
    assert evidence_spans("9.2.1,1,2|9.2.2,5,6,7,8") == ["9.2.1,1,2", "9.2.2,5,6,7,8"]
    assert evidence_spans(None) == evidence_spans("") == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab;,|/\"' x", min_size=1, max_size=8).map(str.strip).filter(bool), max_size=6), st.sampled_from(";,|/"), st.sampled_from("\"'"))
def test_round_trip(values, sep, quote):
    packed = f" {sep} ".join(quote + v.replace(quote, quote * 2) + quote for v in values)
    assert tokenize(packed, NAMES, list_wrapper=False) == values


def test_unpack_rows(spark):
    df = spark.createDataFrame([(1, "hsa;mmu", None, "9.1.1,1,2,3,4", "x"), (1, "hsa;mmu", None, "9.1.1,1,2,3,4", "y"), (2, "", "90 91", None, None), (None, None, None, None, None)], "row_id long, organisms string, docs string, ev string, pos string")
    got = rows(unpack(df, {"organisms": NAMES, "docs": IDS, "ev": SPANS}, ["row_id"]))
    one = [(1, "ev", 0, "9.1.1,1,2,3,4"), (1, "organisms", 0, "hsa"), (1, "organisms", 1, "mmu")]
    assert got == sorted([*one, *one, (2, "docs", 0, "90"), (2, "docs", 1, "91")], key=repr)


def test_unpack_empty_and_clash(spark):
    df = spark.createDataFrame([], "row_id long, organisms string, pos int")
    assert unpack(df, {"organisms": NAMES}, ["row_id"]).count() == 0
    with pytest.raises(ValueError):
        unpack(df, {"organisms": NAMES}, ["pos"])


def test_unpack_long_text(spark):
    n = 60_000
    df = spark.createDataFrame([(1, ";".join(f"v{i}" for i in range(n)))], "row_id long, f string")
    out = unpack(df, {"f": NAMES}, ["row_id"])
    assert out.count() == n and out.where("val = concat('v', pos)").count() == n


def test_random_fields_equal_plain_split(spark):
    r = random.Random(1)
    data = [(i, ";".join(r.choice(["a", "bb", "", "c d"]) for _ in range(r.randint(0, 5)))) for i in range(300)]
    got = rows(unpack(spark.createDataFrame(data, "row_id long, f string"), {"f": NAMES}, ["row_id"]))
    want = [(i, "f", p, v) for i, t in data for p, v in enumerate(x for x in t.split(";") if x)]
    assert got == sorted(want, key=repr)
