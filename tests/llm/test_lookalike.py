from __future__ import annotations

from itertools import combinations
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

look = pytest.importorskip("litweft.llm.lookalike")
T = look.transducer()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, None), ("", ""), ("plain", "plain"), ("ＭＩＲ－３", "MIR-3"), ("a b c　d", "a b c d"), ("in​fil­tra﻿te", "infiltrate"),
        ("ö", "ö"), ("o‍̈", "ö"), ("ﬁne ﬂow", "fine flow"), ("МІR‐1", "MIR-1"), ("K", "K"), ("µM", "μM"), ("Ά", "Á"), ("ё", "ë"), ("a\r\nb\rc", "a\nb\nc"),
        ("\u1100\u1161", "\uac00"), ("\uac00\u11a8", "\uac01"), ("\u0b95\u0bc6\u0bbe", "\u0b95\u0bca"), ("\uff76\uff9e", "\u30ac"), ("a\u202eb\u2066c\ufe0f", "abc"), ("e\u200b\u0323\u0301", "\u1eb9\u0301"),
    ],
)
def test_form(text, want):
    assert T(text) == want


@pytest.mark.parametrize(("a", "b"), [("cm²", "cm2"), ("H₂", "H2"), ("e", "é"), ("MIR", "mir"), ("MIR-1", "MIR1"), ("×", "x"), ("—", "-"), ("β", "ß"), ("👨‍🔬", "👨🔬"), ("👩🏽‍🚀", "👩🏽🚀"), ("\u0601", "")])
def test_visible_differences_stay(a, b):
    assert T(a) != T(b)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeoоеöӦ́​‍­Ａ１ﬁ²  \r\n👨🔬新ёK", max_size=12))
def test_fixed_point(s):
    assert T(T(s)) == T(s)


def test_public_table_of_confusable_letters(spark):
    alike = look.confusable_letters(spark)
    t = look.Transducer(alike=alike)
    assert len(alike) > 150
    for odd, plain in {"\u0261": "g", "\u04ae": "Y", "\u0555": "O", "\u13aa": "A", "\u2c9e": "O", "\ua4d0": "B", "\u0474": "V", "\u04c0": "I", "\u1d20": "v"}.items():
        assert t(odd) == plain
    assert t("\u0413") == t("\u0393") and t("\u041f") == t("\u03a0")  # alike in two other alphabets
    for a, b in ("αa", "γy", "ıi", "ɪi", "Ьb", "З3", "𝐀A", "ßβ", "Øo", "ю1"):
        assert t(a) != t(b)
    assert all(t(f) == f for f in map(t, alike)) and all(a.isupper() == f.isupper() or a.lower() == a.upper() for a, f in alike.items())


def test_a_missing_table_of_confusable_letters_is_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(1, "gene"), (2, "\u0261ene"), (3, "other")], "doc_id long, text string")
    monkeypatch.setattr(look, "_ALIKE", {})
    read = look._confusable_letters
    with monkeypatch.context() as m:
        m.setattr(look, "_confusable_letters", lambda _: read(SimpleNamespace(_jvm=SimpleNamespace())))  # no ICU library
        for query in (look.canonical, look.equal_looking, look.look_classes):
            with pytest.raises(RuntimeError, match="ICU"):
                query(df)
    for skeleton in (lambda text: text.replace("\n", "", 1), OSError("lost")):  # one line short, and a failure underway
        jvm = MagicMock()
        jvm.com.ibm.icu.text.SpoofChecker.Builder.return_value.build.return_value.getSkeleton.side_effect = skeleton
        with pytest.raises((ValueError, OSError)):
            read(SimpleNamespace(_jvm=jvm))
    assert rows(look.equal_looking(df)) == [(1, 2)]  # a failure is not remembered


def test_classes_say_what_the_pairs_say(spark):
    texts = ["abc", "abc", "аbc", "ａｂｃ", "abC", None, "", "x" * 50_000, "x" * 49_999 + "х", "solo", "ab\u200bc"]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, class_id string, n_links int")
    pairs, links = rows(look.equal_looking(df)), {}
    for a, b in pairs:
        links.setdefault(a, []).append(b)
        links.setdefault(b, []).append(a)
    got = rows(look.look_classes(df))
    assert sorted((d, n) for d, _, n in got) == sorted((d, len(o)) for d, o in links.items())
    assert {d: c for d, c, _ in got} == {d: min([d, *o, *(x for p in o for x in links[p])]) for d, o in links.items()}
    assert rows(look.look_classes(df.limit(0))) == []


def test_conflicts_are_found():
    with pytest.raises(look.Conflict):
        look.Transducer({"Ａ": "B"})
    with pytest.raises(look.Conflict):
        look.Transducer({"①": "②", "②": "①"})
    with pytest.raises(look.Conflict):
        look.Transducer({"²": "2"})
    with pytest.raises(look.Conflict):
        look.Transducer({"x": "y"})


def test_pairs_equal_brute_force(spark):
    texts = ["abc", "abc", "аbc", "ａｂｃ", "abC", None, "", "​", "x" * 50_000, "x" * 49_999 + "х", "solo"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, j) for (i, a), (j, b) in combinations(enumerate(texts), 2) if a and b and a != b and T(a) == T(b)]
    assert rows(look.equal_looking(df)) == sorted(want, key=repr)


def test_many_exact_copies_make_no_pairs(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "'same' as text", "'form' as form", "1 as raw")
    assert look.equal_looking(df).count() == 0
    assert look.equal_looking(df.limit(0)).count() == 0


def test_canonical_keeps_every_row(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "ｗ")], "doc_id long, text string")
    assert rows(look.canonical(df).select("doc_id", "canon")) == [(1, None), (2, ""), (3, "w")]
    with pytest.raises(ValueError):
        look.canonical(df, keep=("text",))
