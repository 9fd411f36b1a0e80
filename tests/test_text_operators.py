from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from litweft.functions import mirna, synonyms
from litweft.functions import text as tx
from litweft.functions.parse import TOKEN, Parse, chain_parse
from litweft.operators import cooccur, matcher, relations

S1 = "hsa-miR 155 is possibly contained in this sentence of hsa-miR-155, in contrast to HSA----MIR-155."
S2 = "hsa-miR 155 is possibly contained in this sentence, but can it differentiate Ccl2l2 from CCl2?"


def find(spark, sents, lex, **kw):
    s = spark.createDataFrame(list(enumerate(sents)), "sent_id string, text string")
    d = spark.createDataFrame([(1, i, w) for i, w in enumerate(lex)], "dict_id int, syn_idx int, syn string")
    return matcher.match(s, d, **kw)


def test_known_sentences(spark):
    lex = ["hsa-miR-155", "Ccl2", "CCl2", "Ccl2l2"]
    got = rows(find(spark, [S1, S2], lex, trust_length=3).select("sent_id", "start", F.expr("end - start").alias("n"), "syn_idx"))
    assert [g for g in got if g[0] == "0"] == [("0", 0, 11, 0), ("0", 54, 11, 0), ("0", 82, 14, 0)]
    assert [g for g in got if g[0] == "1"] == [("1", 0, 11, 0), ("1", 77, 6, 3), ("1", 89, 4, 1), ("1", 89, 4, 2)]
    # with the usual trust in four characters the case-folded short hit goes
    assert rows(find(spark, [S2], lex).where("start = 89").select("syn_idx")) == [(2,)]


@pytest.mark.parametrize("with_library", [True, False])
def test_hits_are_bounded_slices(spark, with_library, monkeypatch):
    text = "AB-12 ab-12, xAB-12; AB 12 (AB-12) ß AB-12."
    auto = matcher._Automaton({f: [(1, 0, "AB-12")] for f in matcher.surface_forms("AB-12", frozenset())})
    if not with_library:
        import builtins

        real = builtins.__import__
        monkeypatch.setattr(builtins, "__import__", lambda n, *a, **k: (_ for _ in ()).throw(ImportError()) if n == "ahocorasick" else real(n, *a, **k))
        auto = matcher._Automaton({f: [(1, 0, "AB-12")] for f in matcher.surface_forms("AB-12", frozenset())})
        assert auto.auto is None
    hits = sorted((h[3], h[4]) for h in matcher._sentence_hits(text, auto, matcher._Automaton({}), 4, False))
    assert [text[a:b] for a, b in hits] == ["AB-12", "ab-12", "AB 12", "AB-12", "AB-12"]


def test_excluded_submatch_shards_and_empty(spark, monkeypatch):
    assert find(spark, ["THE cat"], ["the"], trust_length=2).count() == 1
    assert find(spark, ["THE cat"], ["the"], trust_length=2, excluded=["the"]).count() == 0
    assert find(spark, ["gene set one"], ["gene set"], submatch=["gene"]).count() == 0
    whole = rows(find(spark, [S1, S2, "cell line X"], ["hsa-miR-155", "cell line", "cell", "line X"]))
    monkeypatch.setattr(matcher, "MAX_BROADCAST", 1)
    assert rows(find(spark, [S1, S2, "cell line X"], ["hsa-miR-155", "cell line", "cell", "line X"])) == whole
    assert find(spark, [None, "", "x" * 100_000], ["abc"]).count() == 0
    assert find(spark, [], []).count() == 0


def test_pairs(spark):
    h = find(spark, ["miR-1 targets ABCD and ABCD", "Table 1 miR-1 ABCD"], ["miR-1", "ABCD"], only_longest=False)
    s = spark.createDataFrame([("0", "miR-1 targets ABCD and ABCD"), ("1", "Table 1 miR-1 ABCD")], "sent_id string, text string")
    p = cooccur.pairs(h.where("syn_idx = 0"), h.where("syn_idx = 1"), s)
    assert [r[0] for r in rows(p.select("sent_id"))] == ["0", "0"] and cooccur.distinct_pairs(p).count() == 1
    assert cooccur.pairs(h, h).where("syn_a = syn_b").count() == 0
    assert cooccur.dense_sentences_out(h, 2).select("sent_id").distinct().count() == 1


def test_hit_filters(spark):
    df = spark.createDataFrame([("ABC", "", "", True), ("ABC", "x", "", True), ("ABC", " (", "),", True), ("ABC", "", "", False), ("ABCDEF", "x", "y", False), ("A", "x", "y", False)], "f string, p string, s string, e boolean")
    assert [r.ok for r in df.select(tx.strong_hit(F.col("f"), F.col("p"), F.col("s"), F.col("e")).alias("ok")).collect()] == [True, False, True, False, True, True]
    m = spark.createDataFrame([("miR-1", "hsa-"), ("miR-1", "xyz-"), ("155", ""), ("let-7", ""), ("anything long", "ab")], "f string, p string")
    assert [r.ok for r in m.select(tx.mirna_hit(F.col("f"), F.col("p")).alias("ok")).collect()] == [True, False, False, True, True]
    c = spark.createDataFrame([("heart", True), ("heart", False), ("liver and kidney", True)], "f string, e boolean")
    assert [r.ok for r in c.select(tx.context_hit(F.col("f"), F.col("e")).alias("ok")).collect()] == [True, False, False]


def test_around_and_upper(spark):
    r = spark.range(1).select(tx.around(F.lit("a miR-1 of ABC z"), F.lit(11), F.lit(14), F.lit(2), F.lit(7)).alias("x"), tx.upper_same_length(F.lit("Straße")).alias("u")).first()
    assert tuple(r.x) == ("a ", " of ", " z", "BA") and r.u == "STRAẞE"


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("hsa-miR-126a-1-3p", ("hsa", "miR", "126", "a", "1", "3p")), ("miR-335-g-5p", (None, "miR", "335", "g", None, "5p")), ("let-7-f-3p", (None, "let", "7", "f", None, "3p")),
        ("miR-181c-5p", (None, "miR", "181", "c", None, "5p")), ("miR-146-a", (None, "miR", "146", "a", None, None)), ("microRNA-106b", (None, "miR", "106", "b", None, None)),
        ("MIR155", (None, "miR", "155", None, None, None)), ("miR-17*", (None, "miR", "17", None, None, "*")), ("", (None,) * 6), ("miR-155-5p-x", (None,) * 6),
    ],
)
def test_mirna_names(spark, name, want):
    assert tuple(spark.range(1).select(mirna.parse(F.lit(name)).alias("p")).first().p) == want


def test_mirna_compose_compare_expand(spark):
    df = spark.createDataFrame([("hsa-miR-21-5p", "miR-21"), ("miR-21", "hsa-miR-21-5p"), ("miR-21", "miR-22")], "a string, b string").select(mirna.parse(F.col("a")).alias("a"), mirna.parse(F.col("b")).alias("b"))
    assert [r[0] for r in df.select(mirna.same(F.col("a"), F.col("b"))).collect()] == [True, True, False]
    assert [r[0] for r in df.select(mirna.compose(F.col("a"), ("mature", "id"))).collect()] == ["miR-21"] * 3
    assert df.select(mirna.compose(F.col("a"))).first()[0] == "hsa-miR-21-5p"
    assert mirna.expand("miR-15a/b/-16-5p") == ["miR-15a", "miR-15b", "miR-16-5p"]
    assert mirna.expand("miR-29a/29b-1/-9") == ["miR-29a", "miR-29b-1", "miR-9"] or mirna.expand("miR-29a/29b-1/-9")[0] == "miR-29a"
    assert mirna.expand("miR-21") == ["miR-21"] and mirna.expand(None) == [] and mirna.expand("word/other") == ["word/other"]
    v = mirna.variants("hsa", "miR", "21", arm="5p")
    assert "hsa-miR-21-5p" in v and "hsa-mir-21" in v and len(v) == len(set(v)) and not any("mediated" in x for x in v)
    assert "microRNA-21" in mirna.variants(None, "miR", "21") and "miR-21-mediated" in mirna.variants(None, "miR", "21")


def test_synonyms(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    for raw, want in [(' "abc" ', "abc"), ("ab", None), ("123", None), ("WITHDRAWN", None), ("symbol withdrawn, XYZ1", "XYZ1"), ("a|b  c", "a-b c"), ("see FOO", "FOO"), ("X1~withdrawn", "X1"), (None, None)]:
        assert one(synonyms.clean(F.lit(raw).cast("string"))) == want
    arr = lambda *x: F.array(*(F.lit(v) for v in x))
    assert one(synonyms.hyphen_variants(arr("ABC1", "ABC1A", "HGNC1", "1"))) == ["ABC1", "ABC1A", "HGNC1", "1", "ABC-1", "ABC-1A"]
    assert one(synonyms.without_excluded(arr("of", "OF", "Mus", "x"), {"common": ["OF"], "taxnames": ["MUS"]})) == ["Mus", "x"]
    assert one(synonyms.without_numbers(arr("1.5", "a", "ab", "-3"))) == ["ab"]
    assert one(synonyms.invert_cell(F.lit("epithelial cell of lung"))) == "lung epithelial cell"
    assert one(synonyms.acronym(F.lit("natural killer cell"))) == "NKC" and one(synonyms.acronym(F.lit("cell"))) is None
    assert [one(synonyms.is_gene_symbol(F.lit(x))) for x in ("MIR155", "MIR155HG", "ABC")] == [False, True, True]
    assert one(synonyms.line(F.lit("HGNC:1"), arr("a", "", "b"))) == "HGNC_1:a|b"


# -- relations on parses ----------------------------------------------------------------------------
def tree(*words):
    """(text, pos, dep, head) in order."""
    out, at = [], 0
    for i, (t, pos, dep, head) in enumerate(words):
        out.append({"i": i, "idx": at, "text": t, "pos": pos, "dep": dep, "head": head})
        at += len(t) + 1
    return out


ACTIVE = tree(("miR-1", "PROPN", "nsubj", 1), ("inhibits", "VERB", "ROOT", 1), ("ABC", "PROPN", "compound", 3), ("expression", "NOUN", "dobj", 1))
PASSIVE = tree(("ABC", "PROPN", "nsubjpass", 2), ("is", "AUX", "auxpass", 2), ("suppressed", "VERB", "ROOT", 2), ("by", "ADP", "agent", 2), ("miR-1", "PROPN", "pobj", 3))
LISTED = tree(("miR-1", "PROPN", "nsubj", 3), ("and", "CCONJ", "cc", 0), ("ABC", "PROPN", "conj", 0), ("rise", "VERB", "ROOT", 3))
CLAUSES = tree(("miR-1", "PROPN", "nsubj", 1), ("rises", "VERB", "ROOT", 1), (",", "PUNCT", "punct", 1), ("while", "SCONJ", "mark", 5), ("ABC", "PROPN", "nsubj", 5), ("falls", "VERB", "advcl", 1))
STEMS = [("NEG", "inhibit"), ("NEG", "suppress"), ("POS", "increas"), ("INT", "regulat"), ("BOOST", "activat")]
DECIDE = relations.Classifier({s: c for c, s in STEMS})


def test_tree_walks():
    p = Parse(ACTIVE)
    assert p.path(0, 2) == [0, 1, 3, 2] and p.subtree(3) == [2, 3] and p.up(2) == [2, 3, 1]
    assert Parse(LISTED).conjuncts(0) == {2} and Parse(LISTED).conjuncts(2) == {0}
    assert p.token_at(0, 5) == 0 and p.token_at(100, 101) is None
    loop = Parse([{"i": 0, "idx": 0, "text": "a", "pos": "X", "dep": "d", "head": 1}, {"i": 1, "idx": 2, "text": "b", "pos": "X", "dep": "d", "head": 0}])
    assert loop.up(0) == [0, 1]


def test_checks():
    assert relations.path_check(Parse(ACTIVE), 0, 2) == (True, False, False)
    assert relations.path_check(Parse(PASSIVE), 4, 0) == (True, True, False)
    assert not relations.coordination_ok(Parse(LISTED), 0, 2) and relations.coordination_ok(Parse(ACTIVE), 0, 2)
    assert relations.common_compartment(Parse(CLAUSES), 0, 4) is None and relations.common_compartment(Parse(ACTIVE), 0, 2) is not None
    assert [Parse(CLAUSES).words(c) for c in relations.compartments(Parse(CLAUSES), (0, 4))] == ["miR-1 rises", "ABC falls"]
    assert relations.context_ok("miR-1 inhibits ABC expression", (0, 5), (15, 18)) and not relations.context_ok("miR-1 inhibits the ABC signalling pathway", (0, 5), (19, 22))
    assert not relations.context_ok("ABC", (0, 3), (0, 3))


def test_classes():
    v = DECIDE(Parse(ACTIVE), 0, 2)
    assert (v.regulation, v.direction, v.rule) == ("DOWN", "MIR_GENE", "counts between")
    v = DECIDE(Parse(PASSIVE), 4, 0)
    assert (v.regulation, v.direction, v.passive) == ("DOWN", "MIR_GENE", True)
    off = relations.Classifier({}, off=["compartment", "between", "counts", "return"])(Parse(ACTIVE), 0, 2)
    assert (off.regulation, off.direction, off.rule) == ("DOWN", "MIR_GENE", "static")
    assert DECIDE.stem("Enhancer") is None and DECIDE.stem("x-stressed") == "POS" and DECIDE.stem("Regulated") == "NEU" and DECIDE.stem("activation") == "POS"


@pytest.mark.parametrize(
    ("middle", "order", "want"),
    [
        ("binds to", "mg", ("NEU", "MIR_GENE", "compartment mir gene")), ("regulated by", "mg", ("NEU", "GENE_MIR", "compartment mir gene by")), ("binds to", "gm", ("NEU", "GENE_MIR", "compartment gene mir")),
        ("regulated by", "gm", ("NEU", "MIR_GENE", "compartment gene mir by")), ("inversely correlated", "gm", ("DOWN", "GENE_MIR", "compartment gene mir neg corr")), ("positive correlation", "mg", ("UP", "MIR_GENE", "compartment mir gene pos corr")),
    ],
)
def test_phrases_in_a_clause(middle, order, want):
    ws = ["miR-1" if order == "mg" else "ABC", *middle.split(), "ABC" if order == "mg" else "miR-1"]
    p = Parse(tree(*((w, "NOUN", "dep" if i else "ROOT", 0) for i, w in enumerate(ws))))
    last = len(ws) - 1
    v = DECIDE(p, 0 if order == "mg" else last, last if order == "mg" else 0)
    assert (v.regulation, v.direction, v.rule) == want


def test_relations_frame(spark):
    schema = f"sent_id string, text string, tokens {__import__('litweft.functions.parse', fromlist=['TOKEN']).TOKEN}, start_a int, end_a int, start_b int, end_b int"
    data = [("1", "miR-1 inhibits ABC expression", ACTIVE, 0, 5, 15, 18), ("2", "miR-1 and ABC rise", LISTED, 0, 5, 10, 13), ("3", "no parse", None, 0, 1, 2, 3), ("4", "miR-1 inhibits ABC expression", ACTIVE, 900, 905, 15, 18)]
    got = {r.sent_id: r for r in relations.relations(spark.createDataFrame(data, schema), STEMS).collect()}
    assert got["1"].accepted and got["1"].regulation == "DOWN" and not got["2"].accepted and got["2"].conj is False
    assert not got["3"].accepted and got["3"].rule is None and not got["4"].accepted
    named = spark.createDataFrame([("1", 14, 19, "CELL"), ("2", 10, 12, "ORGANISM"), ("3", 3, 9, "ORGANISM")], "sent_id string, start int, end int, label string")
    cand = spark.createDataFrame([("1", 15, 18), ("2", 10, 13), ("3", 5, 9)], "sent_id string, start int, end int")
    assert rows(relations.entity_ok(cand, named)) == [("3", 5, 9)]


def shift(tokens, by):
    return [{**t, "i": t["i"] + by[0], "idx": t["idx"] + by[1], "head": t["head"] + by[0]} for t in tokens]


def joined(mark, *parts):
    """(text, tokens) of parses one after the other with a mark token between."""
    text, tokens = "", []
    for k, words in enumerate(parts):
        if k:
            tokens.append({"i": len(tokens), "idx": len(text), "text": mark.strip(), "pos": "PUNCT", "dep": "punct", "head": len(tokens)})
            text += mark
        tokens += shift(words, (len(tokens), len(text)))
        text += " ".join(w["text"] for w in words)
    return text, tokens


def judged(spark, data, **kw):
    schema = f"sent_id string, text string, tokens {TOKEN}, start_a int, end_a int, start_b int, end_b int, ents {relations.ENTITIES}"
    return {r.sent_id: r for r in relations.relations(spark.createDataFrame(data, schema), STEMS, **kw).collect()}


def at(text, word):
    return text.index(word), text.index(word) + len(word)


def test_the_fragment_of_both_entities_is_judged_alone(spark):
    alone = judged(spark, [("x", "miR-1 inhibits ABC expression", ACTIVE, 0, 5, 15, 18, None)])["x"]
    other = tree(("adenomas", "NOUN", "nsubj", 1), ("rise", "VERB", "ROOT", 1))
    two, two_t = joined("; ", other, ACTIVE)
    left, right = tree(("miR-1", "PROPN", "nsubj", 1), ("inhibits", "VERB", "ROOT", 1)), tree(("ABC", "PROPN", "compound", 1), ("expression", "NOUN", "ROOT", 1))
    apart, apart_t = joined("; ", left, other, right)
    colon, colon_t = joined(": ", left, other, right)
    data = [
        ("two", two, two_t, *at(two, "miR-1"), *at(two, "ABC"), None), ("apart", apart, apart_t, *at(apart, "miR-1"), *at(apart, "ABC"), None),
        ("colon", colon, colon_t, *at(colon, "miR-1"), *at(colon, "ABC"), None), ("null", None, ACTIVE, 0, 5, 15, 18, None), ("nospan", "miR-1 inhibits ABC", ACTIVE, 0, 5, None, None, None),
    ]
    got = judged(spark, data, checks=())
    assert got["two"][1:] == alone[1:] and got["two"].fragment
    # three fragments, no common one: rejected, unless a ': ' cut them
    assert got["apart"].fragment is False and not got["apart"].accepted
    assert got["colon"].fragment is True and got["colon"].accepted
    assert not got["null"].accepted and not got["nospan"].accepted and got["null"].rule is None


def test_cut_spans_equal_the_frame(spark):
    texts = ["One: two; three", "a (x: y) b", "plain", "(a): b; c; D", "x; é; 1: ", ": a", "a; b" * 30, "tail; "]
    got = relations.fragments(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "sent_id string, text string"))
    want = sorted((str(i), t[s:e]) for i, t in enumerate(texts) for s, e in relations.cut_spans(t))
    assert sorted((r.sent_id, r.fragment) for r in got.collect()) == want


def test_entity_veto_and_unknown_checks(spark):
    text = "miR-1 inhibits ABC expression"
    case = lambda i, *ents: (i, text, ACTIVE, 0, 5, 15, 18, [dict(zip(("start", "end", "label"), e)) for e in ents])
    data = [case("ok", (0, 5, "CELL"), (10, 20, "ORGANISM")), case("cell", (14, 16, "CELL")), case("cancer", (17, 40, "CANCER")), case("organism", (15, 16, "ORGANISM")), case("none")]
    got = judged(spark, data, checks=relations.CHECKS, entities="ents")
    assert {k: (r.accepted, r.entity) for k, r in got.items()} == {"ok": (True, True), "cell": (False, False), "cancer": (False, False), "organism": (False, False), "none": (True, True)}
    assert judged(spark, data)["cell"].entity is None and judged(spark, data)["cell"].accepted
    for odd in (("nonsense",), ("conj", "entity")):
        with pytest.raises(ValueError):
            judged(spark, data, checks=odd)
    named = spark.createDataFrame([("1", 4, 9, "CELL"), ("1", 0, 2, "X")], "sent_id string, start long, end long, label string")
    both = relations.with_entities(spark.createDataFrame([("1",), ("2",)], "sent_id string"), named)
    assert rows(both) == [("1", ((0, 2, "X"), (4, 9, "CELL"))), ("2", None)]


def test_exact_context_takes_patterns(spark):
    texts = {"ABC1 rs123 is": True, "see Fig. 2 ABC1 x": True, "ABC1+ cells": True, "ABC1- cells": True, "ABC1 rises": False}
    df = spark.createDataFrame([(t, t.index("ABC1")) for t in texts], "text string, s int")
    got = df.select("text", relations.context_reject_exact(F.col("text"), F.col("s"), F.col("s") + 4).alias("bad")).collect()
    assert {r.text: r.bad for r in got} == texts


def test_fragments(spark):
    s = spark.createDataFrame([("1", "One: two; three"), ("2", "a (x: y) b"), ("3", "plain"), ("4", "")], "sent_id string, text string")
    assert rows(relations.fragments(s)) == [("1", 0, 0, "One"), ("1", 1, 4, " two"), ("1", 2, 9, " three"), ("2", 0, 0, "a (x: y) b"), ("3", 0, 0, "plain")]


def test_pieces_never_hide_a_fuzzy_phrase():
    import random

    import regex

    r = random.Random(6)
    for table in (relations.AFTER_GENE, relations.AFTER_MIRNA, relations.BEFORE_GENE, relations.BEFORE_MIRNA):
        for phrase, k, reach in table:
            f, plain = relations._Fuzzy(phrase, k, reach), regex.compile(f"({phrase}){{e<={k}}}")
            for _ in range(12):
                s = list(phrase)
                for _ in range(r.randint(0, k + 1)):
                    j = r.randrange(len(s))
                    s[j : j + r.randint(0, 1)] = r.choice(["", "x", "-", " "])
                    s = s or ["x"]
                text = "qq" + "".join(s) + "zz"
                assert f.found(text, 0, len(text)) == (plain.search(text) is not None)
                assert f.found(text, 4, len(text) - 4) == (plain.search(text, 4, len(text) - 4) is not None)


def test_chain_parse(spark):
    df = spark.createDataFrame([("MIR-1 and ABC2 Inhibits some growth",), ("no verb",), ("",), (None,)], "text string")
    got = [r[0] for r in chain_parse(df, ["inhibit"]).select("tokens").collect()]
    p = Parse(got[0])
    assert p.text == ["MIR-1", "and", "ABC2", "Inhibits", "some", "growth"] and [got[0][k]["idx"] for k in range(6)] == [0, 6, 10, 15, 24, 29]
    assert p.pos == ["PROPN", "CCONJ", "PROPN", "VERB", "NOUN", "NOUN"] and p.dep == ["nsubj", "cc", "conj", "ROOT", "dobj", "dobj"] and p.head == [3, 3, 0, 3, 3, 3]
    assert Parse(got[1]).dep == ["ROOT", "dobj"] and len(got[2]) == 1 and got[3] is None


def test_texts_to_consensus(spark, monkeypatch):
    from litweft.plans import text as plans

    texts = ["MIR-7 inhibits QAB12 growth", "MIR-7 inhibits QAB12 again", "MIR-7 and QAB12 rise", "QAB12 only", "MIR-7 inhibits MIR-8"]
    df = spark.createDataFrame([(i, f"{i}.2.0", t) for i, t in enumerate(texts)], "doc_id long, sent_id string, text string")
    monkeypatch.setattr(plans, "sents", lambda *_: df)
    full = {r.sent_id: r for r in plans.relations_full(spark, "").collect()}
    assert {k: r.accepted for k, r in full.items()} == {"0.2.0": True, "1.2.0": True, "2.2.0": False} and full["2.2.0"].conj is False
    assert rows(plans.relation_consensus(spark, "")) == [("MIR-7", "QAB12", "MIR_GENE;DOWN", 2, 2, 1)]


def test_synonym_containers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    null, abc = F.lit(None).cast("array<string>"), F.array(F.lit("a"), F.lit("B"))
    assert one(synonyms.matches(abc, F.lit("b"))) and not one(synonyms.matches(abc, F.lit("c"))) and one(synonyms.matches(null, F.lit("a"))) is False
    assert one(synonyms.merge(abc, F.array(F.lit("c"), F.lit("a")))) == ["a", "B", "c"] and one(synonyms.merge(null, null)) == []
    assert one(synonyms.remove(abc, F.lit("a"))) == ["B"] and one(synonyms.remove(abc, F.lit("b"))) == ["a", "B"]
    assert [one(synonyms.is_number(F.lit(x))) for x in ("1", "-.5e3", "1.", "1e", "", "a", None)] == [True, True, True, False, False, False, False]
