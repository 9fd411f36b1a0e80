from __future__ import annotations

import random
from collections import defaultdict

import pytest
from conftest import rows

tokens = pytest.importorskip("litweft.llm.tokens")
mixture = pytest.importorskip("litweft.llm.mixture")

TEXTS = ["", None, "a", "Hello world", "<|endoftext|> is text", "naïve 👨‍🔬 新规 ​", "\r\n\t  x", "  lead", "ß" * 50, "word " * 20000]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_ids_equal_the_other_library(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.ids for r in tokens.encode(docs(spark)).collect()}
    assert got == {i: other.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}


def test_decode_is_the_inverse(spark):
    back = tokens.decode(tokens.encode(docs(spark)), pieces=True)
    for r in back.collect():
        assert r.text == (TEXTS[r.doc_id] or "") and "".join(r.pieces) == r.text


def test_decode_odd_lists(spark):
    part = tokens.encode(spark.createDataFrame([(1, "新")], "doc_id long, text string")).first().ids[:1]
    df = spark.createDataFrame([(1, part), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in tokens.decode(df).collect()}
    assert got[2] is None and got[3] == "" and got[1].strip("�") == ""


def test_offsets_cover_whole_characters(spark):
    for r in tokens.encode(docs(spark).where("length(text) < 100"), keep=("doc_id", "text"), offsets=True).collect():
        assert len(r.spans) == len(r.ids)
        assert all(0 <= s.start <= s.end <= len(r.text) for s in r.spans)
        covered = {k for s in r.spans for k in range(s.start, s.end)}
        assert covered == set(range(len(r.text)))


def test_encode_empty_table_and_clash(spark):
    df = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert tokens.encode(df).count() == 0
    with pytest.raises(ValueError):
        tokens.encode(df, keep=("ids",))


def test_allocate_siblings_before_ancestors():
    leaves = [(("d1", "en", "a"), (0.5, 1, 0.5), 10), (("d1", "en", "b"), (0.5, 1, 0.5), 100), (("d2", "en", "c"), (0.5, 1, 1), 1000)]
    got = mixture.allocate(mixture.grow(leaves), 100)
    assert got == {("d1", "en", "a"): 10, ("d1", "en", "b"): 40, ("d2", "en", "c"): 50}
    # only what a whole family cannot take goes to the ancestor's other families
    got = mixture.allocate(mixture.grow(leaves), 400)
    assert got == {("d1", "en", "a"): 10, ("d1", "en", "b"): 100, ("d2", "en", "c"): 290}


def test_allocate_never_exceeds_and_never_wastes():
    r = random.Random(5)
    for _ in range(200):
        leaves = [((f"d{i % 2}", f"l{i % 3}", str(i)), None, r.choice([0, 5, 50, 500])) for i in range(8)]
        w = {p[:k]: r.choice([0, 0.2, 1, 3]) for p, _, _ in leaves for k in (1, 2, 3)}
        tree = mixture.grow([(p, tuple(w[p[:k]] for k in (1, 2, 3)), c) for p, _, c in leaves])
        total = r.choice([0, 10, 300, 5000])
        got = mixture.allocate(tree, total)
        usable = sum(c for p, _, c in leaves if all(w[p[:k]] > 0 for k in (1, 2, 3)))
        assert all(got[p] <= c + 1e-6 for p, _, c in leaves)
        assert abs(sum(got.values()) - min(total, usable)) < 1e-6


def test_bad_trees():
    with pytest.raises(ValueError):
        mixture.grow([(("a",), (-1,), 1)])
    with pytest.raises(ValueError):
        mixture.grow([(("a",), (1,), 1), (("a",), (1,), 1)])


def make(spark, n=3000, seed=2):
    r = random.Random(seed)
    data = [(i, r.choice(["big"] * 8 + ["mid", "mid", "small", None]), r.choice(["en", "en", "de", None]), r.choice([0, 1, 7, 40, 90])) for i in range(n)]
    return data, spark.createDataFrame(data, "doc_id long, source string, lang string, n long").repartition(5)


@pytest.mark.parametrize("ranges", [4096, 4])
def test_mixture_meets_budgets(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixture, "RANGES", ranges)
    data, df = make(spark)
    weights, repeats = {("big",): 0.5, ("mid",): 0.3, ("small",): 0.1, ("absent",): 0.1}, {("big",): 1, ("mid",): 2, ("small",): 3}
    total = 30_000
    got = mixture.mix(df, "n", ["source", "lang"], weights, repeats, total).collect()
    have, uses, reached = defaultdict(int), defaultdict(list), defaultdict(int)
    for _, s, _, k in data:
        have[s] += k
    for r in got:
        uses[r.doc_id].append(r.epoch)
        reached[r.source] += r.n
    assert all(sorted(e) == list(range(len(e))) for e in uses.values())
    assert all(len(uses[i]) <= repeats.get((s,), 0) for i, s, _, _ in data)
    sizes = defaultdict(int)
    for _, s, lang, k in data:
        if s in ("big", "mid", "small"):
            sizes[s, lang or ""] += k
    budget = defaultdict(float)
    for p, b in mixture.plan(sizes, weights, repeats, total).items():
        budget[p[0]] += b
    # every leaf (three languages a source) is off by at most half a document
    assert all(abs(reached[s] - budget[s]) <= 3 * 45 + 1 for s in budget)
    again = mixture.mix(df.repartition(3), "n", ["source", "lang"], weights, repeats, total)
    assert sorted((r.doc_id, r.epoch) for r in again.collect()) == sorted((r.doc_id, r.epoch) for r in got)


def test_mixture_shares_and_edges(spark):
    data, df = make(spark, 300)
    targets = spark.createDataFrame([("big", 0.9, 1), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mixture.mix(df, "n", ["source"], {("big",): 0.9, ("absent",): 0.1}, {("big",): 1})
    s = {r.source: r for r in mixture.shares(df, m, "n", "source", targets, "target_share", "max_repeats").collect()}
    assert s["big"].share_reached == 1.0 and s["big"].most_uses == 1 and s["absent"].reached == 0
    assert mixture.mix(df.limit(0), "n", ["source"], {("big",): 1.0}, {}).count() == 0
    assert mixture.mix(df, "n", ["source"], {}, {}).count() == 0
    assert mixture.mix(df.where("n = 0"), "n", ["source"], {("big",): 1.0}, {}).count() == 0


def test_one_source_with_everything(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "'s' as source", "10L as n")
    got = mixture.mix(df, "n", ["source"], {("s",): 1.0}, {("s",): 3}, total=45_000)
    assert rows(got.groupBy("epoch").count()) == [(0, 2000), (1, 2000), (2, 500)]


def test_total_from_the_caps():
    """The largest total at which the shares hold equals a search by brute force."""
    r = random.Random(11)
    for _ in range(60):
        sizes = {(f"d{i % 2}", f"s{i}"): r.choice([0, 3, 40, 500]) for i in range(5)}
        weight = {p: r.choice([0.1, 0.2, 0.5]) for p in sizes}
        for p in sizes:
            weight[p[:1]] = weight.get(p[:1], 0) + weight[p]
        repeats = {p: r.choice([1, 2, 4]) for p in sizes}
        got = sum(mixture.plan(sizes, weight, repeats).values())
        able = [d for d in {p[0] for p in sizes} if any(n and p[0] == d for p, n in sizes.items())]

        def share(p):  # a source's share when those without text are left out, level by level
            mates = [q for q in sizes if q[0] == p[0] and sizes[q]]
            return weight[p[:1]] / sum(weight[(d,)] for d in able) * weight[p] / sum(weight[q] for q in mates)

        want = min((sizes[p] * repeats[p] / share(p) for p in sizes if sizes[p]), default=0)
        assert abs(got - want) < 1e-6 * max(want, 1)
        assert all(abs(b - got * share(p)) < 1e-6 * max(want, 1) for p, b in mixture.plan(sizes, weight, repeats).items() if sizes[p])


def test_shares_meet_their_targets_and_unnamed_sources_stay_out(spark):
    r = random.Random(3)
    docs_ = [(i, s, r.randint(1, 9)) for i, s in enumerate(["a_x"] * 4000 + ["b_x"] * 300 + ["c_y"] * 900 + ["z_x"] * 500)]
    df = spark.createDataFrame(docs_, "doc_id long, source string, n long").selectExpr("*", "substring_index(source, '_', -1) as domain")
    targets = [("a_x", 0.5, 1), ("b_x", 0.2, 2), ("c_y", 0.2, 3), ("no_y", 0.1, 1)]
    w, rep = mixture.target_tree(targets, lambda s: s.rsplit("_", 1)[-1])
    m = mixture.mix(df, "n", ["domain", "source"], w, rep)
    got = mixture.shares(df, m, "n", "source", spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), "target_share", "max_repeats")
    share = {x.source: x.share_reached for x in got.collect()}
    # what no_y cannot give goes to its sibling c_y first
    assert share["no_y"] == 0 and all(abs(share[s] - t) < 0.005 for s, t in (("a_x", 0.5), ("b_x", 0.2), ("c_y", 0.3)))
    assert m.where("source = 'z_x'").count() == 0
    with pytest.raises(ValueError):
        mixture.target_tree([("a", 1, 1), ("a", 1, 1)], str)


def test_too_many_targets_raise(spark):
    queries = pytest.importorskip("litweft.llm.queries")
    many = spark.range(100_001).selectExpr("cast(id as string) as source", "1e-5D as target_share", "1 as max_repeats")
    with pytest.raises(ValueError):
        queries.named_targets(many)
    assert len(queries.named_targets(many.limit(100_000))) == 100_000
    odd = spark.createDataFrame([(None, 0.5, 1), ("a", None, 1), ("b", 0.5, None)], "source string, target_share double, max_repeats int")
    assert queries.named_targets(odd) == [("b", 0.5, 1)]


def test_pieces_equal_whole_texts():
    tok = tokens._tokenizer(tokens.tokenizer_path())
    pieces = tokens._Pieces(tokens.tokenizer_path())
    odd = ["it's  \u00a0we'll\n\n x1²٣ \U0001f468\u200d\U0001f52c a\u0301 \x1c\x85 \u3000末尾 ", "\u0378 unassigned \U00010940x", "<|endoftext|>", " " * 300, "x" * 500, "'S 'rE don'T"]
    for t in odd:
        assert [i for p in pieces.ids(t) for i in p] == tok.encode(t, add_special_tokens=False).ids
    assert not pieces.whole and all(len(p) <= tokens.PIECE_CHARS for p in pieces)
