"""A dependency-parsed sentence and the questions that relation rules ask of it.

The parse is an input: ``array<struct<i,idx,text,pos,dep,head>>`` from any parser. Nothing here depends
on how it was made.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "array<struct<i:int,idx:int,text:string,pos:string,dep:string,head:int>>"


class Parse:
    """Tokens by position, with tree walks. ``head`` of the root is its own position."""

    def __init__(self, tokens: Iterable):
        rows = sorted(({k: t[k] for k in ("i", "idx", "text", "pos", "dep", "head")} for t in tokens), key=lambda t: t["i"])
        self.text = [t["text"] for t in rows]
        self.idx = [t["idx"] for t in rows]
        self.pos = [t["pos"] for t in rows]
        self.dep = [t["dep"] for t in rows]
        #: What was worked out once for this sentence, whatever the pair.
        self.cache: dict = {}
        n = len(rows)
        self.head = [t["head"] if 0 <= t["head"] < n else k for k, t in enumerate(rows)]

    def __len__(self) -> int:
        return len(self.text)

    def cut(self, start: int, end: int) -> Parse:
        """The parse of the characters from ``start`` to ``end``: tokens inside, moved by ``start``; a token whose head
        lies outside becomes a root."""
        if (start, end) not in self.cache:
            self.cache[start, end] = self._cut(start, end)
        return self.cache[start, end]

    def _cut(self, start: int, end: int) -> Parse:
        inside = [k for k in range(len(self)) if start <= self.idx[k] and self.idx[k] + len(self.text[k]) <= end]
        at = {k: i for i, k in enumerate(inside)}
        return Parse({"i": at[k], "idx": self.idx[k] - start, "text": self.text[k], "pos": self.pos[k], "dep": self.dep[k], "head": at.get(self.head[k], at[k])} for k in inside)

    @cached_property
    def children(self) -> list[list[int]]:
        kids: list[list[int]] = [[] for _ in self.text]
        for k, h in enumerate(self.head):
            if h != k:
                kids[h].append(k)
        return kids

    def up(self, k: int) -> list[int]:
        """The token and its ancestors to the root; a circle ends where it closes."""
        out = [k]
        while self.head[out[-1]] != out[-1] and self.head[out[-1]] not in out:
            out.append(self.head[out[-1]])
        return out

    def subtree(self, k: int) -> list[int]:
        out, todo = set(), [k]
        while todo:
            x = todo.pop()
            if x not in out:
                out.add(x)
                todo += self.children[x]
        return sorted(out)

    def follow(self, k: int, deps: frozenset[str]) -> set[int]:
        """The token and what hangs on it by any of ``deps``, transitively."""
        out, todo = set(), [k]
        while todo:
            x = todo.pop()
            if x not in out:
                out.add(x)
                todo += [c for c in self.children[x] if self.dep[c] in deps]
        return out

    def heads_by(self, k: int, deps: frozenset[str]) -> set[int]:
        """The token and its ancestors as long as the step up is by one of ``deps``."""
        out = {k}
        while self.dep[k] in deps and self.head[k] not in out:
            k = self.head[k]
            out.add(k)
        return out

    def path(self, a: int, b: int) -> list[int]:
        """Tokens from ``a`` up to the lowest common ancestor and down to ``b``; just [a] if there is none."""
        ua, ub = self.up(a), self.up(b)
        common = next((x for x in ua if x in set(ub)), None)
        if common is None:
            return [a]
        return ua[: ua.index(common) + 1] + ub[: ub.index(common)][::-1]

    def conjuncts(self, k: int) -> set[int]:
        """Tokens coordinated with ``k``: the first conjunct of the chain and all that hang on it by 'conj'."""
        top = k
        while self.dep[top] == "conj" and self.head[top] != top:
            top = self.head[top]
        return self.follow(top, frozenset({"conj"})) - {k}

    def words(self, ks: Iterable[int]) -> str:
        return " ".join(" ".join(self.text[k] for k in ks).split())

    def token_at(self, start: int, end: int) -> int | None:
        """The last token that overlaps a half-open character span."""
        hit = [k for k in range(len(self)) if self.idx[k] < end and start < self.idx[k] + len(self.text[k])]
        return hit[-1] if hit else None


def chain_parse(df: DataFrame, verbs: Sequence[str], text: str = "text", column: str = "tokens") -> DataFrame:
    """Adds a plain parse (TOKEN) of ``text`` by rule, for collections that come without one; JVM-side.

    Tokens are the parts between single blanks. A token that begins like one of ``verbs`` is a verb, one with a digit
    a proper noun, 'and' and 'or' are conjunctions, the others nouns. The first verb is the root (the first token where
    there is none); all hang on it, as subjects before it and objects after it, but for the token after a conjunction,
    which is listed with the one before it. It knows no clauses: real parses give better relations.
    """
    starts_with = "^(" + "|".join(re.escape(v) for v in verbs) + ")"
    blank = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("xs"))
    step = lambda a, w: F.struct((a["at"] + F.length(w) + 1).alias("at"), F.concat(a["xs"], F.array(a["at"])).alias("xs"))
    # each list is worked out once for a text, not once for a token
    df = df.withColumn("_words", F.split(text, " ")).withColumn("_starts", F.aggregate("_words", blank, step)["xs"])
    df = df.withColumn("_kinds", F.transform("_words", lambda w: F.when(F.lower(w).rlike(starts_with), "VERB").when(F.lower(w).isin("and", "or"), "CCONJ").when(w.rlike("[0-9]"), "PROPN").otherwise("NOUN")))
    df = df.withColumn("_root", F.greatest(F.array_position("_kinds", "VERB").cast("int"), F.lit(1)) - 1)

    def token(w: Column, i: Column) -> Column:
        kind, root = F.get("_kinds", i), F.col("_root")
        listed = (i > 1) & F.coalesce(F.get("_kinds", i - 1) == "CCONJ", F.lit(False))
        dep = F.when(i == root, "ROOT").when(listed, "conj").when(kind == "CCONJ", "cc").when(i < root, "nsubj").otherwise("dobj")
        head = F.when(listed & (i != root), i - 2).otherwise(root)
        return F.struct(i.alias("i"), F.get("_starts", i).alias("idx"), w.alias("text"), kind.alias("pos"), dep.alias("dep"), head.alias("head"))

    return df.withColumn(column, F.transform("_words", token)).drop("_words", "_starts", "_kinds", "_root")
