"""Dictionary match: every synonym of a large lexicon in every sentence, at word boundaries."""

from __future__ import annotations

import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litweft.functions.text import BOUNDARY, COLLAPSED

HIT_SCHEMA = "sent_id string, dict_id int, syn_idx int, matched string, start int, end int, syn string, exact boolean, prefix string, suffix string, variant int"
#: Dictionary rows of one broadcast; larger dictionaries are matched in several passes over the sentences.
MAX_BROADCAST = 500_000


def _upper(text: str) -> str:
    """Upper case that keeps every position."""
    up = text.upper()
    return up if len(up) == len(text) else "".join(c.upper() if len(c.upper()) == 1 else ("ẞ" if c == "ß" else c) for c in text)


def _collapse(text: str) -> tuple[str, list[int]]:
    """Runs of separators as one blank, and the original position of every kept character."""
    out, at, run = [], [], False
    for i, c in enumerate(text):
        if c in COLLAPSED:
            if not run:
                out.append(" ")
                at.append(i)
            run = True
        else:
            out.append(c)
            at.append(i)
            run = False
    return "".join(out), at


def variants(text: str) -> list[tuple[str, list[int] | None]]:
    """The four forms a sentence is searched in, each with the positions in the original (None: equal)."""
    s = text.rstrip()
    if s and s[-1] in ".:,;":
        s = s[:-1]
    flat, at = _collapse(s)
    return [(s, None), (_upper(s), None), (flat, at), (_upper(flat), at)]


def surface_forms(syn: str, excluded: frozenset[str]) -> list[str]:
    """Forms of a synonym that enter the automaton: an excluded raw form stops all others, an excluded other form itself."""
    if len(syn) < 2:
        return []
    if syn in excluded:
        return [syn]
    flat = _collapse(syn)[0]
    return list(dict.fromkeys([syn, *(f for f in (_upper(syn), flat, _upper(flat)) if f not in excluded)]))


class _Automaton:
    """Multi-pattern search; uses the C automaton if it is installed, else forms by their first word."""

    def __init__(self, forms: dict[str, list]):
        self.forms = forms
        try:
            import ahocorasick

            self.auto = ahocorasick.Automaton()
            for f in forms:
                self.auto.add_word(f, f)
            if forms:
                self.auto.make_automaton()
        except ImportError:
            self.auto = None
            self.by_head: dict[str, list[str]] = defaultdict(list)
            for f in forms:
                self.by_head[self._head(f, 0)].append(f)

    @staticmethod
    def _head(text: str, i: int) -> str:
        j = i + 1
        while j < len(text) and text[j] not in BOUNDARY:
            j += 1
        return text[i:j]

    def find(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(start, end, form) of hits bounded on both sides."""
        if not self.forms:
            return
        if self.auto is not None:
            hits: Iterable = ((end - len(f) + 1, f) for end, f in self.auto.iter(text))
        else:
            starts = (i for i in range(len(text)) if i == 0 or text[i - 1] in BOUNDARY)
            hits = ((i, f) for i in starts for f in self.by_head.get(self._head(text, i), ()) if text.startswith(f, i))
        n = len(text)
        for s, f in hits:
            e = s + len(f)
            if (s == 0 or text[s - 1] in BOUNDARY) and (e == n or text[e] in BOUNDARY):
                yield s, e, f


def _sentence_hits(text: str, auto: _Automaton, stop: _Automaton, trust: int, longest: bool) -> list[tuple]:
    found: dict[tuple, tuple] = {}
    blocked: set[int] = set()
    for v, (form_text, at) in enumerate(variants(text)):
        place = (lambda i: i) if at is None else (lambda i, at=at: at[i])
        blocked.update(place(s) for s, _, _ in stop.find(form_text))
        for s, e, f in auto.find(form_text):
            a, b = place(s), place(e - 1) + 1
            surface = text[a:b]
            for d, k, syn in auto.forms[f]:
                if len(syn) <= trust and surface != syn:
                    continue
                found.setdefault((d, k, syn, a, b), (v, surface))
    rows = [(key, val) for key, val in found.items() if key[3] not in blocked]
    if longest:
        best: dict[tuple, int] = {}
        for (d, _, _, a, b), _ in rows:
            best[d, a] = max(best.get((d, a), 0), b)
        rows = [r for r in rows if r[0][4] == best[r[0][0], r[0][3]]]
    out = []
    for (d, k, syn, a, b), (v, surface) in rows:
        p = text.rfind(" ", 0, a) + 1
        q = text.find(" ", b)
        out.append((d, k, surface, a, b, syn, surface == syn, text[p:a], text[b : len(text) if q < 0 else q], v))
    return out


def match(sentences: DataFrame, dictionary: DataFrame, excluded: Sequence[str] = (), submatch: Sequence[str] = (), trust_length: int = 4, only_longest: bool = True) -> DataFrame:
    """Hits of ``dictionary`` (dict_id, syn_idx, syn) in ``sentences`` (sent_id, text); see HIT_SCHEMA.

    Sentences are searched raw, upper-cased, with separators collapsed, and both; positions are those of
    the original text, half-open. Synonyms up to ``trust_length`` characters need their exact surface. A
    hit must be bounded on both sides. ``excluded`` forms get no variants; a hit that starts where a
    ``submatch`` word starts is dropped. With ``only_longest`` the longest hits per dictionary and start
    stay, ties included. Null or empty sentences have no hits.

    The sentences are never shuffled: the dictionary is broadcast in shards of MAX_BROADCAST rows (its
    size is counted first), and a larger one takes one more pass per shard; longest hits are then
    settled across shards by a window.
    """
    spark = sentences.sparkSession
    rows = dictionary.select("dict_id", "syn_idx", "syn").where("syn is not null and length(syn) > 1").distinct()
    total = rows.count()
    shards = max(1, -(-total // MAX_BROADCAST))
    keyed = rows.withColumn("_s", F.pmod(F.xxhash64("syn"), F.lit(shards)))
    src = sentences.select("sent_id", "text").where("text is not null and text <> ''")
    out = None
    for k in range(shards):
        # a shard is bounded by MAX_BROADCAST (times the evenness of the hash)
        shard = spark.sparkContext.broadcast([tuple(r) for r in keyed.where(F.col("_s") == k).drop("_s").collect()])
        part = src.mapInArrow(_search(shard, frozenset(excluded), tuple(submatch), trust_length, only_longest), HIT_SCHEMA)
        out = part if out is None else out.unionByName(part)
    if shards > 1 and only_longest:
        w = Window.partitionBy("sent_id", "dict_id", "start")
        out = out.withColumn("_m", F.max("end").over(w)).where("end = _m").drop("_m")
    return out


#: Automata that a Python worker keeps for the tasks that follow, by shard; the one used longest ago goes first.
KEPT = 4
_BUILT: OrderedDict[str, tuple[_Automaton, _Automaton]] = OrderedDict()


def _automata(key: str, shard, excluded: frozenset[str], submatch: tuple[str, ...]) -> tuple[_Automaton, _Automaton]:
    """The automata of a shard and of the blocked words, built once by a worker."""
    if key not in _BUILT:
        forms: dict[str, list] = defaultdict(list)
        for d, k, syn in shard.value:
            for f in surface_forms(syn, excluded):
                forms[f].append((d, k, syn))
        _BUILT[key] = _Automaton(dict(forms)), _Automaton({w.upper(): [w] for w in submatch})
        while len(_BUILT) > KEPT:
            _BUILT.popitem(last=False)
    _BUILT.move_to_end(key)
    return _BUILT[key]


def _search(shard, excluded: frozenset[str], submatch: tuple[str, ...], trust: int, longest: bool):
    names = [f.split()[0] for f in HIT_SCHEMA.split(", ")]
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.int32()]

    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, stop = _automata(key, shard, excluded, submatch)
        for b in batches:
            rows = [(sid, *h) for sid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for h in _sentence_hits(text, auto, stop, trust, longest)]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    return run


def longest_per_start(hits: DataFrame) -> DataFrame:
    """The longest hits per (sentence, dictionary, start); ties stay."""
    w = Window.partitionBy("sent_id", "dict_id", "start")
    return hits.withColumn("_m", F.max("end").over(w)).where("end = _m").drop("_m")


def with_synonym(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Hits with the synonym entry they point to (``syn_id``)."""
    return hits.join(dictionary.select("dict_id", "syn_idx", "syn_id").distinct(), ["dict_id", "syn_idx"])


def frequent_surfaces(hits: DataFrame, over: int) -> DataFrame:
    """``(matched, n)`` of surface forms found more than ``over`` times, rarest first."""
    return hits.groupBy("matched").agg(F.count("*").alias("n")).where(F.col("n") > over).orderBy("n", "matched")


def drop_common_words(dictionary: DataFrame, top: int, over: int, word: str = "syn") -> DataFrame:
    """Dictionary rows without words that are among the ``top`` most common synonyms and occur more than ``over`` times."""
    n = dictionary.groupBy(word).agg(F.count("*").alias("_n")).where(F.col("_n") > over)
    common = n.orderBy(F.desc("_n"), word).limit(top)
    return dictionary.join(common.select(word), word, "left_anti")
