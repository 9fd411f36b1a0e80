"""Variant spellings of persons and organisations."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litweft.llm.linkage import cluster
from litweft.llm.simjoin import cosines, edit_keys, similar_keys, vectors
from litweft.session import materialise

# Words around a name, particles of last names, words of organisations and their short forms.
TITLES = frozenset("dr prof professor md phd mdphd jr junior sr senior ii iii msc bsc dipl ing".split())
PARTICLES = frozenset("von van der den de del della di da dos du la le zu zur af al el ter ten".split())
FILLERS = frozenset("the of for and et und der fur y at in".split())
ORG_WORDS = (
    "university hospital institute research consortium initiative genome study group partners center department faculty college "
    "laboratory foundation society association network collaboration clinic school academy council agency committee"
).split()
SHORT_WORDS = {
    "univ": "university", "uni": "university", "hosp": "hospital", "inst": "institute", "res": "research", "cons": "consortium",
    "init": "initiative", "grp": "group", "sg": "study group", "ctr": "center", "centre": "center", "dept": "department",
    "lab": "laboratory", "assoc": "association", "soc": "society", "found": "foundation", "coll": "college",
}


def fold(s: str) -> str:
    """Lower case without accents; letters that do not decompose are spelled out."""
    s = s.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("æ", "ae").replace("đ", "d")
    return "".join(c for c in unicodedata.normalize("NFD", s.casefold()) if not unicodedata.combining(c))


def near(a: str, b: str) -> bool:
    """At most one letter inserted, dropped or replaced, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:])


def _org_words(words: list[str]) -> tuple[list[str], list[str]] | None:
    """Kind words and proper words of an organisation; None if it is none. A kind word may have a typo."""
    kinds, proper = [], []
    for w in words:
        w = SHORT_WORDS.get(w, w)
        hit = w.split() if w == "study group" else [o for o in ORG_WORDS if o == w or (len(w) >= 5 and near(o, w))][:1]
        if hit:
            kinds += hit
        elif w not in FILLERS:
            proper.append(w)
    strong = set(kinds) - {"group", "study", "partners", "genome", "research", "school"}
    return (kinds, proper) if strong or len(kinds) >= 2 else None


def parse(first: str | None, last: str | None) -> dict:
    """Parts of a spelling.

    ``kind`` 'p' (person), 'o' (organisation) or '' (nobody). ``left`` and ``right`` are the name words
    as stored (given and last name, or one list if the order is open); ``order`` is 'known', 'open'
    (one field, no comma), or 'stored' (both fields, may be swapped). Particles are in ``part``.
    """
    first, last = (first or "").strip(), (last or "").strip()
    out = {"kind": "", "given": [], "sur": [], "part": "", "order": "known", "types": ""}
    whole = f"{first} {last}".strip()
    if not any(c.isalpha() for c in whole):
        return out
    words = re.findall(r"[^\W\d_]+", fold(whole))
    if (org := _org_words(words)) is not None:
        kinds, proper = org
        return out | {"kind": "o", "sur": sorted(proper) or sorted(kinds), "types": " ".join(sorted(kinds))}

    shout = not any(c.islower() for c in last) and any(c.isupper() for c in last) and len(last) > 3

    def cut(text: str, only: bool) -> list[str]:
        """Words; a group of capitals that stands for initials is one word per letter, marked by a dot.
        ``only``: a short group of capitals that is the whole field is initials, whatever it spells."""
        found = []
        alone = text.strip()
        if only and len(alone) <= 3 and alone.isalpha() and alone.isupper():
            return [c + "." for c in fold(alone)]
        for m in re.finditer(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?", text):
            w = m.group()
            bare = fold(re.sub(r"[.'’-]", "", w))
            if not bare or bare in TITLES:
                continue
            if len(bare) == 1:
                found.append(bare + ".")
            elif len(bare) <= 3 and w.rstrip(".").isupper() and not shout and bare not in PARTICLES:
                found += [c + "." for c in bare]
            else:
                found.append(bare)
        return found

    def is_sur(ws: list[str]) -> bool:
        return any(w in PARTICLES for w in ws)

    comma = last.partition(",")
    tail = cut(comma[2], True)
    if tail and not first:
        given, sur, order = tail, cut(comma[0], False), "known"
    elif first and last:
        given, sur, order = cut(first, not shout), cut(comma[0], False), "stored"
        if not given or not sur:
            given, sur, order = ([], given or sur, "known" if len(given or sur) == 1 else "open")
        elif all(w.endswith(".") for w in sur) or is_sur(given):
            given, sur, order = sur, given, "known"
        elif all(w.endswith(".") for w in given) or is_sur(sur):
            order = "known"
    else:
        ws = cut(last or first, False)
        initials = [w for w in ws if w.endswith(".")]
        full = [w for w in ws if not w.endswith(".")]
        if initials and full:
            given, sur, order = initials, full, "known"
            if len([w for w in full if w not in PARTICLES]) > 1:
                given, sur, order = [], ws, "open"
        else:
            given, sur, order = [], ws, "open" if len([w for w in full if w not in PARTICLES]) > 1 else "known"
    if not sur:
        given, sur = [], given
    part = " ".join(w for w in sur if w in PARTICLES)
    core = [w for w in sur if w not in PARTICLES] or sur
    return out | {"kind": "p", "given": given, "sur": core, "part": part, "order": order}


_PARSED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("given", T.ArrayType(T.StringType())), T.StructField("sur", T.ArrayType(T.StringType())),
    T.StructField("part", T.StringType()), T.StructField("order", T.StringType()), T.StructField("types", T.StringType()),
])


def parsed(spellings: DataFrame) -> DataFrame:
    """``(id, rows, *parts)`` of ``(id, rows, firstname, lastname)``, one pass over Arrow batches."""
    names = _PARSED.names
    types = [pa.list_(pa.string()) if isinstance(f.dataType, T.ArrayType) else pa.string() for f in _PARSED.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [parse(f, g) for f, g in zip(b.column("firstname").to_pylist(), b.column("lastname").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rows"), *(pa.array([g[n] for g in got], t) for n, t in zip(names, types))], names=["id", "rows", *names])

    return spellings.select("id", "rows", "firstname", "lastname").mapInArrow(run, T.StructType([T.StructField("id", T.LongType()), T.StructField("rows", T.LongType()), *_PARSED.fields]))


def _full(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.endswith("."))


def _oriented(p: DataFrame) -> DataFrame:
    """Settle which words are the given name, by where each word stands in the collection.

    A word's givenness is the share of spellings with both fields that have it on the given side; the
    table of words joins back on the word (it grows with the vocabulary, so nothing is broadcast).
    """
    both = p.where("kind = 'p' and order in ('stored', 'known')")
    sides = both.select(F.explode(F.array_union(F.transform(_full(F.col("given")), lambda w: F.struct(w.alias("w"), F.lit(1).alias("g"))), F.transform(_full(F.col("sur")), lambda w: F.struct(w.alias("w"), F.lit(0).alias("g"))))).alias("x"))
    lex = materialise(sides.groupBy(F.col("x.w").alias("w")).agg(F.sum("x.g").alias("ng"), F.count("*").alias("n")).withColumn("p", (F.col("ng") + 0.5) / (F.col("n") + 1)), "lexicon")
    score = lex.select("w", "p", "n")
    # the words that compete: in two fields the first given against the last of the last name, in one field its ends
    full = _full(F.concat("given", "sur"))
    comp = p.withColumn("_x", F.when(F.col("order") == "open", F.element_at(_full(F.col("sur")), 1)).otherwise(F.get(_full(F.col("given")), F.lit(0))))
    comp = comp.withColumn("_y", F.get(F.reverse(_full(F.col("sur"))), F.lit(0))).withColumn("_open", (F.col("kind") == "p") & (F.col("order") != "known") & (F.size(full) > 1))
    ask = comp.where("_open")
    ask = ask.join(score.select(F.col("w").alias("_x"), F.col("p").alias("_px")), "_x", "left").join(score.select(F.col("w").alias("_y"), F.col("p").alias("_py")), "_y", "left").fillna(0.5, ["_px", "_py"])
    swap = F.col("_py") > F.col("_px")
    one = F.col("order") == "open"
    given = F.when(one, F.when(swap, F.array("_y")).otherwise(F.array("_x"))).otherwise(F.when(swap, F.col("sur")).otherwise(F.col("given")))
    sur = F.when(one, F.when(swap, F.slice("sur", F.lit(1), F.size("sur") - 1)).otherwise(F.slice("sur", F.lit(2), F.size("sur") - 1))).otherwise(F.when(swap, F.col("given")).otherwise(F.col("sur")))
    # initials that stand between the words of one field belong to the given name
    dots = F.filter(sur, lambda w: w.endswith("."))
    given_like = F.greatest("_px", "_py") >= 0.4
    settled = ask.where(~one | given_like).select("id", "rows", "kind", F.concat(given, dots).alias("given"), F.filter(sur, lambda w: ~w.endswith(".")).alias("sur"), "part", "types")
    # one field whose words never stand on the given side is a last name of several words
    settled = settled.unionByName(ask.where(one & ~given_like).select("id", "rows", "kind", F.array().cast("array<string>").alias("given"), "sur", "part", "types"))
    rest = comp.where("not _open").select("id", "rows", "kind", "given", "sur", "part", "types")
    return rest.unionByName(settled)


def _canonical_given(forms: DataFrame, short_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(forms, near words)``. Adds ``name`` (the first given word in full and usual form, or null) and ``ini`` (initials in order).

    Familiar forms become the full name of the reference list. A word one letter off a word that is at
    least ten times as frequent is taken as its misspelling; candidates share a deletion or their letters.
    """
    nick = short_names.select(F.lower("short_name").alias("_w"), F.lower("full_name").alias("_full"))
    nick = nick.groupBy("_w").agg(F.min("_full").alias("_full"))
    word = F.get(_full(F.col("given")), F.lit(0))
    base = forms.withColumn("_w", word)
    words = materialise(base.where("_w is not null and kind = 'p'").groupBy("_w").agg(F.count("*").alias("n")), "given")
    pairs = materialise(edit_keys(words.select(F.col("_w").alias("key")), _near_sql(F.col("key_a"), F.col("key_b"))), "words")
    both = pairs.select(F.col("key_a").alias("_w"), F.col("key_b").alias("big")).unionByName(pairs.select(F.col("key_b").alias("_w"), F.col("key_a").alias("big")))
    fix = both.join(words, "_w").join(words.select(F.col("_w").alias("big"), F.col("n").alias("nb")), "big").where("nb >= 10 * n and length(_w) >= 3")
    fix = fix.join(nick.select("_w"), "_w", "left_anti").groupBy("_w").agg(F.max_by("big", F.struct("nb", "big")).alias("_fix"))
    named = base.join(fix, "_w", "left").withColumn("_v", F.coalesce("_fix", "_w")).drop("_w", "_fix")
    named = named.join(nick.withColumnRenamed("_w", "_v"), "_v", "left")
    ini = F.array_join(F.transform("given", lambda w: F.substring(w, 1, 1)), "")
    return named.withColumn("name", F.coalesce("_full", "_v")).withColumn("said", F.col("_v")).withColumn("ini", ini).drop("_v", "_full"), both.select(F.col("_w").alias("said_a"), F.col("big").alias("said_b"))


def _near_sql(a: Column, b: Column) -> Column:
    """One edit, or two neighbours (or any two letters) swapped; inside generated code."""
    swapped = (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return F.levenshtein(a, b, 1).isin(0, 1) | swapped


def _decisive(df: DataFrame, group: str, choice: str, weight: str, factor: float = 4.0) -> DataFrame:
    """``(group, choice)`` where one choice has at least ``factor`` times the weight of all others together."""
    per = df.groupBy(group, choice).agg(F.sum(weight).alias("_w"))
    top = per.groupBy(group).agg(F.max_by(choice, F.struct("_w", choice)).alias(choice), F.max("_w").alias("_m"), F.sum("_w").alias("_s"))
    return top.where(F.col("_m") >= factor * (F.col("_s") - F.col("_m"))).select(group, choice)


#: Cosine from which the n-gram join looks for names; those one edit apart below it come by their deletions.
COSINE = 0.6
#: Names shorter than this are another name for many a person, so one edit in them needs more evidence.
SHORT = 5
_SHAPE = ["kind", "key", "name", "said", "ini", "types"]


def _angular(cosine: Column) -> Column:
    """Similarity of two names near each other, the mean of 1 for passing that check and of their vectors' angular
    similarity: 1 for the same direction, 0.75 for no gram in common."""
    return 1 - F.acos(F.least(cosine, F.lit(1.0))) / (2 * math.pi)


def _given_agreement() -> Column:
    """How far the given parts of forms a and b agree: -1 if further initials contradict each other, null if the
    given names do not agree, less than 1 where an initial stands for a name or a name is misspelt."""
    c = F.col
    initial = lambda x, y: c(f"name_{x}").isNull() & c(f"name_{y}").isNotNull() & F.substring(f"ini_{x}", 1, 1).isin(F.substring(f"name_{y}", 1, 1), F.substring(f"said_{y}", 1, 1))
    return (
        F.when(c("kind_a") == "o", F.when(c("types_a") == c("types_b"), 1.0))
        .when((F.length("ini_a") > 1) & (F.length("ini_b") > 1) & (F.substring("ini_a", 2, 1) != F.substring("ini_b", 2, 1)), -1.0)
        .when(c("name_a") == c("name_b"), 1.0)
        .when(c("name_a").isNull() & c("name_b").isNull(), F.when(F.substring("ini_a", 1, 1) == F.substring("ini_b", 1, 1), 0.95))
        .when(initial("a", "b") | initial("b", "a"), 0.9)
        .when((F.least(F.length("said_a"), F.length("said_b")) >= 4) & _near_sql(c("said_a"), c("said_b")) & (c("key_a") == c("key_b")), 0.85)
    )


def _first_letters() -> Column:
    letters = F.array(F.substring("name", 1, 1), F.substring("said", 1, 1), F.substring("ini", 1, 1))
    return F.array_distinct(F.filter(letters, lambda x: x.isNotNull() & (x != "")))


def _meeting_points() -> tuple[Column, Column]:
    """Where forms of one last name meet, as the first and as the second of a pair: named forms at their name, at a near
    word of the given name and with initials at the letter, forms with initials only at their letter, organisations at
    their kind words.

    Forms of one key with different given names have no point in common, so a last name that many persons share gives
    no pairs between persons.
    """
    at = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    org, named = F.col("kind") == "o", F.col("name").isNotNull()
    types, name, near = at("o:", F.array("types")), at("n:", F.array("name")), at("w:", F.coalesce("_near", F.array().cast("array<string>")))
    letters = F.col("first")
    one = F.when(org, types).when(named, F.concat(name, near, at("e:", letters))).otherwise(at("d:", letters))
    other = F.when(org, types).when(named, F.concat(name, at("w:", F.array("said")), at("d:", letters))).otherwise(F.concat(at("d:", letters), at("e:", letters)))
    return one, other


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of forms under one key ``k`` with a meeting point in common; a near given name counts where the last names
    are equal. Columns end in _a and _b; f_a <> f_b."""
    a, b = left.withColumn("_m", F.explode("one_a")).drop("one_a", "other_a"), right.withColumn("_m", F.explode("other_b")).drop("one_b", "other_b")
    near = F.startswith("_m", F.lit("w:"))
    return a.join(b, ["k", "_m"]).where((F.col("f_a") != F.col("f_b")) & (F.col("kind_a") == F.col("kind_b")) & (~near | (F.col("key_a") == F.col("key_b")))).drop("_m")


def link_names(names: DataFrame, short_names: DataFrame, row_id: str = "row_id", first: str = "firstname", last: str = "lastname", threshold: float = 0.4) -> DataFrame:
    """``(id, cluster)`` of every spelling; both are smallest row ids (of the spelling, of the cluster).

    A spelling is a distinct (first, last), null and '' told apart; a spelling without a letter is
    nobody's and left out. Steps, all over every spelling:

    1. parse (case, accents, titles, swapped or packed parts, initials, short words of organisations);
       which word is the given name is learnt from the collection;
    2. spellings with equal parts become one form, so that the pairs below are between forms;
    3. last names and organisations' proper words become vectors of weighted character trigrams and are joined by
       their cosine (no cap on partners); the join by shared deletions and letters adds every pair one edit apart
       whose cosine is lower, and names with a glued particle. Pairs must be one edit apart or differ by that particle;
    4. a form whose last name is near that of a better attested compatible form also answers to that name; forms
       that share a name and whose given names agree (words, familiar forms, misspellings, initials) get a
       similarity: how far the given parts agree times the angular similarity of the last names' vectors. Last names
       of under SHORT letters that differ need equal full given names and ten times the rows on one side;
    5. average linkage at ``threshold``; forms without a link count as 0, forms whose further initials
       contradict each other as -1;
    6. initials and last names alone that fit several persons join the one that clearly prevails in the
       rows, else none.

    Empty input gives no row; extra columns are not read; repeated rows only add to the row counts.
    """
    src = names.select(F.col(row_id).cast("long").alias("r"), F.col(first).cast("string").alias("firstname"), F.col(last).cast("string").alias("lastname"))
    spell = src.groupBy("firstname", "lastname").agg(F.min("r").alias("id"), F.count("*").alias("rows"))
    parts = materialise(parsed(spell).where("kind <> ''"), "parsed")
    named, words = _canonical_given(_oriented(parts), short_names)
    words = words.where("length(said_a) >= 4 and length(said_b) >= 4 and left(said_a, 1) = left(said_b, 1)")
    key = F.concat(F.array_join("sur", ""), F.when(F.col("kind") == "o", "#").otherwise(""))
    named = named.withColumn("key", key).where("key <> '' and key <> '#'")
    named = named.withColumn("form", F.sha2(F.to_json(F.struct(*_SHAPE)), 256))
    spelled = materialise(named.select("id", "rows", "form", *_SHAPE), "spelled")
    merged = spelled.groupBy("form").agg(F.min("id").alias("f"), F.sum("rows").alias("rows"), *(F.first(c).alias(c) for c in _SHAPE))
    near = words.groupBy(F.col("said_a").alias("said")).agg(F.collect_set("said_b").alias("_near"))
    one, other = _meeting_points()
    forms = merged.withColumn("first", _first_letters()).join(near, "said", "left").withColumn("one", one).withColumn("other", other)
    forms = materialise(forms.drop("_near"), "forms")
    close = _close_keys(forms.select("key").distinct())

    def side(df: DataFrame, s: str, *more: str) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{c}_{s}") for c in ("f", "rows", "first", "one", "other", *_SHAPE, *more)), "k")

    agree = _given_agreement()

    # 4: better attested names near by, among compatible forms
    a = side(forms.withColumnRenamed("key", "key_a").join(close, "key_a").withColumnsRenamed({"key_a": "key", "key_b": "k"}), "a", "near")
    fit = _meet(a, side(forms.withColumn("k", F.col("key")), "b")).where(agree > 0)
    sizes = (F.greatest("rows_a", "rows_b") >= 10 * F.least("rows_a", "rows_b")) & (F.col("name_a") == F.col("name_b"))
    fit = materialise(fit.where((F.least(F.length("key_a"), F.length("key_b")) >= SHORT) | sizes), "fit")
    support = forms.select("kind", "key", "rows", F.explode(F.when(F.col("kind") == "o", F.array(F.lit(""))).otherwise(F.col("first"))).alias("i1"))
    support = materialise(support.groupBy("kind", "key", "i1").agg(F.sum("rows").alias("_own")), "support")
    own = fit.select("f_a", "kind_a", "key_a", "k", "near_a", "rows_b", F.explode(F.when(F.col("kind_a") == "o", F.array(F.lit(""))).otherwise(F.array_intersect("first_a", "first_b"))).alias("i1"))
    own = own.join(support.withColumnsRenamed({"kind": "kind_a", "key": "key_a"}), ["kind_a", "key_a", "i1"])
    best = own.groupBy("f_a", "key_a", "k", "near_a").agg(F.sum("rows_b").alias("_fit"), F.max("_own").alias("_own"))
    best = best.where("_fit > _own or (_fit = _own and k < key_a)")
    snap = best.groupBy("f_a").agg(F.max_by(F.struct("k", F.col("near_a").alias("near")), F.struct("_fit", "k")).alias("also")).withColumnRenamed("f_a", "f")
    names_of = F.array(F.struct(F.col("key").alias("k"), F.lit(1.0).alias("near")), F.col("also"))
    keyed = forms.join(snap, "f", "left").withColumn("_k", F.explode(F.filter(names_of, lambda x: x.isNotNull())))
    keyed = materialise(keyed.withColumn("k", F.col("_k.k")).withColumn("near", F.col("_k.near")).drop("_k", "also"), "keyed")
    # a misspelt last name has a right one behind it: compare given names as if the last names were equal
    last_names = F.when(F.col("key_a") == F.col("key_b"), 1.0).otherwise(F.col("near_a") * F.col("near_b"))
    pair = _meet(side(keyed, "a", "near"), side(keyed, "b", "near")).where("f_a < f_b").withColumn("sim", agree * last_names)
    pair = pair.drop("k").unionByName(fit.drop("k").withColumn("near_b", F.lit(1.0)).withColumn("sim", agree * F.col("near_a"))).where("sim is not null and f_a < f_b")
    kept = [F.first(c).alias(c) for c in ("name_a", "name_b", "rows_a", "rows_b", "kind_a")]
    pair = materialise(pair.groupBy("f_a", "f_b").agg(F.when(F.min("sim") < 0, F.min("sim")).otherwise(F.max("sim")).alias("sim"), *kept), "pairs")

    # 6a: initials that fit several persons
    def half(x: str, y: str) -> DataFrame:
        some = pair.where(f"sim > 0 and name_{x} is null and name_{y} is not null and kind_a = 'p'")
        return some.select(F.col(f"f_{x}").alias("f"), F.col(f"name_{y}").alias("to"), F.col(f"rows_{y}").alias("w"))

    choice = materialise(_decisive(half("a", "b").unionByName(half("b", "a")), "f", "to", "w"), "choice")
    for x, y in (("a", "b"), ("b", "a")):
        pair = pair.join(choice.select(F.col("f").alias(f"f_{x}"), F.col("to").alias(f"_to_{x}")), f"f_{x}", "left")
        pair = pair.where(f"not (kind_a = 'p' and name_{x} is null and name_{y} is not null and not (_to_{x} <=> name_{y}))")
    found = materialise(cluster(pair.select(F.col("f_a").alias("a"), F.col("f_b").alias("b"), "sim"), threshold), "clusters")
    placed = forms.select("f", "form", "kind", "key", "ini", "rows").join(found.withColumnRenamed("id", "f"), "f", "left")
    placed = materialise(placed.withColumn("cluster", F.coalesce("cluster", "f")), "placed")

    # 6b: last names alone
    bare = forms.where("kind = 'p' and ini = ''")
    homes = placed.where("kind = 'p' and ini <> ''").groupBy("key", "cluster").agg(F.sum("rows").alias("w"))
    exact = bare.select("f", "key").join(homes, "key").select("f", "cluster", "w")
    long_ = close.where(F.least(F.length("key_a"), F.length("key_b")) >= SHORT)
    loose = bare.select("f", F.col("key").alias("key_a")).join(long_, "key_a").join(homes.withColumnRenamed("key", "key_b"), "key_b").select("f", "cluster", "w")
    loose = loose.join(exact.select("f").distinct(), "f", "left_anti")
    home = _decisive(exact.unionByName(loose), "f", "cluster", "w").withColumnRenamed("cluster", "home")
    final = placed.join(home, "f", "left").select("form", F.coalesce("home", "cluster").alias("cluster"))
    out = materialise(spelled.select("id", "form").join(final, "form").select("id", "cluster"), "linked")
    smallest = out.groupBy("cluster").agg(F.min("id").alias("least"))
    return out.join(smallest, "cluster").select("id", F.col("least").alias("cluster"))


def _close_keys(keys: DataFrame) -> DataFrame:
    """``(key_a, key_b, near)``, both directions: keys one edit apart or alike but for a glued particle, with the
    angular similarity of their trigram vectors."""
    a, b = F.col("key_a"), F.col("key_b")
    longer, shorter = (F.when((F.length(a) > F.length(b)) == big, a).otherwise(b) for big in (True, False))
    glue = sorted(PARTICLES | {"dela", "vonder", "vander"})
    glued = F.endswith(longer, shorter) & (F.length(shorter) >= SHORT - 1) & F.substring(longer, F.lit(1), F.length(longer) - F.length(shorter)).isin(glue)
    alike = _near_sql(a, b) | glued
    loose = F.array(*(F.when(F.startswith("key", F.lit(g)) & (F.length("key") > len(g)), F.substring("key", len(g) + 1, 1 << 20)) for g in glue))
    vec = vectors(keys)
    found = similar_keys(vec, COSINE, alike)
    rest = edit_keys(keys, alike, loose).join(found, ["key_a", "key_b"], "left_anti")
    close = found.unionByName(cosines(rest, vec)).select("key_a", "key_b", _angular(F.col("cosine")).alias("near"))
    return materialise(close.unionByName(close.select(b.alias("key_a"), a.alias("key_b"), "near")), "close")


def linked_pairs(links: DataFrame) -> DataFrame:
    """``(row_id_a, row_id_b)``, a < b: all pairs of spellings of one cluster."""
    a, b = links.select("cluster", F.col("id").alias("row_id_a")), links.select("cluster", F.col("id").alias("row_id_b"))
    return a.join(b, "cluster").where("row_id_a < row_id_b").select("row_id_a", "row_id_b")
