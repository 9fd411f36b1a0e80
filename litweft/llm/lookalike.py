"""One consistent form for text that looks the same but is written with different characters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.session import materialise

# Letters of other alphabets that are drawn like Latin ones, in pairs (look-alike, Latin).
CYRILLIC = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT ХX аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw"
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv"
# Format characters that a reader sees (signs around Arabic and Kaithi numbers, hieroglyph joiners), as ranges.
SEEN_FORMAT = ((0x600, 0x605), (0x6DD, 0x6DD), (0x70F, 0x70F), (0x890, 0x891), (0x8E2, 0x8E2), (0x110BD, 0x110BD), (0x110CD, 0x110CD), (0x13430, 0x1345F))
# Marks that leave no trace: grapheme joiner, variation selectors, as ranges.
UNSEEN_MARKS = ((0x34F, 0x34F), (0x180B, 0x180F), (0xFE00, 0xFE0F), (0xE0100, 0xE01EF))
# What joins the character before it without being a mark: vowel and final jamo, half-width voicing signs, as ranges.
JOINING = ((0x1160, 0x11FF), (0xD7B0, 0xD7FB), (0xFF9E, 0xFF9F))
# Hyphens drawn alike, signs that exist twice, line ends.
SIGNS = {"\u2010": "-", "\u2011": "-", "\u00b5": "\u03bc", "\r\n": "\n", "\r": "\n", "\u2028": "\n", "\u2029": "\n", "\u0085": "\n"}
# Small Greek letters that a reader tells from Latin ones (all but omicron and nu), and small letters whose capital is drawn alike.
GREEK_SEEN = frozenset("αβγδεζηθικλμξπρςστυφχψω")
ONE_DRAWING = frozenset("cosuvwxz")

ZWJ = "\u200d"
#: Compatibility forms that differ from their plain form only in width or in being drawn as one glyph.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>")


def _code_points(first: int) -> Iterator[int]:
    """Code points from ``first`` on that may have a meaning of their own: the planes 0 to 3 and the start of plane 14;
    the others are unassigned or private."""
    return chain(range(first, 0x40000), range(0xE0000, 0xE1000))


def _within(cp: int, ranges: tuple[tuple[int, int], ...]) -> bool:
    return any(a <= cp <= b for a, b in ranges)


@lru_cache(maxsize=1)
def _kinds() -> tuple[frozenset[str], frozenset[str]]:
    """Invisible characters, and those that join the one before them, from the character database by rule."""
    gone, joins = set(), set()
    for cp in _code_points(0xA0):
        kind = unicodedata.category(chr(cp))
        if (kind == "Cf" and not _within(cp, SEEN_FORMAT)) or _within(cp, UNSEEN_MARKS):
            gone.add(chr(cp))
        elif kind[0] == "M" or _within(cp, JOINING):
            joins.add(chr(cp))
    return frozenset(gone), frozenset(joins)


def _char_class(chars: set[str]) -> str:
    """A pattern for one of ``chars``; code points above U+FFFF are apart, as they slow a class down."""
    spans: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if spans and spans[-1][1] == cp - 1 and cp != 0x10000:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    low, high = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans if (a < 0x10000) == wanted) for wanted in (True, False))
    return f"(?:[{low}]|[{high}])"


def confusable_letters(spark: SparkSession) -> dict[str, str]:
    """Letters of other alphabets and the letter they are drawn like, by rule from the public table of confusable
    characters that comes with Spark's ICU library. Raises where the session gives no access to it, as without the table
    texts that look the same would be missed.

    Two letters with one skeleton are drawn alike. A letter becomes the ASCII letter of its skeleton and case, else
    the skeleton itself if that is one letter of the same case. Left out: letters that are no letters of running
    left-to-right text of usual width, digits and signs, other cases, raised, lowered and styled letters, the small
    Greek letters that a reader tells from Latin ones, and Latin letters other than script and small-capital ones.
    The table depends on the Unicode version only (some hundred entries), so it may travel with the tasks; it is made
    once for an application.
    """
    if _ALIKE.get("of") != spark.sparkContext.applicationId:
        _ALIKE.update(of=spark.sparkContext.applicationId, table=_confusable_letters(spark))
    return dict(_ALIKE["table"])


_ALIKE: dict = {}


def _skeletons(spark: SparkSession) -> Callable[[list[str]], list[str]]:
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    except Exception as e:  # no JVM at hand, or a build without ICU
        raise RuntimeError("the table of confusable characters cannot be read: this session gives no access to Spark's ICU library") from e
    return lambda chars: checker.getSkeleton("\n".join(chars)).split("\n")


def _confusable_letters(spark: SparkSession) -> dict[str, str]:
    skeletons = _skeletons(spark)
    plain = [chr(c) for c in range(0x21, 0x7F)]
    classes: dict[str, list[str]] = {}
    for ch, form in zip(plain, skeletons(plain), strict=True):
        classes.setdefault(form, []).append(ch)
    letters = [chr(c) for c in range(0x80, 0x20000) if _foreign_letter(chr(c)) and chr(c) not in GREEK_SEEN]
    out = {}
    for ch, form in zip(letters, skeletons(letters), strict=True):
        if form in classes:
            same = [x for x in classes[form] if x.isalpha() and (x.isupper() == ch.isupper() or ch.lower() == ch.upper())]
            same = [form] if form in same else same
            if len(same) == 1 and _latin_alike(ch, same[0]):
                out[ch] = same[0]
        elif len(form) == 1 and form != ch and form.isalpha() and form.isupper() == ch.isupper() and form.islower() == ch.islower() and _foreign_letter(form) and not unicodedata.name(ch, "").startswith("LATIN"):
            out[ch] = form
    return out


def _foreign_letter(ch: str) -> bool:
    kind = unicodedata.category(ch)
    usual = kind in ("Lu", "Ll", "Lo") and unicodedata.bidirectional(ch) == "L" and unicodedata.east_asian_width(ch) not in "WFH"
    return usual and not unicodedata.decomposition(ch)


def _latin_alike(ch: str, plain: str) -> bool:
    """Of Latin letters outside ASCII only script forms, and small capitals where both cases have one drawing."""
    name = unicodedata.name(ch, "")
    if not name.startswith("LATIN"):
        return True
    return name.endswith(f" SCRIPT {plain.upper()}") or (name.endswith(f" SMALL CAPITAL {plain.upper()}") and plain in ONE_DRAWING)


def _glyph_forms() -> Iterator[tuple[str, str]]:
    """Width forms, blanks, ligatures and double-coded letters, from the character database by rule."""
    for cp in _code_points(0xA0):
        if 0xD800 <= cp < 0xF900:
            continue
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind == "Zs":
            yield ch, " "
            continue
        d = unicodedata.decomposition(ch)
        if not d:
            continue
        tag = d.split()[0]
        if tag in _SAME_LOOK:
            if ch not in _kinds()[0] and ch not in SIGNS:
                yield ch, unicodedata.normalize("NFKC", ch)
        elif tag == "<compat>" and kind in ("Ll", "Lu", "Lt", "Nl"):
            full = unicodedata.normalize("NFKC", ch)
            if full.isascii() and full.isalpha():  # ligatures and letter numerals
                yield ch, full
        elif not tag.startswith("<") and len(d.split()) == 1:  # canonical singletons such as the Kelvin sign
            yield ch, unicodedata.normalize("NFC", ch)
    yield "\u2026", "..."


class Conflict(ValueError):
    """Two rules give one character different forms, or a form is itself rewritten."""


class Transducer:
    """Longest-match transducer over grapheme clusters (a character and what joins it: marks of any script, vowel
    and final jamo, half-width voicing signs, with invisible characters in between).

    The mapping of single characters is computed once and checked: no character has two forms, no form
    is rewritten again (so the result is a fixed point), and nothing visible is lost, i.e. no two
    different ASCII characters and no raised or lowered digit, accent or case meet. ``alike`` adds look-alike
    letters where the fixed ones have none, ``extra`` further forms. Clusters are then mapped whole: decomposed, each
    part in its form, and composed again, so that every way to write a cluster has one result.
    A zero-width joiner between pictographs is visible (it fuses them) and stays; any other invisible
    character goes. The rewriting is one pass: one compiled pattern finds the next cluster that may
    need work, everything between is copied, and forms of clusters are remembered.
    """

    def __init__(self, extra: dict[str, str] | None = None, alike: dict[str, str] | None = None):
        self.table: dict[str, str] = {}
        self._gone, joins = _kinds()
        for ch, form in _glyph_forms():
            self._add(ch, form)
        for pair in (CYRILLIC + " " + GREEK).split():
            self._add(pair[0], pair[1])
        for ch in self._gone:
            self._add(ch, "")
        for ch, form in SIGNS.items():
            self._add(ch, form)
        for ch, form in (alike or {}).items():
            self.table.setdefault(ch, form)
        for ch, form in (extra or {}).items():
            self._add(ch, form)
        self._close()
        more = _char_class(joins | self._gone)
        # the longest cluster at each place; plain text is not looked at further than its next character
        self._pattern = re.compile(f"\r\n?|[\x00-\x7f](?=[^\x00-\x7f]){more}+|[^\x00-\x7f]{more}*")
        self._memo: dict[str, str] = {}

    def _add(self, ch: str, form: str) -> None:
        if self.table.get(ch, form) != form:
            raise Conflict(f"U+{ord(ch[0]):04X} has the forms {self.table[ch]!r} and {form!r}")
        self.table[ch] = form

    def _close(self) -> None:
        for ch, form in list(self.table.items()):
            seen = {ch}
            while (again := "".join(self.table.get(c, c) for c in form)) != form:
                if form in seen:
                    raise Conflict(f"the form of U+{ord(ch[0]):04X} is rewritten in a circle")
                seen.add(form)
                form = again
            self.table[ch] = form
        for ch, form in self.table.items():
            if ch.isascii() and ch not in SIGNS:
                raise Conflict(f"{ch!r} is plain already")
            if unicodedata.decomposition(ch[0]).startswith(("<super>", "<sub>")):
                raise Conflict(f"U+{ord(ch[0]):04X} is raised or lowered, which is visible")
            if len(form) == 1 and form.isalpha() and len(ch) == 1 and ch.isupper() != form.isupper() and ch.lower() != ch.upper():
                raise Conflict(f"U+{ord(ch):04X} would change case")

    def _cluster(self, m: re.Match) -> str:
        got = m.group()
        form = self._memo.get(got)
        if form is None:
            if got in self.table:
                form = self.table[got]
            else:
                parts = unicodedata.normalize("NFD", "".join(c for c in got if c not in self._gone))
                form = unicodedata.normalize("NFC", "".join(self.table.get(c, c) for c in parts))
            if len(self._memo) < 100_000:
                self._memo[got] = form
        if got[-1] == ZWJ and _pictograph(got[0]) and _pictograph(m.string[m.end() : m.end() + 1]):
            return form + ZWJ
        return form

    def __call__(self, text: str | None) -> str | None:
        """The consistent form; null stays null and '' stays ''. The form of a form is itself."""
        if text is None or (text.isascii() and "\r" not in text):
            return text
        return self._pattern.sub(self._cluster, text)


def _pictograph(ch: str) -> bool:
    """A pictograph or the skin tone after it."""
    return bool(ch) and (unicodedata.category(ch) == "So" or 0x1F3FB <= ord(ch) <= 0x1F3FF)


@lru_cache(maxsize=4)
def transducer(alike: tuple[tuple[str, str], ...] = ()) -> Transducer:
    return Transducer(alike=dict(alike))


def canonical(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, text, canon)``: every row with its text in consistent form.

    Null stays null and '' stays ''. Narrow, one pass, whole texts; extra columns are not read.
    """
    if set(keep) & {"text", "canon"}:
        raise ValueError("keep columns clash with the result's columns")
    src = df.select(*keep, F.col(text).cast("string").alias("text"))
    alike = tuple(sorted(confusable_letters(df.sparkSession).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = transducer(alike)
        for b in batches:
            out = pa.array([form(t) for t in b.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, "canon"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    return src.mapInArrow(run, f"{fields}, canon string")


def _several_writings(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``(form, raw, doc_id)`` of the texts whose form is written in more than one way, as 256-bit digests.

    Forms written in one way only are dropped by an aggregation that is combined map-side, so exact
    copies, however many, never meet. Nulls and '' are no texts.
    """
    canon = canonical(df.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("doc_id"), F.col(text).alias("text")))
    keyed = canon.select("doc_id", F.unhex(F.sha2("canon", 256)).alias("form"), F.unhex(F.sha2("text", 256)).alias("raw"))
    keyed = materialise(keyed, "forms")  # read twice; the transducer runs once
    several = keyed.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("form")
    return materialise(keyed.join(several, "form", "left_semi"), "forms")


def equal_looking(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id_a, doc_id_b)``, a < b: pairs whose texts differ but have one consistent form.

    The pairs are the result itself; where a form has very many copies ``look_classes`` says the same in
    one row per document. The join on the form is split by AQE where it is skewed. ``doc`` must be unique.
    """
    rows = _several_writings(df, doc, text)
    a = rows.select("form", F.col("doc_id").alias("doc_id_a"), F.col("raw").alias("raw_a"))
    b = rows.select("form", F.col("doc_id").alias("doc_id_b"), F.col("raw").alias("raw_b"))
    return a.join(b, "form").where("doc_id_a < doc_id_b and raw_a <> raw_b").select("doc_id_a", "doc_id_b")


def look_classes(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id, n_links)`` of every document that looks like one written otherwise.

    ``class_id`` is the smallest document of the same form, ``n_links`` the number of documents of the class
    with another text, so the links add up to twice the pairs of ``equal_looking``. Counts are combined
    map-side and one row per writing joins back, so copies are never paired. ``doc`` must be unique.
    """
    rows = _several_writings(df, doc, text)
    writing = materialise(rows.groupBy("form", "raw").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "writings")
    whole = writing.groupBy("form").agg(F.sum("n").alias("_all"), F.min("least").alias("class_id"))
    per = writing.join(whole, "form").select("raw", "class_id", (F.col("_all") - F.col("n")).alias("n_links"))
    return rows.join(per, "raw").select("doc_id", "class_id", "n_links")
