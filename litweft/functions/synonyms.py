"""Synonym lists: cleaning, variants, exclusion. Lists are array<string> columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no synonyms; lists compared as written (all others also in upper case).
NO_SYNONYM = ("SYMBOL WITHDRAWN", "WITHDRAWN", "PSEUDOGENE", "RNA", "ENTRY WITHDRAWN")
CASE_LISTS = ("taxnames", "manual")


def clean(s: Column) -> Column:
    """One synonym in its clean form, or null if it is none.

    Outer blanks and one pair of double quotes go, withdrawal marks go, '|' becomes '-', runs of blanks
    become one. Fewer than three characters, no letter, or a stop word: null.
    """
    s = F.trim(s)
    s = F.when(F.length(s) >= 3, s)
    s = F.when(s.rlike('^"(?s:.*)"$'), F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)
    s = F.when(F.length(s) >= 3, s)
    s = F.regexp_replace(s, "^symbol withdrawn, ", "")
    s = F.regexp_replace(s, "^see ", "")
    s = F.regexp_replace(s, "~withdrawn$", "")
    s = F.translate(s, "|", "-")
    s = F.regexp_replace(s, "\\s\\s+", " ")
    return F.when(~F.upper(s).isin(*NO_SYNONYM) & s.rlike("[^0-9\\W]"), s)


def clean_list(syns: Column) -> Column:
    """Clean distinct synonyms in first-seen order."""
    return F.array_distinct(F.filter(F.transform(syns, clean), lambda x: x.isNotNull()))


def hyphen_variants(syns: Column) -> Column:
    """Adds 'ABC-1' for 'ABC1' and 'ABC-1A' for 'ABC1A' (also B); identifiers HGNC… and MGI… stay alone."""
    free = F.filter(syns, lambda x: ~x.rlike("^(HGNC|MGI)"))
    one = F.filter(free, lambda x: x.rlike("[A-Za-z][0-9]+[AB]?$"))
    return F.array_distinct(F.concat(syns, F.transform(one, lambda x: F.regexp_replace(x, "([A-Za-z])([0-9]+[AB]?)$", "$1-$2"))))


def greek_variants(syns: Column) -> Column:
    """Greek letters for words: where a synonym ends in 'alpha' ('beta'), a final capital A (B) of the list's
    synonyms may be written as the letter, with and without '-'; inner and final words alpha, beta, gamma too."""
    none = F.array().cast("array<string>")
    out = syns

    def final(cap: str, word: str, letter: str) -> Column:
        named = F.exists(syns, lambda x: F.endswith(F.lower(x), F.lit(word)))
        ends = F.filter(syns, lambda x: F.endswith(x, F.lit(cap)))
        plain, dashed = (_swap(ends, f"{cap}$", d + letter) for d in ("", "-"))
        return F.when(named, F.concat(plain, dashed)).otherwise(none)

    def inner(word: str, letter: str) -> Column:
        tail = F.filter(syns, lambda x: F.endswith(x, F.lit(word)))
        mid = F.filter(syns, lambda x: F.contains(x, F.lit(f" {word} ")))
        return F.concat(_swap(tail, f"{word}$", letter), _swap(mid, word, letter), _swap(mid, f" {word} ", letter))

    for cap, word, letter in (("A", "alpha", "α"), ("B", "beta", "β")):
        out = F.concat(out, final(cap, word, letter))
    for word, letter in (("alpha", "α"), ("beta", "β"), ("gamma", "γ")):
        out = F.concat(out, inner(word, letter))
    return F.array_distinct(out)


def _swap(xs: Column, pattern: str, by: str) -> Column:
    return F.transform(xs, lambda x: F.regexp_replace(x, pattern, by))


def without_excluded(syns: Column, lists: Mapping[str, Sequence[str]]) -> Column:
    """Drops synonyms in an exclude list; lists other than taxnames and manual also match the upper-cased synonym."""
    exact = sorted({w for n in lists for w in lists[n]})
    upper = sorted({w for n in lists if n not in CASE_LISTS for w in lists[n]})
    return F.filter(syns, lambda x: ~x.isin(exact) & ~F.upper(x).isin(upper)) if exact else syns


def without_numbers(syns: Column) -> Column:
    """Drops numbers and single characters."""
    return F.filter(syns, lambda x: ~x.rlike("^[+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?$") & (F.length(x) > 1))


def matches(syns: Column, word: Column) -> Column:
    """Is a word among the synonyms, in any case? Null lists have none."""
    return F.coalesce(F.exists(syns, lambda x: F.lower(x) == F.lower(word)), F.lit(False))


def merge(a: Column, b: Column) -> Column:
    """The distinct synonyms of both lists, those of the first in front; a null list is empty."""
    none = F.array().cast("array<string>")
    return F.array_union(F.coalesce(a, none), F.coalesce(b, none))


def remove(syns: Column, word: Column) -> Column:
    """The list without a word, as it is written."""
    return F.filter(syns, lambda x: x != word)


def is_number(text: Column) -> Column:
    """A decimal number with an optional sign and exponent; null is none."""
    return F.coalesce(text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), F.lit(False))


def has_digit_and_letter(text: Column) -> Column:
    """A text with both a digit and a Latin letter; null is none."""
    return F.coalesce(text.rlike("[0-9]") & text.rlike("[A-Za-z]"), F.lit(False))


def unfindable(term_id: Column) -> Column:
    """An id that no text contains."""
    return F.concat(F.lit("__"), term_id, F.lit("__"))


def invert_cell(name: Column) -> Column:
    """'X cell of Y' -> 'Y X cell'; other names unchanged."""
    return F.regexp_replace(name, "^(.+ cell) of (.+)$", "$2 $1")


def acronym(name: Column) -> Column:
    """Initials of a name of two to four words whose last word is 'cell', else null."""
    words = F.split(F.upper(name), " ")
    return F.when(F.size(words).between(2, 4) & (F.element_at(words, -1) == "CELL"), F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))


def is_gene_symbol(symbol: Column) -> Column:
    """MIR… symbols are miRNAs unless they end in HG (host genes)."""
    return ~symbol.rlike("^(?i)MIR") | symbol.rlike("(?i)HG$")


def line(term_id: Column, syns: Column) -> Column:
    """The line 'id:syn|syn' of a synonym file; ':' in the id becomes '_'."""
    return F.concat(F.translate(term_id, ":", "_"), F.lit(":"), F.array_join(F.filter(syns, lambda x: F.length(x) > 0), "|"))


def from_line(text: Column) -> Column:
    """struct(syn_id, syns) of a line; the id itself is a synonym."""
    p = F.split(text, ":", 2)
    ident = F.get(p, F.lit(0))
    return F.struct(ident.alias("syn_id"), F.array_distinct(F.filter(F.concat(F.array(ident), F.split(F.coalesce(F.get(p, F.lit(1)), F.lit("")), "\\|")), lambda x: x != "")).alias("syns"))
