"""Column-level text helpers: sentence ids, hit and sentence filters, windows, tagging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that bound a word, and those of them that a collapsed variant turns into one blank.
BOUNDARY = " ,.;:-()[]{}=!\"§$%&/=?+*'#-"
COLLAPSED = BOUNDARY[5:]
CAPTIONS = ("Table ", "Figure ", "Tab. ", "Fig. ")


def sentence_parts(sent_id: Column) -> Column:
    """struct(doc_id, par_id, sen_id) of 'doc.par.sen'; parts that are missing or no numbers are null."""
    p = F.split(sent_id, "\\.")
    return F.struct(F.get(p, F.lit(0)).alias("doc_id"), F.get(p, F.lit(1)).try_cast("int").alias("par_id"), F.get(p, F.lit(2)).try_cast("int").alias("sen_id"))


def upper_same_length(text: Column) -> Column:
    """Upper case that keeps every position ('ß' becomes one capital)."""
    return F.upper(F.translate(text, "ß", "ẞ"))


def collapse(text: Column, chars: str = COLLAPSED) -> Column:
    """Every run of separator characters becomes one blank."""
    cls = "".join("\\" + c if c in "[]{}()-+*?.$^|&/\\#'\"=!" else c for c in dict.fromkeys(chars))
    return F.regexp_replace(text, f"[{cls}]+", " ")


_STRIP = "[\\s()\\[\\],;.]"


def strong_hit(found: Column, prefix: Column, suffix: Column, exact: Column) -> Column:
    """Hits of 2 to 5 characters must be exact and stand alone; others always pass."""
    bare = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), f"^{_STRIP}+|{_STRIP}+$", "")) == 0
    return ~F.length(found).between(2, 5) | (bare(prefix) & bare(suffix) & F.coalesce(exact, F.lit(False)))


def mirna_hit(found: Column, prefix: Column) -> Column:
    """A four-character prefix ending in '-' must name human or mouse; short hits must begin like a miRNA."""
    organism = F.when((F.length(prefix) == 4) & F.endswith(prefix, F.lit("-")), F.lower(prefix).isin("mmu-", "hsa-")).otherwise(True)
    begins = F.when(F.length(found) <= 5, F.lower(found).rlike("^(mir|micro|let)")).otherwise(True)
    return F.coalesce(organism, F.lit(True)) & begins


def context_hit(found: Column, exact: Column) -> Column:
    """Context hits under six characters must be exact; hits with 'and ' inside do not count."""
    return (~(F.length(found) < 6) | F.coalesce(exact, F.lit(False))) & ~F.contains(found, F.lit("and "))


def usable_sentence(text: Column, longest: int = 500) -> Column:
    """Not too long and no caption."""
    ok = F.length(text) <= longest
    for c in CAPTIONS:
        ok = ok & ~text.startswith(c)
    return ok


def long_enough(text: Column, doc_id: Column, full_text: int = 5, abstract: int = 0) -> Column:
    """Sentences over the least length of their kind of document."""
    return F.length(F.trim(text)) > F.when(doc_id.startswith("PMC"), full_text).otherwise(abstract)


def slice0(text: Column, start: Column, end: Column) -> Column:
    """Half-open slice with positions from 0."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def around(text: Column, a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """struct(before, between, after, order) around two spans; order 'AB', 'BA', or null if they overlap."""
    ab = F.when(a_end <= b_start, F.lit("AB")).when(b_end <= a_start, F.lit("BA"))
    first, last = F.least(a_start, b_start), F.greatest(a_end, b_end)
    return F.struct(slice0(text, F.lit(0), first).alias("before"), slice0(text, F.least(a_end, b_end), F.greatest(a_start, b_start)).alias("between"), slice0(text, last, F.length(text)).alias("after"), ab.alias("order"))


def tag_pair(text: Column, a_start: Column, a_end: Column, b_start: Column, b_end: Column, names: tuple[str, str] = ("e1", "e2")) -> Column:
    """The text with the two spans in tags; null if they overlap."""
    t = lambda s, e, n: F.concat(F.lit(f"<{n}>"), slice0(text, s, e), F.lit(f"</{n}>"))
    n = F.length(text)
    ab = F.concat(slice0(text, F.lit(0), a_start), t(a_start, a_end, names[0]), slice0(text, a_end, b_start), t(b_start, b_end, names[1]), slice0(text, b_end, n))
    ba = F.concat(slice0(text, F.lit(0), b_start), t(b_start, b_end, names[1]), slice0(text, b_end, a_start), t(a_start, a_end, names[0]), slice0(text, a_end, n))
    return F.when(a_end <= b_start, ab).when(b_end <= a_start, ba)


def highlight(text: Column, spans: Column, left: str = "<b>", right: str = "</b>") -> Column:
    """The text with every span of an array<struct<start,end>> marked; spans must not overlap.

    Spans are applied from right to left, so earlier positions stay valid.
    """
    ordered = F.reverse(F.array_sort(spans))
    put = lambda acc, s: F.concat(slice0(acc, F.lit(0), s["start"]), F.lit(left), slice0(acc, s["start"], s["end"]), F.lit(right), slice0(acc, s["end"], F.length(acc)))
    return F.aggregate(ordered, text, put)


def complement(dna: Column, reverse: bool = True) -> Column:
    """Complement of a DNA text; reversed for the other strand unless told otherwise."""
    c = F.translate(dna, "ACGTacgt", "TGCAtgca")
    return F.reverse(c) if reverse else c
