"""miRNA names: parsing, normal forms, variants, enumerations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("organism", "mature", "id", "precursor", "mature_seq", "arm")
# Interchangeable spellings of an arm, spellings of the word miR, parts compared at each level.
ARMS = {"5p": ("5p", "s", ""), "3p": ("3p", "as", "*"), "s": ("5p", "s", ""), "as": ("3p", "as", "*"), "*": ("3p", "as", "*")}
MIR_WORDS = ("miR", "mir", "MiR", "Mir")
LONG_WORDS = ("microRNA", "MicroRNA", "micro-RNA", "Micro-RNA", "miRNA", "MiRNA")
LEVELS = {
    "MATUREID": ("mature", "id"),
    "PRECURSOR": ("mature", "id", "precursor"),
    "ARM": ("mature", "id", "precursor", "arm"),
    "ORGANISM": ("organism", "mature", "id", "precursor", "mature_seq", "arm"),
}
COMPOSITIONS = {
    "MIMAT": [PARTS],
    "MI": [PARTS[:5]],
    "MIORG": [PARTS[1:], ("mature", "id", "precursor", "arm"), PARTS[1:5], ("mature", "id", "precursor"), ("mature", "id", "arm"), ("mature", "id")],
    "FAMILY": [PARTS[1:], PARTS[1:5], ("mature", "id", "precursor", "arm"), ("mature", "id", "mature_seq", "arm"), ("mature", "id", "mature_seq"), ("mature", "id", "precursor"), ("mature", "id", "arm")],
}
COMPOSITIONS["MIALL"] = COMPOSITIONS["MIORG"] + [("organism", *c) for c in COMPOSITIONS["MIORG"]]

_WORD = "^((?:[a-z]{3,4}-)?)(?:[Mm]icro-?RNA|[Mm]iRNA|[Mm][Ii][Rr])-?(?=[0-9A-Z])"
_NAME = "^(?:(?!let-|mir-)([a-z]{3,4})-)?(?:(miR|[Ll][Ee][Tt])-)?(?:([0-9]+)(?:-?([a-z])(?![a-z]))?|([A-Za-z]+?)([0-9]*))(?:-([0-9]+)(?![0-9p]))?(?:-?(5p|3p|as|s|\\*))?$"


def normal_word(name: Column) -> Column:
    """The word for miRNA, however written, as 'miR-'."""
    return F.regexp_replace(name, _WORD, "$1miR-")


def parse(name: Column) -> Column:
    """struct(organism, mature, id, precursor, mature_seq, arm) of a miRNA name; absent parts are null.

    A name that does not follow the grammar has only nulls. 'miR-146-a' is read as 'miR-146a'.
    """
    n = normal_word(name)
    g = lambda i: F.nullif(F.regexp_extract(n, _NAME, i), F.lit(""))
    return F.struct(g(1).alias("organism"), g(2).alias("mature"), F.coalesce(g(3), g(5)).alias("id"), F.coalesce(g(4), g(6)).alias("precursor"), g(7).alias("mature_seq"), g(8).alias("arm"))


def compose(parts: Column, which: tuple[str, ...] = PARTS) -> Column:
    """Name from its parts joined by '-'; the precursor follows the id without one. Null if there is no id."""
    have = set(which)
    core = F.concat(parts["id"], F.coalesce(parts["precursor"], F.lit(""))) if "precursor" in have else parts["id"]
    mature = F.when(F.upper(parts["mature"]).isin("MIR", "MIRNA", "MICRORNA"), "miR").otherwise(parts["mature"])
    seq = [parts["organism"] if "organism" in have else None, mature if "mature" in have else None, core, parts["mature_seq"] if "mature_seq" in have else None]
    base = F.concat_ws("-", *(c for c in seq if c is not None))
    arm = F.when(parts["arm"] == "*", "*").otherwise(F.concat(F.lit("-"), parts["arm"]))
    full = F.concat(base, F.coalesce(arm, F.lit(""))) if "arm" in have else base
    return F.when(parts["id"].isNotNull(), full)


def same(a: Column, b: Column, level: str = "MATUREID") -> Column:
    """Do two parsed names agree in all parts of a level? A part that is missing in ``b`` never agrees."""
    ok = F.lit(True)
    for p in LEVELS[level]:
        ok = ok & F.coalesce(a[p] == b[p], F.lit(False))
    return ok


def variants(organism: str | None, mature: str | None, ident: str, precursor: str | None = None, mature_seq: str | None = None, arm: str | None = None, which: tuple[str, ...] = PARTS) -> list[str]:
    """Spellings of one name, in order without repeats: with and without '-', arm alternatives, words for miRNA."""
    use = lambda p, v: (v or "") if p in which else ""
    org, mat = use("organism", organism), use("mature", mature)
    tail = "-".join(x for x in (use("id", ident) + use("precursor", precursor), use("mature_seq", mature_seq)) if x)
    a = use("arm", arm)
    arms = ARMS.get(a, (a,)) if a else ("",)
    words = [mat] if not mat or mat.upper() != "MIR" else list(MIR_WORDS)
    if not org:
        words += LONG_WORDS
    out: list[str] = []
    for w in words:
        made = []
        for x in arms:
            end = tail + ("*" if x == "*" else f"-{x}" if x else "")
            head = "-".join(p for p in (org, w) if p)
            made += [f"{head}-{end}", head + end] if head else [end] if end else []
        out += made
        if not org:
            out += [m + "-mediated" for m in made]
    return list(dict.fromkeys(out))


_ITEM = re.compile(r"(?:^miR-|/-?)(?P<num>[0-9]*)(?P<var>[a-z]?)(?:-(?P<prec>[0-9])(?=[-/]))?(?P<mod>-[35]p)?(?=/|$)")


def expand(text: str | None) -> list[str]:
    """Members of an enumeration such as 'miR-15a/b/-16-5p': ['miR-15a', 'miR-15b', 'miR-16-5p'].

    A member without a number takes that of the one before; members are cut at '/'. Anything that does
    not follow the grammar, or has one member only, is returned as it is; null gives [].
    """
    if not text:
        return []
    at, found, number = 0, [], ""
    while at < len(text) and (m := _ITEM.match(text, at)):
        if m.end() == at:
            break
        number = m["num"] or number
        if number and (m["num"] or m["var"] or m["mod"] or m["prec"]):
            found.append(f"miR-{number}{m['var']}{'-' + m['prec'] if m['prec'] else ''}{m['mod'] or ''}")
        at = m.end()
    return found if at == len(text) and len(found) > 1 else [text]
