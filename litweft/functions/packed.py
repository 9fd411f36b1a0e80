"""Tokenizer for several values packed in one field.

A finite-state machine walks the field once. Its states are *gap* (between values), *bare* (inside an
unquoted value) and *quoted*; a counter keeps the nesting depth of brackets. A transition is taken at
the next character that matters in the current state; everything before it is consumed in one step by
a compiled scanner, so the cost is per token and not per character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

_OPEN, _CLOSE = "([{", ")]}"


@dataclass(frozen=True)
class Grammar:
    """How a field may be packed.

    ``separators``   characters that end a value outside quotes (and outside nested brackets)
    ``quotes``       marks that quote a value when they are its first character
    ``blank_splits`` whether a blank ends an unquoted value
    ``nested``       whether brackets inside an unquoted value protect separators
    ``escape``       a character that makes the next one literal inside quotes, or ''
    """

    separators: str = ";,|/\t\r\n"
    quotes: str = "\"'"
    blank_splits: bool = False
    nested: bool = False
    escape: str = ""


@lru_cache(maxsize=64)
def _scanners(g: Grammar) -> tuple[re.Pattern, dict[str, re.Pattern]]:
    stop = g.separators + ("  " if g.blank_splits else "") + (_OPEN + _CLOSE if g.nested else "")
    bare = re.compile(f"[^{re.escape(stop)}]*")
    quoted = {q: re.compile(f"[^{re.escape(q + g.escape)}]*") for q in g.quotes}
    return bare, quoted


def tokenize(text: str | None, g: Grammar, list_wrapper: bool = True) -> list[str]:
    """The values of ``text`` in order.

    Null, '' and fields of separators only give no value. A value without content, quoted or not, does
    not count. A quote mark quotes only as the first character of a value; a doubled mark inside stands
    for one; an unclosed quote runs to the end of the field. A closing quote ends the value: what
    follows starts the next one. With ``list_wrapper`` one pair of square brackets around the whole
    field is packing and not part of a value.
    """
    if not text:
        return []
    s = text.strip()
    if list_wrapper and len(s) > 1 and s[0] == "[" and s[-1] == "]":
        s = s[1:-1]
    bare, quoted = _scanners(g)
    gap = g.separators + "  "
    out: list[str] = []
    i, n = 0, len(s)
    while i < n:
        ch = s[i]
        if ch in gap or ch.isspace():  # state gap
            i += 1
            continue
        if ch in quoted:  # state quoted
            scan, buf, i = quoted[ch], [], i + 1
            while i < n:
                j = scan.match(s, i).end()
                buf.append(s[i:j])
                if j >= n:
                    i = n
                    break
                if g.escape and s[j] == g.escape:
                    buf.append(s[j + 1 : j + 2])
                    i = j + 2
                elif s[j + 1 : j + 2] == ch:
                    buf.append(ch)
                    i = j + 2
                else:
                    i = j + 1
                    break
            value = "".join(buf).strip()
        else:  # state bare
            start, depth = i, 0
            while i < n:
                i = bare.match(s, i).end()
                if i >= n:
                    break
                c = s[i]
                if g.nested and c in _OPEN:
                    depth += 1
                elif g.nested and c in _CLOSE:
                    depth = max(0, depth - 1)
                elif depth == 0:
                    break
                i += 1
            value = s[start:i].strip()
        if value:
            out.append(value)
    return out


_ATOM = re.compile(r"[^\s\"'()\[\]{},:;|/-]+")
_EVIDENCE = Grammar(nested=True)


def evidence_spans(text: str | None, numbers: int = 4) -> list[str]:
    """Normalised ``sent_id,start,end,start,end`` of every evidence in ``text``, in the order stored.

    The field is tokenized with nesting; what is left inside a token are brackets, quotes, ``:`` and
    ``-`` between offsets. Unquoted evidences arrive as one token per offset, all others whole, so the
    tokens' atoms are joined until one sentence id and ``numbers`` offsets are complete or the next
    sentence id begins; an incomplete evidence is kept as far as it goes.
    """
    out: list[str] = []
    cur: list[str] = []
    for token in tokenize(text, _EVIDENCE):
        for atom in _ATOM.findall(token):
            if cur and (len(cur) > numbers or not atom.isdigit()):
                out.append(",".join(cur))
                cur = []
            cur.append(atom)
    if cur:
        out.append(",".join(cur))
    return out
