"""Encoding of a corpus with a public tokenizer, over Arrow batches."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters handed to the tokenizer in one call; a longer text is a call of its own.
CALL_CHARS = 1 << 20
#: Pieces whose ids a Python worker remembers; it starts afresh when they are reached. Longer pieces than PIECE_CHARS are not kept.
PIECES, PIECE_CHARS = 200_000, 64
# Fixed value: the pattern by which byte-level vocabularies of this family cut a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str = "byte_bpe_50k.json", root: str | None = None) -> str:
    """Place of a public vocabulary: ``root``, else $LITWEFT_TOKENIZERS, else the installed package."""
    root = root or os.environ.get("LITWEFT_TOKENIZERS")
    if root:
        return f"{root.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # strings of special tokens in a text are ordinary text
    t.no_truncation()
    t.no_padding()
    return t


def _calls(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about CALL_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > CALL_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _clean(text: str | None) -> str:
    return text or ""


class _Pieces(dict):
    """Ids of pieces of text, each encoded once by the library and then remembered by this worker.

    A byte-level vocabulary never merges across its pieces, so the ids of a text are those of its pieces one
    after the other; a corpus repeats most of its pieces. Texts with code points that this interpreter's
    character database does not know are encoded whole, as two libraries may class such a code point
    differently; so are all texts of a vocabulary that cuts in another way.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tok = _tokenizer(path)
        self.any = regex.compile(PATTERN).findall
        self.ascii = re.compile(PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+"), re.ASCII).findall
        self.whole = not self._cuts_alike()
        self.known: set[str] = set()  # characters seen that the database assigns

    def _cuts_alike(self) -> bool:
        pre = self.tok.pre_tokenizer
        probe = " It's 12 x²,  they'll\n\tsay: naïve\u00a0ж9 …don't  "
        if pre is None or self.tok.normalizer is not None or "ByteLevel" not in str(pre):
            return False
        return [probe[i:j] for _, (i, j) in pre.pre_tokenize_str(probe)] == self.any(probe)

    def _assigned(self, text: str) -> bool:
        fresh = set(text) - self.known
        if any(unicodedata.category(c) == "Cn" for c in fresh):
            return False
        self.known |= fresh
        return True

    def __missing__(self, piece: str) -> list[int]:
        ids = self.tok.encode(piece, add_special_tokens=False).ids
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> list[list[int]]:
        """Ids of the text's pieces."""
        if not text:
            return []
        if self.whole or not (text.isascii() or self._assigned(text)):
            return [self.tok.encode(text, add_special_tokens=False).ids]
        return [self[p] for p in (self.ascii if text.isascii() else self.any)(text)]


@lru_cache(maxsize=4)
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def encode(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, offsets: bool = False) -> DataFrame:
    """``(*keep, ids array<int>)`` of every row, without special tokens; with ``offsets`` also ``spans``.

    Null and empty texts give the empty list, so every row stays. Whole texts are encoded. ``spans``
    holds the half-open character range of every token: a token inside a character (byte-level tokens
    of one multi-byte character) gets that character's whole range, so ranges may repeat but never cut
    a character. Without ``offsets`` every distinct piece of text is encoded once by a worker and
    remembered (``_Pieces``). Narrow: no shuffle. ``keep`` must not contain the names of the result's columns.
    """
    path = path or tokenizer_path()
    if set(keep) & {"ids", "spans"}:
        raise ValueError("keep columns clash with the result's columns")
    src = df.select(*keep, F.col(text).alias("_text"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + ([T.StructField("spans", span)] if offsets else [])
    schema = T.StructType([*src.schema.fields[: len(keep)], *extra])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            for i, j in _calls(texts):
                cols = [c.slice(i, j - i) for c in b.columns[: len(keep)]]
                if offsets:
                    encs = _tokenizer(path).encode_batch([_clean(t) for t in texts[i:j]], add_special_tokens=False)
                    cols.append(pa.array([e.ids for e in encs], pa.list_(pa.int32())))
                    cols.append(pa.array([[{"start": s, "end": t} for s, t in e.offsets] for e in encs], span_type))
                else:
                    cols.append(pa.array([list(chain.from_iterable(_pieces(path).ids(_clean(t)))) for t in texts[i:j]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """``(*keep, n_tokens long)``; 0 for null and empty texts. The ids themselves never leave the Python worker."""
    path = path or tokenizer_path()
    if "n_tokens" in keep:
        raise ValueError("keep columns clash with the result's columns")
    src = df.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([*src.schema.fields[: len(keep)], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _pieces(path).ids
        for b in batches:
            n = pa.array([sum(map(len, ids(_clean(t)))) for t in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], n], names=schema.names)

    return src.mapInArrow(run, schema)


@lru_cache(maxsize=4)
def _byte_table(path: str) -> list[bytes]:
    """Bytes of every token id: the vocabulary's visible characters mapped back to bytes.

    Byte-level vocabularies write printable Latin-1 bytes as themselves and number the others from
    U+0100 on, in rising order.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab = _tokenizer(path).get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        table[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return table


def decode(df: DataFrame, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, pieces: bool = False) -> DataFrame:
    """``(*keep, text)`` of lists of ids; with ``pieces`` also the text that each id adds.

    Bytes are joined before they are decoded, so a character split over tokens comes back whole; in
    ``pieces`` it belongs to the token that completes it and the tokens before add ''. Bytes that never
    become a character are U+FFFD. Null lists give null, empty lists ''. Unknown ids raise.
    """
    import codecs

    path = path or tokenizer_path()
    src = df.select(*keep, F.col(ids).alias("_ids"))
    extra = [T.StructField("text", T.StringType())] + ([T.StructField("pieces", T.ArrayType(T.StringType()))] if pieces else [])
    schema = T.StructType([*src.schema.fields[: len(keep)], *extra])

    def one(table: list[bytes], xs: list[int]) -> list[str]:
        dec = codecs.getincrementaldecoder("utf-8")("replace")
        out = [dec.decode(table[x]) for x in xs]
        tail = dec.decode(b"", True)
        if tail and out:
            out[-1] += tail
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(path)
        for b in batches:
            lists = b.column(len(keep)).to_pylist()
            if pieces:
                ps = [None if x is None else one(table, x) for x in lists]
                texts = [None if p is None else "".join(p) for p in ps]
            else:
                texts = [None if x is None else b"".join([table[i] for i in x]).decode("utf-8", "replace") for x in lists]
            cols = [*b.columns[: len(keep)], pa.array(texts, pa.string())]
            if pieces:
                cols.append(pa.array(ps, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)
