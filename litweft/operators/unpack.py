"""Several values packed in one field -> one row per value with its position."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litweft.functions.packed import Grammar, evidence_spans, tokenize

#: Grammar by kind of field. Blanks belong to an organism's name but never to a document id.
NAMES = Grammar()
IDS = Grammar(blank_splits=True)
NESTED = Grammar(nested=True)
SPANS = "spans"


def _split(kind: Grammar | str):
    if kind == SPANS:
        return evidence_spans
    return lambda text: tokenize(text, kind)


def unpack(df: DataFrame, fields: Mapping[str, Grammar | str], keep: Iterable[str]) -> DataFrame:
    """Rows ``(*keep, field_name string, pos int, val string)``, one per value of each of ``fields``.

    Narrow: no shuffle, one pass over the rows, all fields of a row in the same pass. The tokenizer
    runs on Arrow batches; repeated encodings inside a batch are tokenized once (dictionary encoding).
    Null, empty and separator-only fields give no row; rows repeat as often as they are stored; extra
    columns of ``df`` are not read, so their names may clash with the output's. ``keep`` must not
    contain ``field_name``, ``pos`` or ``val`` (ValueError). Empty input gives an empty result.
    """
    keep = list(keep)
    if set(keep) & {"field_name", "pos", "val", "_values"}:
        raise ValueError("keep columns clash with the result's columns")
    names = list(fields)
    src = df.select(*keep, *(F.col(f).alias(f"_f{i}") for i, f in enumerate(names)))
    kinds = [fields[f] for f in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = [_split(k) for k in kinds]
        for b in batches:
            cols = []
            for i, split in enumerate(splits):
                enc = b.column(len(keep) + i).dictionary_encode()
                values = pa.array([split(v) for v in enc.dictionary.to_pylist()], pa.list_(pa.string()))
                cols.append(values.take(enc.indices) if len(values) else pa.nulls(b.num_rows, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*keep, *(f"_v{i}" for i in range(len(names)))])

    fields_ddl = [f"`{c.name}` {c.dataType.simpleString()}" for c in src.schema.fields[: len(keep)]]
    schema = ", ".join([*fields_ddl, *(f"_v{i} array<string>" for i in range(len(names)))])
    packed = src.mapInArrow(run, schema)
    by_field = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"_v{i}").alias("vals")) for i, f in enumerate(names)))
    return (
        packed.select(*keep, F.explode(by_field).alias("_e"))
        .select(*keep, F.col("_e.field_name").alias("field_name"), F.posexplode("_e.vals").alias("pos", "val"))
    )
