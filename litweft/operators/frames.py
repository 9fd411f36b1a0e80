"""Row-frame conveniences: append, default columns, lookups, mappings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; the columns must be the same (ValueError)."""
    if set(a.columns) != set(b.columns):
        raise ValueError("columns differ")
    return a.unionByName(b)


def add_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """New columns with default values; existing ones are an error."""
    if clash := set(defaults) & set(df.columns):
        raise ValueError(f"columns exist: {sorted(clash)}")
    return df.withColumns({k: F.lit(v) for k, v in defaults.items()})


def first_row(df: DataFrame, column: str, value: object, order: Sequence[str]) -> DataFrame:
    """The first row, in ``order``, whose column equals the value."""
    return df.where(F.col(column) == F.lit(value)).orderBy(*order).limit(1)


def rows_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose column is one of the values."""
    return df.where(F.col(column).isin(list(values)))


def apply_column(df: DataFrame, column: str, f: Callable[[Column], Column]) -> DataFrame:
    """A column rewritten by an expression."""
    return df.withColumn(column, f(F.col(column)))


def to_map(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row with a map of two columns; of a repeated key the last by ``order`` counts. For small frames."""
    last = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))
    return last.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("map"))


def group_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)``: the distinct values of every key, one per row, for keys with very many values."""
    return df.where(F.col(value).isNotNull()).select(key, value).distinct()


def group_sets(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, values)``: the sorted set of values of every key, null ones left out. A set is one array in memory; for
    keys that may have millions of values take ``group_rows``."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values"))
