"""Projections, sort/limit and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.util import col_of, quote


class SchemaMismatch(ValueError):
    pass


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-1: canonical names by position; a column-count mismatch is an error."""
    if len(df.columns) != len(names):
        raise SchemaMismatch(f"expected {len(names)} columns, got {len(df.columns)}")
    return df.toDF(*names)


def select_renamed(df: DataFrame, mapping: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """PRJ-2: keep only the mapped source columns, renamed; a missing source
    column is an error (names may hold dots or spaces)."""
    pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    missing = [s for s, _ in pairs if s not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")
    return df.select(*[col_of(s).alias(d) for s, d in pairs])


def insert_copy(df: DataFrame, src: str, dst: str, position: int) -> DataFrame:
    """PRJ-3: insert a copy of ``src`` named ``dst`` at 0-based ``position``."""
    cols = [col_of(c) for c in df.columns]
    cols.insert(position, col_of(src).alias(dst))
    return df.select(*cols)


def cast_to_types(df: DataFrame, types: Mapping[str, str], default: str = "string",
                  lenient: bool = False) -> DataFrame:
    """PRJ-5: each column to its declared type (default text)."""
    def cast(c):
        t = types.get(c, default)
        return (col_of(c).try_cast(t) if lenient else col_of(c).cast(t)).alias(c)
    return df.select(*[cast(c) for c in df.columns])


def all_text(df: DataFrame) -> DataFrame:
    """SNK-4's table shape: every column as text."""
    return df.select(*[col_of(c).cast("string").alias(c) for c in df.columns])


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-1."""
    return a.unionByName(b).distinct()


def first_n(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """LIM-1 (after SRT-1 when an order is given): a top-n, not a sample."""
    if order_by:
        df = df.orderBy(*[quote(c) for c in order_by])
    return df.limit(n)
