"""Aggregations.

All but AG-1 are one hash/object-hash aggregate with a map-side partial
step, so a hot key (even a third of all rows) ships only its partial
buffers across the shuffle. AG-1 ships each row as one packed text, which is
less than the sets of its many columns are; the rows of a hot key stream
through one task, which keeps their distinct values. The size of each output
cell is the semantic bound: AG-1 writes every distinct value of a group into
one text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.strings import pack_texts, unpack_texts
from quayside.functions.util import col_of, quote
from quayside.functions.values import number_text


def distinct_rollup(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    sep: str = ";", null_text: Mapping[str, str] | None = None) -> DataFrame:
    """AG-1 (+ SCL-L1, SRT-3): one row per key; each value column becomes its
    sorted distinct values joined by ``sep``.

    Past 128 keys a task's object-hash aggregate goes on sorted, spilling, and
    holds the sets of one key at a time: what one output row is made of.

    Nulls (keys and values) become ``''`` before grouping, so a null shows up
    as a leading empty item (``;a;b``) and null keys form the ``''`` group;
    ``null_text`` gives a column another text for null (Q1). Doubles are written
    without an exponent (Q2). Order is binary UTF-8 order, i.e. code-point order."""
    kinds, nulls = dict(df.dtypes), dict(null_text or {})

    def text(c: str):
        shown = number_text(c) if kinds.get(c) in ("double", "float") else col_of(c).cast("string")
        return F.coalesce(shown, F.lit(nulls.get(c, ""))).alias(c)
    filled = df.select(*[text(c) for c in (*keys, *cols)])
    by = [quote(k) for k in keys]
    dealt = filled.select(*by, pack_texts(cols).alias("__row")).repartition(*by)
    cells = dealt.select(*by, unpack_texts("__row").alias("__row"))
    return cells.groupBy(*by).agg(
        *[F.array_join(F.sort_array(F.collect_set(F.get("__row", F.lit(i)))), sep).alias(c) for i, c in enumerate(cols)])


def ordered_concat(df: DataFrame, keys: Sequence[str], value: str,
                   order_by: Sequence[str] | None = None, sep: str = ";",
                   out: str | None = None) -> DataFrame:
    """AG-2: rows with a null key are dropped; per key, ``value`` items are
    joined by ``sep`` in ``order_by`` order (default: the value itself),
    duplicates kept (Q5, Q6). A null value in a row that stays raises, since
    leaving it out would change the list without a trace.

    Equal items (same key, order and value) are counted first. Then the rows are
    dealt by range of (key, order, value): a hot key is spread over neighbouring
    partitions, each of which joins its own piece, and the pieces of a key are
    joined in the order of their partitions. So no task holds more than its
    range; the last step has one text a key and partition."""
    order = list(order_by or [value])
    order += [value] if value not in order else []
    kept = df.dropna(subset=list(keys)).withColumn(value, F.coalesce(
        col_of(value), F.raise_error(F.lit(f"{value} is null")).cast("string")))
    by = [quote(c) for c in (*keys, *order)]
    items = kept.groupBy(*dict.fromkeys(by)).agg(F.count(F.lit(1)).alias("__n"))
    piece = items.repartitionByRange(*dict.fromkeys(by)).withColumn("__piece", F.spark_partition_id())
    text = F.array_join(F.array_repeat(col_of(value), F.col("__n").cast("int")), sep)
    piece = piece.select(*[col_of(c) for c in keys], "__piece", *[F.col(o).alias(f"__o{i}") for i, o in enumerate(map(quote, order))],
                         text.alias("__text"))
    glue = sep.replace("\\", "\\\\").replace("'", "\\'")
    listed = lambda col, by: F.expr(f"listagg({col}, '{glue}') WITHIN GROUP (ORDER BY {by})")
    own = [quote(k) for k in keys]
    pieces = piece.groupBy(*own, "__piece").agg(
        listed("__text", ", ".join(f"__o{i}" for i in range(len(order)))).alias("__text"))
    return pieces.groupBy(*own).agg(listed("__text", "__piece").alias(out or value))


def nested_options(df: DataFrame, key: str, value: str, label: str,
                   out: str = "options") -> DataFrame:
    """AG-5: key → list of ``{value, label}`` structs, value descending."""
    return df.groupBy(quote(key)).agg(
        F.sort_array(F.collect_list(F.struct(col_of(value).alias("value"),
                                             col_of(label).alias("label"))),
                     asc=False).alias(out))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AG-4: distinct values of one column, null kept as a value."""
    return df.select(col_of(col)).distinct()


def files_per_folder(files: DataFrame, folder_col: str = "folder_path",
                     name_col: str = "file_name", out: str = "file_names") -> DataFrame:
    """AG-9 (names): the sorted file names of each folder."""
    return files.groupBy(quote(folder_col)).agg(
        F.sort_array(F.collect_list(col_of(name_col))).alias(out))
