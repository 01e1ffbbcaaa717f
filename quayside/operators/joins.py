"""Joins.

Plain equi-joins: which side is broadcast is left to Spark's size estimates
and to AQE's measured sizes, so no job runs while a plan is built. A prefix
join (JN-4, JN-6) is one exact equi-join: every key is exploded once into its
prefixes of the lengths that stems have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.strings import pack_texts, unpack_texts
from quayside.functions.util import col_of, quote


def lookup_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN-1: left equi-join to a lookup (a repeated lookup key fans out, as in
    SQL)."""
    return _equi(df, lookup, left_key, right_key, "left")


def _equi(df: DataFrame, other: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """Equi-join on one key; a key named alike on both sides is kept once."""
    if left_key == right_key:
        return df.join(other, [left_key], how)
    return df.join(other, df[quote(left_key)] == other[quote(right_key)], how)


def computed_key_left(df: DataFrame, key_expr: Column, other: DataFrame, other_key: str,
                      key_name: str = "__join_key") -> DataFrame:
    """JN-2: left join on a derived key (e.g. SCL-S12's leading-zero rule)."""
    left = df.withColumn(key_name, key_expr)
    return left.join(other, left[key_name] == other[quote(other_key)], "left").drop(key_name)


def _stem_lengths(stems: DataFrame, stem_col: str) -> list[int]:
    # The one job that runs while a plan is built: one small integer per
    # distinct length, at most as many as the longest stem has characters.
    rows = stems.select(F.length(col_of(stem_col)).alias("n")).distinct().collect()
    return sorted(r["n"] for r in rows if r["n"])


def prefix_join(df: DataFrame, key_col: str, stems: DataFrame, stem_col: str,
                how: str = "inner") -> DataFrame:
    """JN-4: rows of ``df`` whose ``key_col`` starts with a stem, paired with
    that stem's row (``how`` = inner or left_semi), or JN-6 (``left_anti``):
    rows whose key starts with no stem. Literal prefixes (Q9).

    A stem of length 0 matches nothing: as a prefix it would match every row,
    delete whole tables or pair all with all. Callers set such stems aside
    (``empty_stems``)."""
    lengths = _stem_lengths(stems, stem_col)
    if not lengths:  # the optimizer folds these to an empty relation or to df
        return {"left_anti": df, "left_semi": df.filter(F.lit(False))}.get(
            how, df.join(stems, F.lit(False), "inner"))
    key = col_of(key_col)
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(key)),
                           lambda n: F.substring(key, F.lit(1), n))
    if how == "inner":
        cut = df.withColumn("__prefix", F.explode(prefixes))
        return cut.join(stems, cut["__prefix"] == stems[quote(stem_col)], "inner").drop("__prefix")
    keys = df.select(key.alias("__key")).distinct()
    cut = keys.select("__key", F.explode(F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("__key")),
        lambda n: F.substring(F.col("__key"), F.lit(1), n))).alias("__prefix"))
    hits = cut.join(stems.select(col_of(stem_col).alias("__stem")).distinct(),
                    F.col("__prefix") == F.col("__stem"), "left_semi").select("__key").distinct()
    return df.join(hits, key == F.col("__key"), how)


def empty_stems(df: DataFrame, stem_col: str) -> DataFrame:
    """Rows whose stem is empty or null: they name no prefix."""
    stem = col_of(stem_col)
    return df.filter(stem.isNull() | (F.length(stem) == 0))


def snapshot_changes(new: DataFrame, old: DataFrame, keys: Sequence[str],
                     cols: Sequence[str], column_name: str = "ChangedColumn",
                     old_name: str = "OldValue", new_name: str = "NewValue") -> DataFrame:
    """JN-5 (our definition, the reference's query text is not available):
    keys present in both snapshots, one row per column whose text differs
    (null-safe). Keys found on one side only are not reported.

    Plan: one equi-join of the two snapshots on the keys (both sides hash
    partitioned on the keys; bucketed tables avoid the exchange), each row's
    columns packed into one text; only rows that differ are unpacked, and only
    the columns that differ are unpivoted."""
    def packed(df, name):
        return df.select(*[col_of(k) for k in keys], pack_texts([col_of(c).cast("string") for c in cols]).alias(name))
    # Spark takes a packed text for one short cell: a snapshot is not to be broadcast on that
    j = packed(new, "__new").join(packed(old, "__old").hint("merge"), [*keys], "inner").filter(F.col("__new") != F.col("__old"))
    j = j.select(*[col_of(k) for k in keys], unpack_texts("__new").alias("__new"), unpack_texts("__old").alias("__old"))
    n, o = [[F.get(side, F.lit(i)) for i in range(len(cols))] for side in ("__new", "__old")]
    pairs = F.array_compact(F.array(*[
        F.when(~o[i].eqNullSafe(n[i]), F.struct(F.lit(c).alias("c"), o[i].alias("o"), n[i].alias("n")))
        for i, c in enumerate(cols)]))
    return (j.select(*[col_of(k) for k in keys], F.explode(pairs).alias("__p"))
            .select(*[col_of(k) for k in keys], F.col("__p.c").alias(column_name),
                    F.col("__p.o").alias(old_name), F.col("__p.n").alias(new_name)))


def codes_inner(df: DataFrame, codes: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN-3: inner join to a code table that may list a code several times;
    callers apply DISTINCT (as the reference does)."""
    return _equi(df, codes, left_key, right_key, "inner")
