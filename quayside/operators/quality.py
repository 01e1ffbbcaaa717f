"""Bad-row salvage (SNK-16) and length checks (PRJ-5 text(255)).

The reference inserts 50,000-row batches and, when a batch hits a data
error, retries row by row and skips the bad rows. Here the same split is a
column predicate evaluated once per row, in parallel: a row is bad when
some input cell is non-null but its cast to the target type is null (or
text exceeds its declared length). Good rows are cast; bad rows keep their
raw text plus a reason, for a quarantine table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.util import col_of

REASON = "reject_reason"


def _problems(df: DataFrame, types: Mapping[str, str], max_lengths: Mapping[str, int]):
    checks = []
    for c in df.columns:
        t = types.get(c)
        if t and t != "string":
            bad = col_of(c).isNotNull() & col_of(c).try_cast(t).isNull()
            checks.append(F.when(bad, F.lit(f"{c}: not {t}")))
        n = max_lengths.get(c)
        if n:
            checks.append(F.when(F.length(col_of(c).cast("string")) > n, F.lit(f"{c}: longer than {n}")))
    return F.concat_ws("; ", *checks) if checks else F.lit("")


def with_reasons(df: DataFrame, types: Mapping[str, str],
                 max_lengths: Mapping[str, int] | None = None,
                 required: tuple[str, ...] = ()) -> DataFrame:
    """The raw rows plus ``reject_reason`` (``''`` for a good row)."""
    reason = _problems(df, types, max_lengths or {})
    for r in required:
        reason = F.concat_ws("; ", F.nullif(reason, F.lit("")),
                             F.when(col_of(r).isNull(), F.lit(f"{r}: missing")))
    return df.withColumn(REASON, reason)


def split_tagged(tagged: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` from rows that carry ``reject_reason``."""
    cols = [c for c in tagged.columns if c != REASON]
    good = (tagged.filter(F.col(REASON) == "")
            .select(*[col_of(c).cast(types.get(c, "string")).alias(c)
                      if c in types else col_of(c) for c in cols]))
    rejected = tagged.filter(F.col(REASON) != "")
    return good, rejected


def split_by_cast(df: DataFrame, types: Mapping[str, str],
                  max_lengths: Mapping[str, int] | None = None,
                  required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, rejected)``; ``good`` is cast to ``types``, ``rejected``
    holds the raw columns plus ``reject_reason``. ``required`` columns must be
    non-null. (Jobs that use both halves stage ``with_reasons`` first, so the
    input is read once.)"""
    return split_tagged(with_reasons(df, types, max_lengths, required), types)
