"""Filters and predicates.

All filters are Column predicates, so Catalyst pushes the simple ones
(equality, IN-lists, ``StringStartsWith``, null tests) into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.util import col_of

# Fixed values of the alert search (FLT-7).
OPEN_STATUSES = ("Not Started", "In Progress")
# A character that is not white space, Unicode spaces included.
NOT_BLANK = r"[^\s\x1C-\x1F\x85\p{Z}]"
ACTIVE, ARCHIVED = "Active", "Archived"


def drop_value_keep_null(df: DataFrame, col, value) -> DataFrame:
    """FLT-1 / FLT-8: drop rows equal to ``value``; null rows are kept, and so
    is a text that is no number where ``value`` is one."""
    cell = col_of(col)
    if isinstance(value, int) and df.select(cell).dtypes[0][1] == "string":
        cell = cell.try_cast("bigint")
    return df.filter(~cell.eqNullSafe(F.lit(value)))


def drop_containing_if_any(df: DataFrame, col, text: str) -> DataFrame:
    """FLT-2: if some row's ``col`` contains ``text``, drop those rows *and*
    null rows; if none does, keep everything (nulls included).

    The existence test (AG-8) is an uncorrelated ``EXISTS`` subquery that
    stops at the first hit, not a join."""
    c = col_of(col)
    hit = df.filter(c.contains(text)).exists()
    return df.filter(~hit | (c.isNotNull() & ~c.contains(text)))


def non_blank(df: DataFrame, col) -> DataFrame:
    """FLT-3: keep rows whose text has a character that is no white space (of
    any kind: tabs, line ends and no-break spaces are blank, too)."""
    return df.filter(col_of(col).rlike(NOT_BLANK))


def not_null(df: DataFrame, col) -> DataFrame:
    """FLT-4."""
    return df.filter(col_of(col).isNotNull())


def ready_with_contact(df: DataFrame, status_col="send_email_status",
                       contact_col="customer_contact") -> DataFrame:
    """FLT-5: ``status = 'Ready' AND contact <> '-'`` (a null contact fails <>)."""
    return df.filter((col_of(status_col) == "Ready") & (col_of(contact_col) != "-"))


def facet_predicate(facets: Mapping[str, Sequence[str] | None]) -> Column:
    """FLT-6: AND of IN-lists; an empty or missing list does not filter."""
    pred = F.lit(True)
    for col, values in facets.items():
        if values:
            pred = pred & col_of(col).isin(list(values))
    return pred


def mode_predicate(modes: Iterable[str], date_col="DateDocumentSent",
                   status_col="Status") -> Column:
    """FLT-7: Active = date ``''``, Archived = date ``<> ''``, both = either
    (a null date matches neither), none = no date test; every case keeps
    only open statuses. Unknown modes are rejected (Q7)."""
    modes = set(modes or ())
    unknown = modes - {ACTIVE, ARCHIVED}
    if unknown:
        raise ValueError(f"unknown activeArchived modes: {sorted(unknown)}")
    d = col_of(date_col)
    status_ok = col_of(status_col).isin(list(OPEN_STATUSES))
    if modes == {ACTIVE, ARCHIVED}:
        return ((d == "") | (d != "")) & status_ok
    if modes == {ACTIVE}:
        return (d == "") & status_ok
    if modes == {ARCHIVED}:
        return (d != "") & status_ok
    return status_ok


def alert_search(df: DataFrame, regions=None, statuses=None, countries=None,
                 customers=None, modes=()) -> DataFrame:
    """FLT-6 + FLT-7 over the alert-changes table."""
    pred = facet_predicate({"Region": regions, "SISentStatus": statuses,
                            "shiptocountry": countries, "ShiptoID": customers})
    return df.filter(pred & mode_predicate(modes))


def point_lookup(df: DataFrame, col, value) -> DataFrame:
    """FLT-9: ``col = value`` as a bound literal (pushed to the scan)."""
    return df.filter(col_of(col) == F.lit(value))


def status_in(df: DataFrame, col, values: Sequence[str]) -> DataFrame:
    """FLT-10 / FLT-12."""
    return df.filter(col_of(col).isin(list(values)))


def starts_with(df: DataFrame, col, stem: str) -> DataFrame:
    """FLT-11: literal prefix test (``_`` and ``%`` are not wildcards, Q9)."""
    return df.filter(col_of(col).startswith(stem))


def pieces(keys: Sequence[str], n: int) -> list[Column]:
    """``n`` conditions by a hash of ``keys``: each row, null keys included, meets
    just one, and rows of equal keys meet the same."""
    own = F.pmod(F.xxhash64(*[col_of(k) for k in keys]), F.lit(n))
    return [own == i for i in range(n)] if n > 1 else [F.lit(True)]
