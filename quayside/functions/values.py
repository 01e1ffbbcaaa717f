"""Numeric, conditional, null and JSON column functions (SCL-N*, SCL-C*, SCL-L*, SCL-J*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.util import col_of, quote

# Shipping kind → label of the reference number in mails (SCL-C1).
SHIPPING_LABELS = {"Ocean": "Booking number", "Truck": "PO number"}


def decimal_to_double(c) -> Column:
    """SCL-N2."""
    return col_of(c).cast("double")


def number_text(c) -> Column:
    """Text of a number without exponent notation (Q2): doubles go through a
    decimal so ``29744324.0`` prints ``29744324`` rather than ``2.9744324E7``.
    What no such decimal holds (NaN, infinities, 29 digits or more) keeps its
    plain text."""
    c = col_of(c)
    as_dec = c.try_cast("decimal(38,10)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(as_dec, r"0+$", ""), r"\.$", "")
    return F.coalesce(trimmed, c.cast("string"))


def shipping_label(shipping) -> Column:
    """SCL-C1: Ocean → ``Booking number``, Truck → ``PO number``, else null."""
    s = col_of(shipping)
    out = None
    for kind, label in SHIPPING_LABELS.items():
        out = F.when(s == kind, F.lit(label)) if out is None else out.when(s == kind, F.lit(label))
    return out


def nan_text_to_empty(df: DataFrame, cols=None) -> DataFrame:
    """SCL-L2: cells exactly equal to ``nan`` become ``''``."""
    cols = set(cols if cols is not None else
               [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.select(*[
        (F.when(col_of(c) == "nan", F.lit("")).otherwise(col_of(c)).alias(c) if c in cols else col_of(c))
        for c in df.columns])


def row_json(*cols) -> Column:
    """SCL-J1: one row as a JSON object, null fields kept."""
    names = cols or ("*",)
    return F.to_json(F.struct(*[F.col(quote(c)) if c != "*" else F.col("*") for c in names]),
                     {"ignoreNullFields": "false"})


def option_json(value, label) -> Column:
    """SCL-J2: ``{"value": …, "label": …}``, properly escaped."""
    return F.to_json(F.struct(col_of(value).alias("value"), col_of(label).alias("label")),
                     {"ignoreNullFields": "false"})


def json_has_key(raw, key: str) -> Column:
    """True when the JSON object text has ``key`` (present, even if null)."""
    return F.array_contains(F.json_object_keys(col_of(raw)), F.lit(key))
