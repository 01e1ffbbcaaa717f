"""Date and time column functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.util import col_of

# Spreadsheet day zero, and the stamp formats of the jobs.
SERIAL_DAY_ZERO = "1899-12-30"
LAST_SERIAL = 2958465  # 9999-12-31
UNIQUE_STAMP_FORMAT = "ddMMHHmmss"     # invoice / log unique ids
MAIL_DATE_FORMAT = "dd/MM/yyyy"        # mail outcome dates
FILE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"  # listing times
ISO_DATE_FORMAT = "yyyy-MM-dd"


def ts_literal(now: _dt.datetime | str) -> Column:
    """A wall-clock parameter (batch time, run time) as a ``timestamp_ntz``
    literal: formatting it gives the same text whatever the session time zone
    (jobs never read the clock)."""
    text = now if isinstance(now, str) else now.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def instant_literal(now: _dt.datetime | str) -> Column:
    """An instant parameter, for comparisons with instants such as file
    modification times (a naive ``datetime`` means the local instant, as
    Spark converts collected values)."""
    if isinstance(now, str):
        return F.to_timestamp(F.lit(now))
    return F.lit(now).cast("timestamp")


def serial_to_date(x) -> Column:
    """SCL-D1: spreadsheet serial number → date (fraction = time of day, dropped)."""
    days = F.floor(col_of(x).cast("double")).cast("int")
    return F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), days)


def _iso_shape(c: Column) -> Column:
    """``dddd-dd-dd`` shape: ten characters with dashes at 5 and 8."""
    return (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")


def lenient_date_text(c, formats=(ISO_DATE_FORMAT,)) -> Column:
    """SCL-D2: parse with the given formats (first that fits), render ISO date
    text; text that fits none becomes null.

    ISO text that is a valid date is its own rendering, so the ISO format is
    checked by shape + the cast's date parser and the text kept as it is; other
    formats go through the pattern parser."""
    c = col_of(c).cast("string")
    outs = []
    for f in formats:
        if f == ISO_DATE_FORMAT:
            outs.append(F.when(_iso_shape(c) & c.try_cast("date").isNotNull(), c))
        else:
            outs.append(F.to_date(F.try_to_timestamp(c, F.lit(f))).cast("string"))
    return F.coalesce(*outs)


def _serial_shape(c: Column) -> Column:
    """One to seven digits, perhaps a point and more digits: cheap tests first,
    no pattern. Without its digits nothing or the point is left."""
    whole = F.substring_index(c, ".", 1)
    rest = F.translate(c, "0123456789", "")
    return (F.substring(c, 1, 1).between("0", "9") & (F.length(whole) <= 7)
            & ((rest == "") | ((rest == ".") & (F.length(c) > F.length(whole) + 1))))


def report_date_text(c) -> Column:
    """SCL-D2 for a sheet cell: ISO date text as it is; a date-styled cell is a
    serial number (SCL-D1) and becomes its ISO date; anything else is null. The
    day number is the cell's whole part (its fraction is the time of day)."""
    text = col_of(c).cast("string")
    day = F.substring_index(text, ".", 1).try_cast("int")
    serial = F.when(day.between(1, LAST_SERIAL), F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), day).cast("string"))
    return F.when(_iso_shape(text), lenient_date_text(text)).when(_serial_shape(text), serial)


def iso_date_or_null(c) -> Column:
    """SCL-D3: null or ``''`` → null, otherwise a strict ``yyyy-MM-dd`` date.

    Bad text raises (ANSI), as the style-23 conversion of the database does."""
    return F.to_date(F.nullif(col_of(c), F.lit("")), ISO_DATE_FORMAT)


def stamp(ts, fmt: str = UNIQUE_STAMP_FORMAT) -> Column:
    """SCL-D4: format a timestamp parameter."""
    return F.date_format(col_of(ts) if not isinstance(ts, (_dt.datetime, str)) else ts_literal(ts), fmt)


def within_days_before(ts, now, days: int = 7) -> Column:
    """SCL-D5: ``now - days <= ts <= now`` (both ends inclusive)."""
    now_c = instant_literal(now) if isinstance(now, (_dt.datetime, str)) else now
    t = col_of(ts)
    return (t >= now_c - F.expr(f"INTERVAL {int(days)} DAYS")) & (t <= now_c)


def parse_listing_time(c) -> Column:
    """SCL-D6: ``yyyy-MM-ddTHH:mm:ssZ`` → timestamp (session zone is UTC)."""
    return F.to_timestamp(col_of(c), FILE_TIME_FORMAT)
