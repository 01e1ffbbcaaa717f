from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name (backticks added, so dotted names work) or a Column."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
