import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="quayside-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as plain tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one(spark, expr_col, value, schema="x string"):
    """Evaluate one Column over a one-row frame holding ``value`` as ``x``."""
    return spark.createDataFrame([(value,)], schema).select(expr_col.alias("r")).first()["r"]
