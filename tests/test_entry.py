"""The driver contract: entry() on sf0.001, and every registered query
against its DuckDB oracle on sf0.001 (row count, columns, order-free values)."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_ONLY: set = set()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["ShiptoID", "UniqueID"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from quayside.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLE)))
def test_query_matches_oracle(spark, duck, name):
    from check_oracle import digest
    sdf = entry.queries()[name](spark, SF)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
