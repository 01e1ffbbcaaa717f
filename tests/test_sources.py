"""Stored SQL (SRC-3)."""
from conftest import rows
from quayside.sources.tables import run_stored_sql


def test_stored_sql_named_parameters(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = run_stored_sql(spark, "SELECT v FROM kv WHERE k = :k", {"k": 2}, views={"kv": v})
    assert rows(out) == [("b",)]
    # a parameter is a value, never SQL text
    assert run_stored_sql(spark, "SELECT v FROM kv WHERE v = :k", {"k": "a' OR '1'='1"}).count() == 0
