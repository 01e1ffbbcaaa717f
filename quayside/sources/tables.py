"""Table sources (SRC-1, SRC-2, SRC-3).

SRC-1/SRC-2: a relational scan is ``spark.read`` of the table's files (or a
catalog table); it is distributed, pushes filters and prunes columns. For a
remote database the same DataFrame comes from ``read_jdbc``: partitioned on
a numeric column, fetched ``fetchsize`` rows at a time — never accumulated on
the driver.

SRC-3: stored SQL text runs through ``spark.sql`` with *named parameters*
(never string concatenation, Q11) over views registered from DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quayside.sinks.state import LOAD_BATCH_ROWS

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


_SCHEMAS: dict[tuple[int, str], object] = {}


class Tables:
    """Parquet tables of one folder, read lazily (one scan per use; Catalyst
    prunes columns and pushes filters into each).

    A table's schema is inferred once per session (that inference is a Spark
    job) and passed explicitly on later reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (id(self.spark), path)
        schema = _SCHEMAS.get(key)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[key] = df.schema
            return df
        return self.spark.read.schema(schema).parquet(path)

    def register(self, *names: str) -> "Tables":
        for n in names or DRIVER_TABLES:
            self(n).createOrReplaceTempView(n)
        return self


def run_stored_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None,
                   views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SRC-3: run a stored query text with named parameters (``:name``)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=dict(args or {})) if args else spark.sql(text)


def read_sql_file(spark: SparkSession, path: str) -> str:
    """The text of a stored query file (one file, read whole)."""
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, *, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-1/SRC-2 against a remote database: partitioned parallel reads,
    ``fetchsize`` = the reference's 50,000-row batch."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", LOAD_BATCH_ROWS)
    if table_or_query.lstrip().lower().startswith("select"):
        reader = reader.option("query", table_or_query)
    else:
        reader = reader.option("dbtable", table_or_query)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
