import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest  # noqa: E402
from samples import ODD  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", len(t or "")) for i, t in enumerate(ODD)]
    rows += [(None, "one", None, None, None), (None, None, "fr", "s", 0), (3, "one", "en", None, 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")
