"""Corpus pipeline: language, near duplicates, contamination, personal data, packing.

Each stage takes what its predecessor kept, written as Parquet and read again;
all but the last return the columns of ``documents``.

1. language: documents without a letter (or text) go;
2. near duplicates: of each component of the SimHash links the document with
   the smallest id stays;
3. decontamination: documents with benchmark words beyond the share go;
4. personal data: found spans are replaced in the texts; no document goes;
5. packing: each document's pieces with the bin they are packed into.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontam, langid, packing, pii, simhash
from quayside.llm.common import remainder, staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, remainder(F.col("doc_id"), 5) != 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: The stages fit models, link components and pack greedily: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
