"""Registered queries against their SQL, and the pipeline."""
import os
import shutil
import sys

import brute
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "scripts"))

import corpus_pipeline  # noqa: E402
from quayside.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb
    from check_oracle import digest
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([d[0] for d in res.description], res.fetchall())[0]


@pytest.mark.parametrize("name,columns", [
    ("op1_simhash", "doc_id fingerprint component_id"), ("op2_token_counts", "doc_id n_bytes n_tokens over_limit"),
    ("op4_suffix_tree", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    ("op5_language", "doc_id held_out lang_pred score"),
    ("op6_quality", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    ("op7_packing", "doc_id bin_id"), ("op9_personal_data", "doc_id n_email n_ip n_card n_phone base_sha256 spans"),
    ("op10_license", "doc_id n_words n_base first_word last_word base_labels labels score"),
    ("op13_sharding", "doc_id size text_crc32 law shard slot grown_shard")])
def test_query_covers_the_table(spark, docs, name, columns):
    out = queries.QUERIES[name](spark, SF)
    assert set(columns.split()) <= set(out.columns)
    assert out.select("doc_id").distinct().count() == docs.count()


def test_pipeline_against_brute_force(spark, docs, bench):
    kept = {r.doc_id: r for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    ids = sorted(kept)
    cls = brute.classes(ids, [brute.simhash(kept[i].text) for i in ids])
    kept = {i: kept[i] for i in set(cls)}
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    kept = {i: r for i, r in kept.items() if not brute.contamination(r.text, items)[4]}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == set(kept)


def test_stages_keep_the_columns(spark, docs, empty, tmp_path):
    path = str(tmp_path)
    shutil.copytree(f"{SF}", path, dirs_exist_ok=True)
    for table in (docs.withColumn("row", F.lit(1)), empty):
        d = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            d = stage(spark, d, path)
            assert d.columns == table.columns
            assert [f.dataType for f in d.schema] == [f.dataType for f in table.schema]
            d = spark.createDataFrame(d.collect(), table.schema)
        corpus_pipeline.STAGES[-1][1](spark, d, path).collect()


def test_stages_stand_odd_rows(spark, odd, tmp_path):
    path = str(tmp_path)
    shutil.copytree(f"{SF}", path, dirs_exist_ok=True)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, path).count() > 0


def test_nothing_outside_imports_this_subpackage():
    root = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..")
    for base, _, files in os.walk(os.path.join(root, "quayside")):
        for f in files:
            if f.endswith(".py") and os.sep + "llm" not in base:
                assert "quayside.llm" not in open(os.path.join(base, f)).read()
