import brute
import pytest

from quayside.llm import decontam, queries


def got(df):
    out = df.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest(df["items"]).alias("sha"), "contaminated")
    return sorted(map(tuple, out.collect()), key=str)


def want(docs, bench):
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    return sorted(((r[0], *brute.contamination(r[1], items)) for r in docs.select("doc_id", "text").collect()), key=str)


def test_documents(docs, bench):
    assert got(decontam.contamination(docs, bench)) == want(docs, bench)


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_short_items_repeats_nulls_and_blocks(spark, block_bytes):
    long = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(1, "Alpha"), (2, "beta gamma"), (2, "beta gamma"), (3, long), (4, long), (None, "delta"),
                                   (5, None), (6, "..."), (7, "é ü ß")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "alpha beta-gamma beta gamma", "x"), (2, long[8:90] + " tail", "x"), (3, None, "x"), (4, "", "x"), (None, "delta É ü ß", "x"),
        (5, ("w " * 200) + long, "x"), (5, "alpha", "y"), (6, "é ü ß " * 3, "z")], "doc_id long, text string, items string")
    assert got(decontam.contamination(docs, bench, block_bytes=block_bytes)) == want(docs, bench)
    clean = decontam.keep_clean(docs, bench, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    bad = [r for r in want(docs, bench) if r[5]]
    assert clean.count() == docs.count() - len(bad)


def test_pieces_lose_no_window(spark, monkeypatch):
    monkeypatch.setattr(decontam, "_PIECE_WORDS", 5)
    body = " ".join(f"w{i}" for i in range(60))
    bench = spark.createDataFrame([(1, body)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 13))) for i in range(48)], "doc_id long, text string")
    assert all(r.n_hit == 13 for r in decontam.contamination(docs, bench).collect())


def test_many_copies_of_an_item_and_very_long_words(spark):
    body = " ".join(f"w{i}" for i in range(30))
    huge = "x" * 300_000
    rows = [(1, body)] * 200 + [(i, "shared words of one passage") for i in range(10, 60)]
    rows += [(2, f"a {huge} b"), (3, f"{huge}y"), (4, f"a {huge}z b")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(1, body), (2, f"so a {huge} b"), (3, huge), (4, f"{huge}Y"), (5, "shared words of one passage")],
                                 "doc_id long, text string")
    for block_bytes in (1 << 20, 4000):
        assert got(decontam.contamination(docs, bench, block_bytes=block_bytes)) == want(docs, bench)
    assert decontam.keep_clean(docs, bench, block_bytes=4000).select("doc_id").collect() == [(3,)]


def test_empty_tables(docs, bench, empty):
    assert decontam.contamination(empty, bench).collect() == []
    none = bench.where("false")
    assert decontam.contamination(docs, none).where("n_hit > 0 or contaminated").count() == 0
    assert decontam.keep_clean(docs, none).count() == docs.count()


def test_every_oracle_names_a_query():
    assert set(queries.ORACLE) <= set(queries.QUERIES)
