import random

import pytest
from samples import ODD

from quayside.llm import queries, tokens

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_documents_match_the_library(docs, lib):
    want = {r[0]: (len(r[1].encode()), len(lib.encode(r[1], add_special_tokens=False)))
            for r in docs.select("doc_id", "text").collect()}
    got = tokens.token_counts(docs, PATH, chunk=4096).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_odd_rows_and_empty_table(odd, empty, lib):
    got = tokens.token_counts(odd, PATH)
    assert got.count() == odd.count()
    n = {r[0]: r[2] for r in got.collect() if r[0] is not None}
    for i, t in enumerate(ODD):
        assert n[i] == len(lib.encode(t or "", add_special_tokens=False))
    assert tokens.token_counts(empty, PATH).collect() == []


def test_columns_of_clashing_names(odd):
    from pyspark.sql import functions as F
    want = sorted(map(tuple, tokens.token_counts(odd, PATH).collect()), key=repr)
    have = {c.lower() for c in odd.columns}
    for name in ("n_bytes", "n_tokens", "over_limit", "kernel_text", "body"):
        if name not in have:
            odd = odd.withColumn(name, F.lit("x"))
    assert sorted(map(tuple, tokens.token_counts(odd, PATH).collect()), key=repr) == want


def _texts():
    rng = random.Random(5)
    parts = ["the", " word", "  ", "\n", "\n\n", "\t", " ", "é", "ß", "123", "'re", "'", "r", "<|endoftext|>", "<|end", "of",
             "text|>", "!!", " ", "\x1c", "日本", "a" * 40, "\r\n", "😀"]
    for n in (5, 50, 400):
        for _ in range(40):
            yield "".join(rng.choice(parts) for _ in range(n))
    yield "a" * 5000  # no boundary at all: the overlap grows to the whole chunk
    yield "\t" * 3000
    yield " " * 3000 + "x"
    yield "<|endoftext|>" * 300


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (97, 40), (1000, 64)])
def test_spliced_chunks_match_whole_texts(lib, chunk, overlap):
    c = tokens.Counter(PATH, chunk, overlap)
    for t in _texts():
        assert c.count(t) == len(lib.encode(t, add_special_tokens=False)), t[:80]
        assert c.counts([t, None, ""]) == [len(lib.encode(t, add_special_tokens=False)), 0, 0]


def test_cache_is_bounded(lib):
    c = tokens.Counter(PATH, 1000, 64, cache=50)
    for i in range(30):
        c.counts([" ".join(f"w{i}x{j}" for j in range(40))])
        assert len(c.known) <= 50 + 40


def test_long_texts_between_short_ones_with_a_full_cache(lib):
    c = tokens.Counter(PATH, 100, 16, cache=10)
    texts = [x for i in range(8) for x in (" ".join(f"q{i}y{j}" for j in range(8)), " ".join(f"z{i}y{j}" for j in range(90)), "a\tb")]
    assert c.counts(texts) == [len(lib.encode(t, add_special_tokens=False)) for t in texts]


def test_long_pieces_leave_the_cache(lib, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_CHARS", 1000)
    c = tokens.Counter(PATH)
    c.known.clear()
    c.long.clear()
    for i in range(20):
        t = f"{i}" + "x" * 400 + " short"
        assert c.counts([t]) == [len(lib.encode(t, add_special_tokens=False))]
        assert sum(len(p) for p in c.known if len(p) > tokens.LASTING) <= 1000 + 402
    assert " short" in c.known
