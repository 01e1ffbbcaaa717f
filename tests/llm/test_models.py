"""Language ID and the suffix tree model."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import langid, pst, quality
from quayside.llm.common import remainder


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs, remainder(F.col("doc_id"), 5) != 0)


def test_language_is_right_on_held_out_rows(docs, model):
    out = langid.predict(docs, model, ["doc_id", "lang"]).where(remainder(F.col("doc_id"), 5) == 0).collect()
    assert len(out) > 20
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def _brute_bits(model_rows, text):
    """Code length with the escape rules, symbol by symbol."""
    counts = [dict() for _ in range(4)]
    for gram, n in model_rows:
        s = [(gram >> k) & 255 for k in (24, 16, 8, 0)]
        for o in range(4):
            d = counts[o].setdefault(tuple(s[3 - o:3]), Counter())
            d[s[3]] += n
    k = 256
    uniform = [1 / 256] * k

    def p(order, ctx):
        lower = uniform if order == 0 else p(order - 1, ctx[1:])
        d = counts[order].get(ctx)
        if not d:
            return lower
        total, kinds = sum(d.values()), len(d)
        left = 1 - sum(lower[s] for s in d)
        return [d[s] / (total + kinds) if s in d else kinds / (total + kinds) * lower[s] / max(left, 1e-12) for s in range(k)]
    sym = list(langid.symbols(text))
    return sum(-math.log2(max(p(3, tuple(sym[i - 3:i]))[sym[i]], 1e-30)) for i in range(3, len(sym)))


def test_code_lengths_match_the_definition(spark):
    rows = [("en", "the cat sat on the mat and the hat"), ("fr", "le chat était sur le tapis"), ("en", "that is the end")]
    df = spark.createDataFrame([(i, t, la) for i, (la, t) in enumerate(rows)], "doc_id long, text string, lang string")
    grams = [tuple(r) for r in langid.gram_counts(df, "lang", "text").collect()]
    m = langid.Ppm(grams)
    texts = [b"the chat", "Un été, THE hat!".encode(), b"zzz qq", b"the", "\u0394\u03b5\u03bd cat \u4e2d".encode()]
    bits = m.lengths(texts)
    for i, t in enumerate(texts):
        for j, la in enumerate(m.langs):
            want = _brute_bits([(g, n) for x, g, n in grams if x == la], t)
            assert bits[i, j] == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_every_script_keeps_its_bytes(spark):
    """More than 64 distinct bytes: rare scripts are told apart as well."""
    alphabets = {"ru": range(0x430, 0x450), "el": range(0x3b1, 0x3ca), "th": range(0xe01, 0xe2f), "ka": range(0x10d0, 0x10f1),
                 "hi": range(0x905, 0x93a), "en": range(97, 123), "ar": range(0x627, 0x64b), "ko": range(0xac00, 0xac80)}
    rng = np.random.default_rng(1)
    rows = [(i * 8 + k, "".join(chr(rng.choice(list(a))) + " " * (j % 5 == 4) for j in range(60)), la)
            for k, (la, a) in enumerate(alphabets.items()) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.predict(df, langid.fit(df, F.col("doc_id") < 160), ["doc_id", "lang"]).where("doc_id >= 160").collect()
    assert len(out) == 80 and all(r.lang == r.lang_pred for r in out)


def test_an_index_finds_its_keys():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**32, 50_000, dtype=np.uint32))
    index = langid.Index(keys)
    assert (index.keys[index.find(keys)] == keys).all() and (index.find(keys) > 0).all()
    other = np.setdiff1d(rng.integers(0, 2**32, 50_000, dtype=np.uint32), keys)
    assert (index.find(other) == 0).all()


def test_slices_of_long_texts_add_up(model, monkeypatch):
    text = ("the quick brown fox " * 50).encode()
    whole = model.lengths([text])
    monkeypatch.setattr(langid, "_SLICE", 37)
    assert np.allclose(model.lengths([text]), whole, rtol=1e-5)


def test_language_of_odd_rows(spark, odd, empty, model):
    out = langid.predict(odd, model, ["doc_id", "text"])
    for r in out.collect():
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letter and (letter or r.score == 0)
    assert langid.predict(empty, model, ["doc_id"]).collect() == []
    none = langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in langid.predict(odd, none, ["doc_id"]).collect()} == {"und"}
    kept = langid.keep_known(odd.withColumn("lang_pred", F.lit(1)), F.lit(True))
    assert kept.columns == [*odd.columns, "lang_pred"]
    assert kept.count() == sum(any(c.isalpha() for c in r.text or "") for r in odd.collect())
    named = odd.withColumn("sample_label", F.lit("x")).withColumn("Sample_Rows", F.lit(2))
    assert langid.keep_known(named, F.lit(True)).columns == named.columns
    assert quality.judged(named).count() == odd.count()
    untold = langid.keep_known(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert untold.columns == odd.columns and untold.count() == kept.count()


def test_base_score_counts_and_split(docs):
    held = remainder(F.col("doc_id"), 10) == 0
    out = {r.doc_id: r for r in pst.score(docs, held, frequent=50).collect()}
    import zlib
    texts = {r[0]: (r[1] or "").encode().lower().split() for r in docs.select("doc_id", "text").collect()}
    train = [w for i, w in texts.items() if zlib.crc32(str(i).encode()) % 10]
    c = Counter(x for w in train for x in w)
    c[None] = len(train)
    n, v = sum(c.values()), len(c)
    for i, w in texts.items():
        r = out[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r.n_tokens, r.train_tokens) == (len(w) + 1, n)
        assert r.n_known == sum(c[x] > 0 for x in [*w, None])
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*w, None]), rel=1e-9)
    held_out = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def _tree(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df, {r.doc_id: r.score for r in pst.score(df, F.lit(False), support=1e-9, floor=2, divergence=0.001, weight=2.0, **kw).collect()}


def _brute_score(texts, text, floor=2, divergence=0.001, weight=2.0):
    seqs = [[*t.split(), None] for t in texts]
    c = Counter(x for s in seqs for x in s)
    n = sum(c.values())
    norm = n + 0.1 * (len(c) + 1)
    part = max(1e-9, floor / n)
    least = max(1, math.ceil(part * n - 1e-9))
    two = Counter((s[i], s[i + 1]) for s in seqs for i in range(len(s) - 1))
    two = {k: x for k, x in two.items() if x >= least}
    three = Counter((s[i], s[i + 1], s[i + 2]) for s in seqs for i in range(len(s) - 2) if (s[i], s[i + 1]) in two)
    three = {k: x for k, x in three.items() if x >= least}

    def root(x):
        return (c[x] + 0.1) / norm

    def build(entries, total, parent):
        p = {x: (k + weight * parent(x)) / (total + weight) for x, k in entries.items()}
        rest, rest_p = 1 - sum(p.values()), 1 - sum(map(parent, p))
        rest, rest_p = max(rest, 1e-12), max(rest_p, 1e-12)
        kl = sum(q * math.log(q / parent(x)) for x, q in p.items()) + rest * math.log(rest / rest_p)
        if kl < divergence:
            return parent
        return lambda x: p[x] if x in p else parent(x) * rest / rest_p
    one = {}
    for u in {u for u, _ in two}:
        f = build({w: k for (a, w), k in two.items() if a == u}, c[u], root)
        if f is not root:
            one[u] = f
    second = {}
    for u, v in {(u, v) for u, v, _ in three}:
        parent = one.get(v, root)
        f = build({w: k for (a, b, w), k in three.items() if (a, b) == (u, v)}, two[u, v], parent)
        if f is not parent:
            second[u, v] = f
    out, s = 0.0, [*text.split(), None]
    for i, x in enumerate(s):
        f = second.get((s[i - 2], s[i - 1])) if i > 1 else None
        f = f or (one.get(s[i - 1]) if i else None) or root
        out += math.log10(f(x))
    return out


def test_scores_match_a_plain_suffix_tree(spark):
    texts = ["a b c a b c a b d", "a b c d a b c", "b c a b c", "x y x y x z", "q", "", "c a b c e e e", "a b c a b c a b d"]
    _, got = _tree(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(_brute_score(texts, t), rel=1e-9), t


def test_scores_of_odd_and_empty_tables(odd, empty):
    out = pst.score(odd, F.lit(False)).collect()
    assert len(out) == odd.count()
    assert all(r.n_tokens >= 1 and r.score is not None and r.base_score <= 0 for r in out)
    assert pst.score(empty, F.lit(False)).collect() == []
    nothing = pst.score(odd, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in nothing)


def test_scores_beside_columns_of_clashing_names(spark):
    texts = ["a b c a b c a b d", "a b c d a b c", None, "b c a b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {r.doc_id: r.score for r in pst.score(df, F.lit(False), floor=2).collect()}
    for name in ("chunk", "data", "docs", "row", "body", "told0", "gain", "held_out", "rare", "word", "n"):
        df = df.withColumn(name, F.lit("x"))
    got = {r.doc_id: r.score for r in pst.score(df, F.lit(False), floor=2).collect()}
    assert got == pytest.approx(want)


def test_candidate_chunks_and_blocks_change_nothing(spark, monkeypatch):
    texts = ["a b c a b c a b d", "a b c d a b c", "b c a b c", "x y x y x z", "c a b c e e e", "a b c a b c a b d"]
    _, one = _tree(spark, texts)
    monkeypatch.setattr(pst, "_CHUNK", 5)
    monkeypatch.setattr(pst, "_FLUSH", 3)
    _, two = _tree(spark, texts)
    _, three = _tree(spark, texts, frequent=100)
    assert one == pytest.approx(two) and one == pytest.approx(three)


def test_entries_have_an_absolute_count(spark):
    # over 4 million symbols, where a share of 2e-6 asked for more than 8 occurrences
    texts = [*["f " * 100_000] * 50, *["p q"] * 8, "p q r", "p"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in pst.score(df, F.lit(False)).collect()}
    for i in (50, 58, 59):
        assert got[i] == pytest.approx(_brute_score(texts, texts[i], 8, 0.01, 20.0), rel=1e-9)


def test_words_without_a_number_are_in_ngrams(spark):
    texts = ["a b c a b c a b d", "a b c d a b c", "b c a b c", "x y x y x z", "q", "", "c a b c e e e", "L" * 70 + " m " + "l" * 70 + " m"]
    for frequent in (0, 2, 5):
        _, got = _tree(spark, texts, frequent=frequent)
        for i, t in enumerate(texts):
            assert got[i] == pytest.approx(_brute_score([x.lower() for x in texts], t.lower()), rel=1e-9), (frequent, t)


def test_a_chunk_leaves_an_answer_once_read():
    chunk = object.__new__(pst._Chunk)
    chunk.answers = {pst.PAIR: np.ones(3)}
    assert chunk.answer(pst.PAIR).tolist() == [1, 1, 1] and chunk.answers == {}
    assert len(chunk.answer(pst.TWO)) == 0


def test_pair_keys_are_one_to_one_and_spread():
    import numpy as np

    from quayside.llm.pst import _pair_key
    n = 300
    first, second = (x.ravel().astype(np.int64) for x in np.meshgrid(np.arange(n), np.arange(n)))
    bits = int(n).bit_length()
    key = _pair_key(first, second, bits)
    assert len(np.unique(key)) == n * n and not (key & np.uint64(1)).any()
    for same in (first == 7, second == 7):  # a frequent word's pairs fall into all ranges of keys
        per_range = np.bincount((key[same] >> np.uint64(60)).astype(int), minlength=16)
        assert per_range.max() <= 2 * per_range.mean()
    hashed = _pair_key(np.array([-5, 3, -5], np.int64), np.array([3, -5, -9], np.int64), bits)
    assert (hashed & np.uint64(1)).all() and len(np.unique(hashed)) == 3


def test_codes_of_words_and_words_that_share_one(spark):
    words = [b"", b"a", "größe".encode(), b"x" * 500, bytes(range(200, 256))]
    rows = spark.createDataFrame([(w, 1) for w in words], "word binary, n long")
    for r in rows.select("word", pst._raised_code("word").alias("code")).collect():
        assert r.code - (1 << 63) == pst._code(bytes(r.word)) < -1
    assert pst.alike(rows).collect() == []
    twice = rows.unionAll(spark.createDataFrame([(b"a", 7)], rows.schema))  # stands for another word of this code
    assert sorted((bytes(r.word), r.n) for r in pst.alike(twice).collect()) == [(b"a", 1), (b"a", 7)]
