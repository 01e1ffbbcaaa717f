"""Quality, personal data, licenses."""
import random

import brute
import pytest
from samples import ODD
from pyspark.sql import functions as F

from quayside.llm import license, pii, quality, queries


# ------------------------------------------------------------------ quality

@pytest.fixture(scope="module")
def judged(docs):
    return {r.doc_id: r for r in quality.judged(docs).collect()}


def test_base_counts(docs, judged):
    for r in docs.select("doc_id", "text").collect():
        j = judged[r.doc_id]
        assert (j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed) == brute.base6(r.text)
        assert not (j.kept and j.base_failed)


def test_base_counts_of_odd_rows(spark, odd, empty):
    rng = random.Random(2)
    texts = [*ODD, *(" ".join(rng.choice("abc") for _ in range(n)) for n in (2, 3, 4, 9, 60, 300)),
             " ".join(f"w{i % 150}" for i in range(300)), " ".join(f"w{i % 500}" for i in range(900)),
             "\x0bA b\fc\r\n\r\nA b\n \nA b"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality.judged(df).collect():
        assert tuple(r)[1:7] == brute.base6(texts[r.doc_id]), texts[r.doc_id]
    assert quality.judged(odd).count() == odd.count()
    assert quality.judged(empty).collect() == []


def test_noise_goes_and_prose_stays(docs, judged):
    labels = docs.sparkSession.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()
    fine = [judged[r.doc_id] for r in labels if r.quality == 1 and not judged[r.doc_id].base_failed]
    bad = [judged[r.doc_id] for r in labels if r.quality == 0 and not judged[r.doc_id].base_failed]
    assert all(j.kept for j in fine)
    assert not bad or sum(j.kept for j in bad) < len(bad)


def test_js_distance(spark):
    import math
    p, q = [0.5, 0.5, 0.0], [0.1, 0.4, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    lit = lambda x: F.array(*map(F.lit, x))
    got = spark.range(1).select(quality.js_distance(lit(p), lit(q)), quality.js_distance(lit(p), lit(p)),
                                quality.js_distance(lit([1.0, 0.0]), lit([0.0, 1.0]))).first()
    assert got[0] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2)) and got[1] == 0 and got[2] == pytest.approx(1)


def test_references_come_from_all_labelled_rows(spark):
    """3,000 rows of a language, none left out of its reference (brute force)."""
    import math
    from collections import Counter
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrst") + (str(i) if i % 7 == 0 else "x") for _ in range(100)) for i in range(3000)]
    n, common, words = [0] * 7, Counter(), 0
    shares = []
    for t in texts:
        upper, digit, space = 0, sum(c.isdigit() for c in t), t.count(" ")
        row = [upper, digit, 0, 0, 0, space, len(t) - digit - space]
        shares.append([x / len(t) for x in row])
        n = [a + b for a, b in zip(n, row, strict=True)]
        common.update(t.split())
        words += 100
    whole = [x / sum(n) for x in n]
    top = sorted((-c, w) for w, c in common.items() if c >= quality.COMMON_SHARE * words)[:quality.COMMON]
    ref = [-c / words for c, _ in top]
    ref.append(1 - sum(ref))

    def distance(p, q):
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)) / 2))
    df = spark.createDataFrame([*((i, t, "xx") for i, t in enumerate(texts)), (3000, " ".join("ÄB9" for _ in range(200)), None)],
                               "doc_id long, text string, lang string")
    for r in quality.judged(df).where("doc_id < 3000").collect():
        assert r.class_distance == pytest.approx(distance(shares[r.doc_id], whole), abs=1e-6)
        own = Counter(texts[r.doc_id].split())
        mine = [own[w] / 100 for _, w in top]
        assert r.word_distance == pytest.approx(distance([*mine, 1 - sum(mine)], ref), abs=1e-6)


def test_no_python_in_the_quality_plan(docs):
    plan = quality.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


# ------------------------------------------------------------ personal data

def test_base_spans_match_the_patterns(docs):
    rng = random.Random(4)
    texts = [r.text for r in docs.select("text").collect()] + ODD
    parts = ["a", "B9", "@", ".", "x.y", "1", "255", "256", "+1", "-", " ", "(555)", "4111 1111 1111 1111", "4111111111111111",
             "12.3.4.5", "é", "%", "0000", "\n"]
    texts += ["".join(rng.choice(parts) for _ in range(n)) for n in (3, 8, 20, 60) for _ in range(300)]
    for t in texts:
        assert pii.base_spans(t) == brute.base9(t), t


def test_patterns_are_linear():
    import time
    t0 = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 60_000, "1 " * 100_000, "+1" + " " * 200_000):
        pii.base_spans(t)
        pii.find([t[:20_000]], None)
    assert time.time() - t0 < 30


def test_field_adds_other_forms_of_a_known_number(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        num = "".join(rng.choice("0123456789") for _ in range(10))
        rows.append((i, f"call +1{num} now or {rng.randrange(99)} times, room {rng.randrange(999)}; again +1{num} {rng.randrange(9)}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    base, every = pii.find(["call +19885552485 now", "none 12 of 999", "call +19885552485 now, 9885552485 again"], model)
    assert every[0] == base[0] and every[1] == base[1] == []
    assert every[2] == sorted([*base[2], (23, 3, 33)])  # the bare number is the same phone


def test_exact_marginals_on_a_tree():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    f = pii.Field(rng.normal(size=(pii.N_FEATURES, pii.N_LABELS)), rng.normal(size=(5, 5)), np.eye(5) * 1.5)
    nodes = pii.Nodes()
    nodes.add(0, "12 ab@c.de x 77-11 mid 3", [])
    n = len(nodes.text)
    unary = pii._design(np.array(nodes.feat)) @ f.unary
    p = np.zeros((n, 5))
    for y in itertools.product(range(5), repeat=n):
        e = sum(unary[i, y[i]] for i in range(n)) + sum(f.chain[y[a], y[b]] for a, b in nodes.chain) + sum(
            f.skip[y[a], y[b]] for a, b in nodes.skip)
        for i in range(n):
            p[i, y[i]] += np.exp(e)
    assert np.allclose(f.marginals(nodes), p / p.sum(1, keepdims=True), atol=1e-3)


def test_messages_settle_text_by_text():
    """Marginals of a text do not depend on the other texts of its batch, and a
    mention far along the skip edges gets its evidence."""
    import numpy as np
    rng = np.random.default_rng(3)
    f = pii.Field(rng.normal(size=(pii.N_FEATURES, pii.N_LABELS)), rng.normal(size=(5, 5)), np.eye(5) * 3)
    texts = ["12 ab@c.de 12 ab@c.de 77 12", "5 " * 300, "1 2 1 2 3 1 2 3", "x"]
    alone = []
    for t in texts:
        n = pii.Nodes()
        n.add(0, t, [])
        if n.text:
            alone.append(f.marginals(n))
    nodes = pii.Nodes()
    for i, t in enumerate(texts):
        nodes.add(i, t, [])
    assert np.allclose(np.concatenate(alone), f.marginals(nodes), atol=1e-9)
    far = pii.Field(np.zeros((pii.N_FEATURES, pii.N_LABELS)), np.zeros((5, 5)), np.eye(5) * 8)
    n = pii.Nodes()
    n.add(0, " ".join(["+1 4155552671"] + ["4155552671 x"] * 60), [(0, 3, 13)])
    assert far.marginals(n, given=True)[-1].argmax() == 4


def test_scan_of_a_very_long_text_and_clashing_columns(spark):
    body = "word 12, " * 60_000 + "write a@b.cd or call +14155552671, not (4155552671)"
    df = spark.createDataFrame([(1, body, 1, "x"), (2, "", 2, "y")], "doc_id long, text string, n_email long, kernel_text string")
    out = {r.doc_id: r for r in pii.scan(df, pii.fit(df)).collect()}
    assert (out[1].n_email, out[1].n_phone, out[2].spans) == (1, 1, "")
    at = len("word 12, ") * 60_000
    assert f"email:{at + 6}:{at + 12}" in out[1].spans


def test_scan_and_redaction(spark, odd, empty):
    model = pii.fit(odd)
    out = pii.scan(odd, model)
    assert out.count() == odd.count()
    for r in out.where("doc_id is not null").collect():
        assert r.n_email == sum(k == 0 for _, k, _ in brute.base9(ODD[r.doc_id]))
    assert pii.scan(empty, pii.fit(empty)).collect() == []
    df = spark.createDataFrame([(1, "mail a.b@c.de, ip 10.0.0.1!", 27, "e"), (2, None, None, "f")],
                               "doc_id long, text string, n_chars long, spans string")
    done = {r.doc_id: r for r in pii.redacted(df).collect()}
    assert done[1].text == "mail <EMAIL>, ip <IP>!" and done[1].n_chars == 22 and done[1].spans == "e"
    assert done[2].text is None
    assert pii.redacted(df).columns == df.columns


# ------------------------------------------------------------------ license

def _brute_license(text, templates, threshold=0.8, longest=4):
    w = brute.words3(text)
    at = sorted((i, label) for p, label in license.PHRASES.items() for i in range(len(w))
                if w[i:i + len(p.split())] == p.split())
    blocks, para = [], []
    for line in [*(text or "").split("\n"), ""]:
        x = brute.words3(line)
        if x:
            blocks.append(set(x))
            para.append(x)
        else:
            if len(para) > 1:
                blocks.append(set(sum(para, [])))
            para = []
    met = {}
    for label, t in templates:
        t = set(brute.words3(t))
        for b in blocks:
            if len(t & b) >= threshold * len(t) - 1e-9 and len(b) <= longest * len(t):
                met[label] = max(met.get(label, 0), len(t & b) / len(t))
    own = {x for _, x in at}
    return (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted(own)),
            ",".join(sorted(own | set(met))), 1.0 if own else max(met.values(), default=0.0))


def test_licenses_match_brute_force(spark, docs, odd, empty):
    rng = random.Random(9)
    words = sorted({w for _, t in license.TEMPLATES for w in brute.words3(t)}) + ["\n", "\n\n", "the"]
    extra = [(1000 + i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([20, 60, 200] * 15)]
    extra += [(2000 + i, f"Intro.\n\n{t[:len(t) // 2]}\n{t[len(t) // 2:]}\n\nmore") for i, (_, t) in enumerate(license.TEMPLATES)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    text = {r[0]: r[1] for r in df.collect()}
    found = 0
    for r in license.scan(df).collect():
        want = _brute_license(text[r.doc_id], license.TEMPLATES)
        assert tuple(r)[1:] == pytest.approx(want), text[r.doc_id][:200]
        found += r.labels != ""
    assert found > 15
    assert license.scan(odd).count() == odd.count()
    assert license.scan(empty).collect() == []


def test_licenses_beside_columns_of_clashing_names(spark):
    rows = [(i, t) for i, (_, t) in enumerate(license.TEMPLATES)] + [(100, None), (101, ""), (102, "the MIT License")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, license.scan(df).collect()))
    for name in ("n_words", "labels", "score", "kernel_text", "body", "word", "n"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(map(tuple, license.scan(df).collect())) == want
    assert any(r[6] for r in want)


def test_notices_in_long_blocks_are_found(spark, tmp_path):
    rng = random.Random(5)
    fill = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for label, t in license.TEMPLATES:  # inside a long line, wrapped in a long paragraph
        for joint in (" ", "\n"):
            some = lambda: " ".join(rng.choice(fill) for _ in range(300))
            texts.append(some() + joint + t.replace(" ", joint, 2) + joint + some())
            labels.append(label)
    scattered = " ".join(["all", *fill[:20], "rights", *fill[20:40], "reserved"])
    words = sorted({w for _, t in license.TEMPLATES for w in brute.words3(t)})
    mixed = [" ".join(rng.choice(words + fill[:20]) for _ in range(n)) for n in (100, 400, 900) for _ in range(6)]
    df = spark.createDataFrame(list(enumerate([*texts, scattered, *mixed])), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.op10_license(spark, str(tmp_path)).collect()}
    for i, label in enumerate(labels):
        assert label in out[i].labels.split(",") and out[i].score == 1, texts[i]
    assert out[len(texts)].labels == ""
    for k, text in enumerate(mixed, len(texts) + 1):  # one line each
        w, want = brute.words3(text), set(out[k].base_labels.split(",")) - {""}
        for label, t in license.TEMPLATES:
            t = set(brute.words3(t))
            width = 4 * len(t) if len(set(w)) > 4 * len(t) else len(w)
            if max(len(t & set(w[i:i + width])) for i in range(len(w))) >= 0.8 * len(t) - 1e-9:
                want.add(label)
        assert out[k].labels == ",".join(sorted(want)), text
