"""Collocations, conversation repair and sharding against brute force."""
import functools
import hashlib
import heapq
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from quayside.llm import collocations, queries, repair, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---------------------------------------------------------------- collocations

def phrases(text):
    out, piece, word = [], [], []
    for ch in (text or "") + "\n":
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        if ch in " \t.,;:!?\n\x0b\x0c\r":
            if word:
                piece.append("".join(word))
                word = []
            if ch not in " \t":
                out.append(piece)
                piece = []
        else:
            word.append(ch)
    return out


def brute_collocations(rows, floor, top, longest=5):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for p in phrases(text):
            n[lang] += len(p)
            for m in range(1, longest + 1):
                for i in range(len(p) - m + 1):
                    f.setdefault(lang, Counter())[tuple(p[i:i + m])] += 1
    out = []
    for lang, by in f.items():
        cand = {p: a for p, a in by.items() if len(p) > 1 and a >= floor}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b * 100 >= a * 100 and inside(p, q) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (by[p[:k]] * by[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), p, by[p[:k]], by[p[k:]]))
        for rank, (s, a, text, _, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, text.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(n=400, seed=1):
    rnd = random.Random(seed)
    vocab = ["New", "york", "é", "a\x1cb", "the", "of", "x" * 300, "\U0001f600", "b"]
    rows = []
    for i in range(n):
        body = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rnd.randrange(40)))
        rows.append((i, rnd.choice([body, body, "new York city hall of the", None, "", "?!"]),
                     rnd.choice(["en", "fr", None]), "s", 1))
    return rows


@pytest.mark.parametrize("floor,top,slack", [(5, 2000, 4), (20, 7, 1), (1, 50, 1)])
def test_collocations_match_brute_force(spark, floor, top, slack):
    rows = texts()
    df = spark.createDataFrame(rows * 2, DOCS).repartition(5)  # repeated rows count each time
    got = collocations.collocations(df, floor=floor, top=top, slack=slack)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations([(r[1], r[2]) for r in rows * 2], floor, top)


def test_collocations_of_odd_tables(spark, odd, empty):
    assert collocations.collocations(empty).collect() == []
    clash = odd.withColumn("phrase", F.lit("x")).withColumn("f", F.lit(1)).withColumn("words", F.lit(1)).withColumn("n", F.lit(2))
    got = collocations.collocations(clash, floor=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations([(r.text, r.lang) for r in odd.collect()], 2, 2000)


def test_a_very_long_text_is_counted_whole(spark):
    body = "alpha beta gamma " * 400_000  # 6.8 MB, cut into slices that carry words over
    df = spark.createDataFrame([(1, body, "en", "s", 1), (2, "y" * 5_000_000 + " z z", "en", "s", 1)], DOCS)
    f = {(r.lang, bytes(r.phrase).decode()[:30]): r.f for r in collocations.phrase_counts(df, floor=100).collect()}
    assert f[("en", "alpha beta gamma")] == 400_000
    assert f[("en", "gamma alpha beta gamma alpha")] == 399_998
    assert f[("en", "")] == 1_200_003


def test_summary_keeps_what_reaches_the_floor():
    rnd = np.random.default_rng(3)
    data = np.concatenate([rnd.integers(100, 60_000, 30_000), np.repeat(np.arange(20), 100), np.repeat(np.arange(20, 40), 99)])
    rnd.shuffle(data)
    for slack in (1, 4):
        s = collocations.Summary(collocations.capacity(len(data), 100, slack))
        for part in np.array_split(data, 37):
            key, n = np.unique(part, return_counts=True)
            s.new.append((key.astype(np.uint64), n.astype(np.int64)))
            s.settle()
            assert len(s.keys) <= s.capacity
        assert 0 < s.taken < 100 / slack
        sure = set(s.keys[s.counts + s.taken >= 100].tolist())
        assert set(range(20)) <= sure and len(sure) < 200


def test_filter_has_every_key(spark):
    keys = np.random.default_rng(5).integers(-2**63, 2**63 - 1, 5000)
    passes = collocations.build_filter(spark, spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert passes(keys.view(np.uint64)).all()
    other = np.random.default_rng(6).integers(-2**63, 2**63 - 1, 5000)
    assert passes(other.view(np.uint64)).mean() < 0.1


# ---------------------------------------------------------------- repair

@functools.cache
def best(symbols, state):
    """Least (cost, audit) of the rest, tried out from the left."""
    options = []
    if not symbols and state in "0a":
        options.append((0, ""))
    after = {"0": "u", "s": "u", "a": "u", "u": "a"}[state]
    if symbols:
        head, rest = symbols[0], symbols[1:]
        c, a = best(rest, state)
        options.append((c + 3, "D" + a))
        if head != "X":
            cut = int(head.isupper())
            c, a = best(rest, after)
            options.append((c + 2 + cut, "R" + a))
            if head.lower() == after or head.lower() == "s" and state == "0":
                c, a = best(rest, head.lower())
                options.append((c + cut, "K" + a))
    if len(symbols) or state != "a":
        for k in (1, 2):  # more than two in a row only make another turn pair
            s = state
            for _ in range(k):
                s = {"0": "u", "s": "u", "a": "u", "u": "a"}[s]
            done = without_insert(symbols, s)
            if done:
                options.append((done[0] + 2 * k, "I" * k + done[1]))
    return min(options) if options else (10**9, "")


@functools.cache
def without_insert(symbols, state):
    if not symbols:
        return (0, "") if state in "0a" else None
    head, rest = symbols[0], symbols[1:]
    after = {"0": "u", "s": "u", "a": "u", "u": "a"}[state]
    c, a = best(rest, state)
    options = [(c + 3, "D" + a)]
    if head != "X":
        cut = int(head.isupper())
        c, a = best(rest, after)
        options.append((c + 2 + cut, "R" + a))
        if head.lower() == after or head.lower() == "s" and state == "0":
            c, a = best(rest, head.lower())
            options.append((c + cut, "K" + a))
    return min(options)


def test_matrices_match_trying_every_edit():
    rnd = random.Random(2)
    seqs = ["".join(x) for n in range(4) for x in itertools.product(repair.SYMBOLS, repeat=n)]
    seqs += ["".join(rnd.choice(repair.SYMBOLS) for _ in range(rnd.randrange(4, 40))) for _ in range(300)]
    seqs += ["ua" * 50, "u" * 40, "X" * 30, "sua" * 20]
    vectors = repair.solve([s.encode() for s in seqs], [repair.START] * len(seqs))
    assert [repair.finished(v) for v in vectors] == [best(s, "0") for s in seqs]


def test_blocks_go_on_from_the_vector():
    rnd = random.Random(4)
    long = "".join(rnd.choice(repair.SYMBOLS) for _ in range(900))
    v = repair.START
    for i in range(0, 900, 250):
        v = repair.solve([long[i:i + 250].encode()], [v])[0]
    assert repair.finished(v) == best(long[:900], "0")


def test_rules_expand_to_the_sequences():
    rnd = random.Random(9)
    seqs = [np.array([rnd.randrange(9) for _ in range(rnd.randrange(30))]) for _ in range(200)] + [np.zeros(33, np.int64)] * 5
    packed, rules = repair.repair_pairs(seqs, np.ones(len(seqs)))
    assert rules

    def expand(k):
        return [k] if k < 9 else [x for part in rules[k - 9] for x in expand(part)]
    assert [[x for k in p.tolist() for x in expand(k)] for p in packed] == [s.tolist() for s in seqs]


CONV = "conv_id long, turn long, role string, text string"


def odd_conversations():
    rnd = random.Random(8)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "a"), (1, None, "user", "a"),
            (2, 5, "assistant", " \t\n"), (2, 9, "", "x!"), (2, 9, "System", "y?"), (3, 0, "system", "s." * 3000)]
    rows += [(c, rnd.choice([None, *range(9)]), rnd.choice(["user", "assistant", "system", "tool", None]),
              rnd.choice(["Yes.", "No", "No", "", None, "Why?  \n", "é!", " "])) for c in range(4, 60) for _ in range(rnd.randrange(9))]
    return rows


def test_repair_matches_sql_on_odd_rows(spark, tmp_path):
    import duckdb
    df = spark.createDataFrame(odd_conversations(), CONV)
    wide = df.withColumn("gone", F.lit(1)).withColumn("audit", F.lit("z")).withColumn("kind", F.lit(3)).withColumn("copy", F.lit(1))
    wide.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    res = con.execute(queries.ORACLE["op12_repair"])
    cols = [d[0] for d in res.description]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted(res.fetchall(), key=key)


def test_repaired_rows_are_legal_and_hash_alike(spark):
    import re
    rows = repair.damaged(spark.createDataFrame(odd_conversations(), CONV))
    found = repair.audited(rows)
    by = {}
    for r in repair.repaired(rows, found).orderBy("conv_id", "place").collect():
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in v)) for v in by.values())
    for r in repair.digests(rows, found).collect():
        lines = "\n".join(f"{role}:{text}" for role, text in by.get(r.of_conv, []))
        assert r.repaired_sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_a_long_conversation_passes_the_block_size(spark):
    n = repair.BLOCK + 5000
    df = spark.range(n).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    rows = df.select("conv_id", "turn", "role", "text", F.lit(False).alias("gone"))
    found = repair.audited(rows)
    assert found.select("cost", "audit").first() == (0, "K" * n)
    body = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:t{i}." for i in range(n))
    assert repair.digests(rows, found).first().repaired_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_repair_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_repair(spark, str(tmp_path)).collect() == []


# ---------------------------------------------------------------- sharding

def lpt(sizes, shards):
    heap = [(0, i) for i in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, i))
    return {i: load for load, i in heap}


def test_deal_is_one_by_one():
    rnd = random.Random(1)
    for _ in range(300):
        loads = [rnd.randrange(50) for _ in range(rnd.randrange(1, 20))]
        size, count = rnd.randrange(1, 30), rnd.randrange(0, 400)
        slow, n = list(loads), [0] * len(loads)
        for _ in range(count):
            i = min(range(len(slow)), key=lambda k: (slow[k], k))
            slow[i] += size
            n[i] += 1
        fast = list(loads)
        assert sharding.deal(fast, size, count) == n and fast == slow


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_match_a_plain_schedule(spark, odd, docs, shards):
    for table in (odd, docs.unionByName(docs.limit(50)), odd.withColumn("shard", F.lit(1)).withColumn("size", F.lit("x"))
                  .withColumn("rank", F.lit(1)).withColumn("copies", F.lit(1))):
        texts_ = [(r.doc_id, r.text or "") for r in table.collect()]
        got = sharding.by_bytes(table.repartition(3), shards).collect()
        assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
            (i is None, i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts_)
        groups = Counter()
        for _, t in texts_:
            groups[t] += len(t.encode()) + 1
        load, slots, home = Counter(), {}, {}
        for r in got:
            load[r.shard] += r.size
            slots.setdefault(r.shard, []).append(r.slot)
            assert home.setdefault((r.text_crc32, r.size), r.shard) == r.shard
        assert all(load[i] == x for i, x in lpt(groups.values(), shards).items())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_an_empty_table_and_a_long_text(spark, empty):
    assert sharding.by_bytes(empty).collect() == []
    long = spark.createDataFrame([(1, "ab" * 3_000_000, "en", "s", 1), (2, "x", None, None, 1)], DOCS)
    assert sorted((r.doc_id, r.size, r.shard, r.slot) for r in sharding.by_bytes(long).collect()) == [
        (1, 6_000_001, 0, 0), (2, 2, 1, 0)]
