import random

import brute
import pytest
from pyspark.sql import functions as F

from quayside.llm import chat, packing

EVENTS = "conv long, seq long, kind string, msg long, role string, text string"


def fold(events):
    """A plain replay of one conversation's events."""
    msgs = {}
    for seq, kind, msg, role, text in sorted(events, key=lambda e: (e[0], e[4] or "")):
        text = text or ""
        if msg not in msgs:
            msgs[msg] = [seq, role or "", ""]
        if kind == "delta":
            msgs[msg][2] += text
        else:
            msgs[msg][2] = text
        if kind == "regenerate":
            for m in [m for m, x in msgs.items() if msgs[msg][0] < x[0] < seq]:
                msgs[m].append("gone")
    return [(x[1], x[2]) for x in sorted(msgs.values(), key=lambda x: x[0]) if len(x) == 3]


def test_fold_matches_a_replay(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        for seq in range(rng.randrange(1, 15)):
            msg = rng.randrange(5)
            rows.append((conv, seq, rng.choice(["message", "delta", "delta", "edit", "regenerate"]), msg,
                         ["user", "assistant"][msg % 2], rng.choice(["a", "b\\", "<|x", None, "\n"])))
    got = {}
    for r in chat.reconstruct(spark.createDataFrame(rows, EVENTS)).orderBy("conv", "at").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    for conv in range(60):
        want = fold([r[1:] for r in rows if r[0] == conv])
        if want or conv in got:
            assert got.get(conv, []) == want


NASTY = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\", "<\\|", "\\<|", "<|", "<<||", "a\\n\nb", "", None, "é😀<|", "\\<\\|\\"]


def test_round_trip_and_loss_mask(spark):
    rows = [(c, t, r, x) for c, r in enumerate(["user", "assistant", "sys\ntem<|\\", None])
            for t, x in enumerate(NASTY)] + [(9, 0, "assistant", "tie"), (9, 0, "assistant", "tie"), (None, 1, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_log(chat.turn_events(df))
    out = {r.conv: r for r in done.select("*", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert len(out) == 6
    for conv, r in out.items():
        want = [((x[2] or ""), (x[3] or "")) for x in rows if x[0] == conv]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(want)
        texts = [x for role, x in want if role == "assistant"]
        assert r.loss == [role == "assistant" for role, _ in want]
        spans = [r.formatted[s.start:s.end] for s in r.loss_spans]
        back = spark.createDataFrame([(s,) for s in spans] or [("",)], "s string").select(chat.unescape(F.col("s"))).collect()
        assert [b[0] for b in back][:len(texts)] == texts
    assert chat.format_log(chat.turn_events(df.where("false"))).collect() == []


def test_no_python_in_the_chat_plan(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.format_log(chat.turn_events(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "InArrow"))


# ------------------------------------------------------------------ packing

def _plain(pieces, capacity):
    """Best fit decreasing by trying every bin."""
    bins, out = [], {}
    for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][0]):
        size, s, c = pieces[i]
        ok = [b for b in range(len(bins)) if bins[b][0] >= size and (s is None or s not in bins[b][1])
              and (c is None or c not in bins[b][2])]
        if ok:
            b = min(ok, key=lambda b: (bins[b][0], b))
        else:
            b = len(bins)
            bins.append([capacity, set(), set()])
        bins[b][0] -= size
        bins[b][1].add(s)
        bins[b][2].add(c)
        out[i] = b
    return [out[i] for i in range(len(pieces))]


@pytest.mark.parametrize("seed", range(5))
def test_pack_is_constrained_best_fit(seed):
    rng = random.Random(seed)
    pieces = [(rng.randrange(1, 40), rng.choice([None, *range(6)]), rng.choice([None, *range(30)])) for _ in range(300)]
    assert packing.pack(pieces, 40) == _plain(pieces, 40)


def test_documents_are_packed_whole(docs, odd, empty):
    out = packing.best_fit(docs, capacity=256, shard=64).collect()
    words = {r[0]: len((r[1] or "").split()) + 1 for r in docs.select("doc_id", "text").collect()}
    got, bins = {}, {}
    for r in out:
        got.setdefault(r.doc_id, []).append((r.start, r.size))
        bins.setdefault(r.bin_id, []).append(r)
    for i, n in words.items():
        at = 0
        for start, size in sorted(got[i]):
            assert start == at
            at += size
        assert at == n
    for rows in bins.values():
        assert sum(r.size for r in rows) <= 256
        s = [r.source for r in rows if r.source is not None]
        assert len(s) == len(set(s))
    assert packing.best_fit(odd).count() >= odd.count()
    assert packing.best_fit(empty).collect() == []


def test_copies_never_share_a_bin(spark):
    df = spark.createDataFrame([(i, "same text", None, 1) for i in range(50)] + [(99, None, None, 1)],
                               "doc_id long, text string, source string, size int")
    out = packing.best_fit(df).where("doc_id < 50").collect()
    assert len({r.bin_id for r in out}) == 50


def test_near_copies_do_not_share_a_bin(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(5):
        body = [rng.choice(words) for _ in range(250)]
        for k in range(6):
            texts.append(" ".join([*body[:-1], f"v{k}"]))  # one word differs
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    cls = brute.classes(list(range(len(texts))), [brute.simhash(t) for t in texts])
    assert len(set(cls)) < len(texts) - 5  # there are near copies
    bins = {}
    for r in packing.best_fit(df).collect():
        bins.setdefault(r.bin_id, []).append(cls[r.doc_id])
    assert all(len(set(x)) == len(x) for x in bins.values())
    assert any(len(x) > 1 for x in bins.values())
