"""Language model scoring with a probabilistic suffix tree over words.

Symbols: a text's words (A-Z lower-cased, runs of bytes other than space and
\\x09-\\x0D), then one end symbol. The root is the smoothed word distribution
(c + add) / (N + add * (V + 1)) with one share for every unknown word.

States are contexts of one or two words. An n-gram is an explicit entry of its
context if it occurs ``floor`` times or more in the training rows, whatever the
size of the corpus (``support``, a share of all symbols, is 0 unless a caller
asks for one). A context with entries is retained if its next-symbol
distribution diverges from its parent's (the context without its first word):
Kullback-Leibler divergence, explicit entries apart and all other symbols as one
class, of ``divergence`` nats or more. Smoothing: an entry has
(c + weight * P_parent) / (n + weight); the other symbols of a state share the
rest in proportion to P_parent. A symbol is scored in the longest retained
suffix of what precedes it, so

    score = base_score + sum of (entry gain, or the state's log share factor).

Nothing of the tree is broadcast or collected; it grows with the corpus:
 1. word counts: counted per task, summed in Spark, written to the shared folder;
 2. the ``frequent`` most frequent words get numbers (a broadcast of fixed size,
    for speed), every other word is a 63-bit hash, its code; texts are written
    once as these ids. Words that share a code (v * v / 2 ** 63 of v words) get
    numbers, too, so codes are exact. A word too rare for an entry is left out of
    n-grams: no n-gram is more frequent than its words;
 3. texts lie in chunks of about ``_CHUNK`` symbols, a row each, in a table in
    buckets of chunks; answers are written in the same buckets, so texts are never
    shuffled, and an answer once. A chunk asks for
    what it needs about its own n-grams: it sends sorted 64-bit keys with its
    counts to buckets (ranges of keys, more of them for a larger corpus), which
    add them up and answer each chunk that asked, one value per key. So a hot
    n-gram is one key a chunk. The first chunk that asked owns an n-gram: it
    adds the entry to the sums of its context;
 4. rounds: words without a number, whose counts the base takes, too; pairs of words frequent enough for an entry;
    sums of one-word contexts, and triples whose both pairs are entries (no other
    can be one); sums of two-word contexts; scores.

Two n-grams with equal 64-bit keys would share a count; the chance that any
entry among a billion keys is met by another n-gram is below 1 in 10.

Defined cases: a null text is empty: one token, the end. A null id counts as
the empty text for the split. With nothing to learn from, N = V = 0 and every
token has probability 1 (its log is 0). Repeated rows are scored, and learned
from, each.
"""

from __future__ import annotations

import math
import struct
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .common import field, new_folder, small_batches, staged

ADD = 0.1
SUPPORT, FLOOR, DIVERGENCE, WEIGHT = 0.0, 8, 0.01, 20.0
#: Numbered words, and the longest of them in bytes: bounds that broadcast. Other words are hashes.
FREQUENT, LONGEST = 1 << 18, 64
_CHUNK = 1_250_000  # symbols of a chunk
_BUCKET = 4_000_000  # symbols a bucket of keys stands for
_MOST_PARTS = 100_000  # partitions of chunks (Spark's bound for buckets); beyond it a partition has more chunks
_FLUSH = 1_000_000  # distinct words a task holds


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(docs: DataFrame, held: Column, text: str) -> DataFrame:
    """(word binary, n): every word of the rows, and its count in the training rows."""
    src = docs.select(held.alias("held"), F.col(text).cast("binary").alias("body"))

    def run(batches):
        from collections import Counter
        have: Counter = Counter()

        def out():
            words, n = list(have.keys()), list(have.values())
            for lo in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[lo:lo + 50_000], pa.binary()),
                                                  pa.array(n[lo:lo + 50_000], pa.int64())], names=["word", "n"])
        for batch in batches:
            for held_out, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held_out is False:
                    have.update(_words(body))
                else:
                    have.update(dict.fromkeys(_words(body), 0))
                if len(have) > _FLUSH:
                    yield from out()
                    have.clear()
        yield from out()
    return src.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _code(word: bytes) -> int:
    """The symbol of a word without a number, below -1."""
    return min((xxh64_intdigest(word, 42) >> 1) - (1 << 63), -2)


def _raised_code(word: str) -> Column:
    """``_code`` plus 2 ** 63, by Spark."""
    return F.least(F.shiftrightunsigned(F.xxhash64(word), 1), F.lit((1 << 63) - 2))


def alike(counts: DataFrame) -> DataFrame:
    """The words whose ``_code`` another word has, too: about v * v / 2 ** 63 of v
    words. With numbers of their own, codes tell all other words apart."""
    several = counts.groupBy(_raised_code("word").alias("code")).agg(F.count(F.lit(1)).alias("words")).where(
        "words > 1").select("code")
    return counts.withColumn("code", _raised_code("word")).join(several, "code", "left_semi").select("word", "n")


def _encode(docs: DataFrame, doc_id: str, text: str, held: Column, top, add: float, least: int) -> DataFrame:
    """One row per chunk of whole documents. ``chunk``: the row number of the
    first. ``data``: ids of their symbols (0: the end; above 0: numbered; below
    -1: a code; -1: numbered, but too rare for an entry). ``docs``: of each
    document, its tokens, its numbered tokens that are known and their base logs.
    A chunk is one row, so no reader splits it."""
    shared, per_chunk = docs.sparkSession.sparkContext.broadcast(top), _CHUNK
    small_batches(docs.sparkSession)
    src = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"),
                      F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").cast("binary").alias("body"))
    made = [field("n_tokens", "long"), field("n_numbered", "long"), field("base", "double")]
    doc = T.StructType([T.StructField(f.name, f.dataType, True) for f in src.schema.fields[:3]] + made)
    schema = T.StructType([field("chunk", "long"), field("data", "binary"), T.StructField("docs", T.ArrayType(doc), True)])
    kinds = [pa.int64(), pa.int64(), pa.float64()]

    def run(batches):
        words, counts = shared.value
        find = {w: i + 1 for i, w in enumerate(words)}.get
        logs = np.log10(np.concatenate([counts, [0]]) + add)  # of the end first; -1 is the last
        logs[-1] = 0.0
        known_id = np.where(counts >= least, np.arange(len(counts)), -1)
        known_id[0] = 0
        known = np.append(counts > 0, False)
        chunk: list = []  # (row, trained, ids) of each document
        carried: list = []  # slices of the columns that go through unread
        made: list = [[] for _ in kinds]
        done = 0

        def part(batch, lo, hi):  # copies: a slice would keep the texts of its batch
            return [c.take(pa.array(np.arange(lo, hi))) for c in batch.columns[:3]]

        def whole():
            rows, train, ids = zip(*chunk, strict=True)
            head = _pack(np.array(rows, np.int64), np.array(train, np.int64), np.array([len(x) for x in ids], np.int64))
            data = struct.pack("<q", len(head)) + head + _pack(np.concatenate(ids))
            cols = [pa.concat_arrays(x) for x in zip(*carried, strict=True)]
            cols += [pa.array(x, k) for x, k in zip(made, kinds, strict=True)]
            each = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.StructArray.from_arrays(cols, names=doc.names))
            for x in (chunk, carried, *made):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([rows[0]], pa.int64()), pa.array([data], pa.binary()), each], names=schema.names)
        for batch in batches:
            begin = 0
            for i, (row, held_out, t) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 1, 3)), strict=True)):
                w = _words(t)
                a = np.fromiter((find(x, -1) for x in w), np.int64, len(w))
                a = np.append(a, np.int64(0))
                code = known_id[a]
                other = np.flatnonzero(a < 0)
                if len(other):
                    code[other] = [_code(w[j]) for j in other.tolist()]
                chunk.append((row, held_out is False, code))
                done += len(a)
                values = len(a), int(known[a].sum()), float(logs[a].sum())
                for x, v in zip(made, values, strict=True):
                    x.append(v)
                if done >= per_chunk:
                    carried.append(part(batch, begin, i + 1))
                    yield whole()
                    begin, done = i + 1, 0
            if begin < batch.num_rows:
                carried.append(part(batch, begin, batch.num_rows))
        if chunk:
            yield whole()
    return src.mapInArrow(run, schema)


# ------------------------------------------------------------- keys and blocks

_U = np.uint64


def _mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def _word_key(ids: np.ndarray) -> np.ndarray:
    return _mix(ids.view(_U) + _U(0x9E3779B97F4A7C15))


def _longer_key(key: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Key of an n-gram with one more symbol."""
    return _mix(key + nxt.view(_U) * _U(0xD6E8FEB86659FD93))


def _pair_key(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Key of a pair. Two numbers of ``bits`` bits are kept one to one: the upper
    part mixes both, so that no frequent word crowds a range of keys, the next is
    the second number, and the rest is zero. Keys then lie in a small space, and
    their differences pack into few bytes. Other pairs are hashes, always odd."""
    key = _longer_key(_word_key(first), second) | _U(1)
    if 2 * bits < 64:
        both = np.flatnonzero((first >= 0) & (second >= 0))
        a, b = first[both].view(_U), second[both].view(_U)
        upper = a * _U(0x9E3779B97F4A7C15) + b * _U(0xBF58476D1CE4E5B9)
        key[both] = (upper << _U(64 - bits)) | (b << _U(64 - 2 * bits))
    return key


def _pack(*cols: np.ndarray) -> bytes:
    """64-bit columns as compressed byte planes."""
    a = np.stack([c.view(np.uint8).reshape(-1, 8).T for c in map(np.ascontiguousarray, cols)])
    raw = a.tobytes()
    return struct.pack("<qq", len(cols), len(cols[0])) + pa.compress(raw, "zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    k, n = struct.unpack_from("<qq", data)
    raw = pa.decompress(data[16:], k * n * 8, "zstd", asbytes=True)
    a = np.frombuffer(raw, np.uint8).reshape(k, 8, n)
    return [np.ascontiguousarray(x.T).reshape(-1).view(_U) for x in a]


def _pack_keys(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Sorted keys with float values."""
    return _pack(np.diff(keys, prepend=_U(0)), *[np.asarray(v, np.float64) for v in values])


def _unpack_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys, *values = _unpack(data)
    return np.cumsum(keys, dtype=_U), np.stack([v.view(np.float64) for v in values])


#: What blocks are about: counts of words, pairs and triples; states of one and two words.
WORD, PAIR, TRIPLE, ONE, TWO = range(5)
_COUNTS = (WORD, PAIR, TRIPLE)
_BLOCK = "chunk long, kind int, bucket int, data binary"


@contextmanager
def _chunk_by_chunk(spark):
    """One chunk at a time in a worker: Arrow batches of one row, for a while."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by_chunk(df: DataFrame, parts: int) -> DataFrame:
    """``df`` written to the shared folder as a table in buckets of ``chunk``:
    what is known of a chunk is read beside its texts, and neither moves again."""
    path = new_folder(df.sparkSession)
    name = "suffix_tree_" + path.rsplit("/", 1)[1]
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(parts, "chunk").saveAsTable(name)
    return df.sparkSession.table(name)


_BLOCK_ARROW = {"chunk": pa.int64(), "kind": pa.int32(), "bucket": pa.int32(), "data": pa.binary()}


def _block_rows(rows) -> pa.Table:
    rows = list(rows)
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(_BLOCK_ARROW.items())})


def _ask(chunk: int, kind: int, buckets: int, keys: np.ndarray, *values: np.ndarray):
    """One block per bucket, a range of the sorted keys."""
    step = -(-(1 << 64) // buckets)
    cut = np.searchsorted(keys, np.array([step * i for i in range(1, buckets)], _U))
    cut = [0, *cut.tolist(), len(keys)]
    for b in range(buckets):
        lo, hi = cut[b], cut[b + 1]
        if hi > lo:
            yield chunk, kind, b, _pack_keys(keys[lo:hi], *[v[lo:hi] for v in values])


def _factors(total: np.ndarray, sums: np.ndarray, weight: float, divergence: float) -> np.ndarray:
    """log10 of the factor of a context's symbols that are no entries; NaN if the
    context isn't retained. sums: of n, q and x * log(x / q), where x = n + weight * q."""
    out = np.full(len(total), np.nan)
    has = np.flatnonzero(sums[0] > 0)
    (n, q, xlog), t = sums[:, has], total[has] + weight
    x = n + weight * q
    rest, rest_parent = np.clip(1 - x / t, 1e-12, 1), np.clip(1 - q, 1e-12, 1)
    kl = (xlog - np.log(t) * x) / t + rest * np.log(rest / rest_parent)
    out[has] = np.where(kl >= divergence, np.log10(rest / rest_parent), np.nan)
    return out


def _answered(asked: DataFrame, buckets: int, parts: int, name: str, least: int, weight: float, divergence: float) -> DataFrame:
    """Blocks added up by key, and an answer for each block, one value per key it
    asked about; a row a chunk, with all its answers in column ``name``. Counts: of
    words as they are, else 0 below ``least``, and negative for the one chunk that owns the n-gram. Contexts: see _factors."""
    def add_up(t: pa.Table) -> pa.Table:
        out = []
        kinds, chunks, bucket = t["kind"].to_numpy(), t["chunk"].to_numpy(), t["bucket"][0].as_py()
        for kind in np.unique(kinds).tolist():
            at = np.flatnonzero(kinds == kind)
            at = at[np.argsort(chunks[at], kind="stable")]  # the same order of sums every time
            blocks = [_unpack_keys(t["data"][int(i)].as_py()) for i in at]
            ends = np.cumsum([len(k) for k, _ in blocks]).tolist()
            keys = np.concatenate([k for k, _ in blocks])
            values = np.concatenate([v for _, v in blocks], axis=1)
            blocks = None  # what is read no more goes at once: a worker holds its bucket once
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            head = np.r_[True, keys[1:] != keys[:-1]]
            keys, starts = None, np.flatnonzero(head)
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(head) - 1
            if kind in _COUNTS:
                total = np.add.reduceat(values[0, order], starts)
                if kind == WORD:
                    answer = total[group]
                else:
                    answer = np.where(total >= least, total, 0.0)[group]
                    answer[order[starts]] *= -1
            else:  # the owners of a context's entries send its count and their sums
                sums = np.add.reduceat(values[1:, order], starts, axis=1)
                answer = _factors(np.maximum.reduceat(values[0, order], starts), sums, weight, divergence)[group]
            values = order = group = None
            for i, begin, end in zip(at.tolist(), [0, *ends[:-1]], ends, strict=True):
                out.append((int(chunks[i]), kind, bucket, _pack(answer[begin:end])))
        pa.default_memory_pool().release_unused()
        return _block_rows(out)
    told = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add_up, _BLOCK)
    told = told.repartition(parts, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "data")).alias(name))
    return _by_chunk(told, parts)


class _Entries:
    """The distinct n-grams at some places of a chunk, and what is known of them."""

    def __init__(self, places: np.ndarray, keys: np.ndarray):
        self.places = places.astype(np.int32)  # a chunk's places and numbers fit
        self.keys, number = np.unique(keys, return_inverse=True)
        self.number = number.astype(np.int32)

    def counted(self, train: np.ndarray) -> np.ndarray:
        return np.bincount(self.number[train[self.places]], minlength=len(self.keys))

    def told(self, answer: np.ndarray, size: int) -> None:
        """Leave the entries: their counts, whether they are owned, a place of
        each, and the entry at each of ``size`` places (-1: none)."""
        kept = np.flatnonzero(answer)
        number = np.full(len(self.keys), -1, np.int64)
        number[kept] = np.arange(len(kept))
        self.keys, self.n, self.own = self.keys[kept], np.abs(answer[kept]), answer[kept] < 0
        self.at = np.full(size, -1, np.int64)
        self.at[self.places] = number[self.number]
        self.places = self.number = None  # read no more
        self.place = np.zeros(len(kept), np.int64)
        has = np.flatnonzero(self.at >= 0)
        self.place[self.at[has]] = has


class _Chunk:
    """The texts of a chunk, and what it was told about their n-grams."""

    def __init__(self, no: int, text: bytes, answers: list, model: tuple):
        counts, norm, self.add, self.weight, least = model
        self.no, rounds = no, len(answers)
        told: dict = {}
        for x in (x for one in answers for x in one or []):  # none: nothing was asked
            told.setdefault(x["kind"], []).append((x["bucket"], x["data"]))
        n = 8 + struct.unpack_from("<q", text)[0]
        self.rows, train, self.sizes = (x.view(np.int64) for x in _unpack(text[8:n]))
        self.ids = _unpack(text[n:])[0].view(np.int64)
        self.train = np.repeat(train.astype(bool), self.sizes)
        self.answers = {kind: np.concatenate([_unpack(b)[0].view(np.float64) for _, b in sorted(x)]) for kind, x in told.items()}
        ids = self.ids
        other = np.flatnonzero(ids < -1)
        self.words = _Entries(other, _word_key(ids[other]))
        if rounds > 0:
            self._words(counts, least)
        if rounds > 1:
            self._pairs(norm)
        if rounds > 2:
            self._triples()

    def answer(self, kind: int) -> np.ndarray:
        """Each is read once and left."""
        return self.answers.pop(kind, np.zeros(0))  # nothing was asked

    def ask_words(self, buckets: int):
        yield from _ask(self.no, WORD, buckets, self.words.keys, self.words.counted(self.train))

    # -- counts of words known: a word too rare for an entry leaves the n-grams
    def _words(self, counts: np.ndarray, least: int) -> None:
        ids, words, self.counts = self.ids, self.words, counts
        bits = len(counts).bit_length()
        self.dense = _U(63 - bits)
        self.count = counts[np.maximum(ids, 0)].astype(np.float64)
        self.looked = words.places, self.answer(WORD)[words.number]
        if len(words.places):
            self.count[words.places] = self.looked[1]
            ids[words.places[self.looked[1] < least]] = -1
        self.words = None  # read no more
        at = np.flatnonzero((ids[:-1] != 0) & (ids[:-1] != -1) & (ids[1:] != -1))  # nothing follows the end
        self.pair = _Entries(at, _pair_key(ids[at], ids[at + 1], bits))

    def without_number(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each document, the base logs of the words without a number, and how
        many of them are known."""
        at, n = self.looked
        doc, k = np.searchsorted(np.cumsum(self.sizes), at, side="right"), len(self.sizes)
        base = np.bincount(doc, np.log10(n + self.add), k).astype(np.float64)  # integers if there are none
        return base, np.bincount(doc[n > 0], minlength=k)

    def ask_pairs(self, buckets: int):
        yield from _ask(self.no, PAIR, buckets, self.pair.keys, self.pair.counted(self.train))

    # -- counts of pairs known
    def _pairs(self, norm: float) -> None:
        ids, pair = self.ids, self.pair
        key = np.zeros(len(ids), _U)
        key[pair.places] = pair.keys[pair.number]
        pair.told(self.answer(PAIR), len(ids))
        self.root = (self.count + self.add) / norm
        self.root2 = self.root[pair.place + 1]
        at = np.flatnonzero((pair.at[:-1] >= 0) & (pair.at[1:] >= 0))
        self.three = _Entries(at, _longer_key(key[at], ids[at + 2]))
        # numbers are spread evenly over the keys, in their order: sorted, their differences pack well
        has, coded = np.flatnonzero(ids > 0), np.flatnonzero(ids < -1)
        numbers = np.flatnonzero(np.bincount(ids[has], minlength=len(self.counts)))
        codes, place, number = np.unique(ids[coded], return_index=True, return_inverse=True)
        keys = np.r_[numbers.view(_U) << self.dense, _word_key(codes)]
        order = np.argsort(keys)
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        self.key1, self.total1 = keys[order], np.r_[self.counts[numbers], self.count[coded[place]]][order]
        self.one = np.full(len(ids), -1, np.int64)  # one-word context of a place
        context = np.zeros(len(self.counts), np.int64)
        context[numbers] = rank[:len(numbers)]
        self.one[has] = context[ids[has]]
        self.one[coded] = rank[len(numbers) + number]

    def _sums(self, n: np.ndarray, q: np.ndarray, context: np.ndarray, k: int) -> list[np.ndarray]:
        x = n + self.weight * q
        return [np.bincount(context, v, k) for v in (n, q, x * np.log(x / q))]

    def ask_triples(self, buckets: int):
        own = self.pair.own
        sums = self._sums(self.pair.n[own], self.root2[own], self.one[self.pair.place[own]], len(self.key1))
        yield from _ask(self.no, ONE, buckets, self.key1, np.where(sums[0] > 0, self.total1, 0), *sums)
        yield from _ask(self.no, TRIPLE, buckets, self.three.keys, self.three.counted(self.train))

    # -- one-word states and counts of triples known
    def _triples(self) -> None:
        pair, three = self.pair, self.three
        factor = np.r_[self.answer(ONE), np.nan][self.one]
        self.keep1 = ~np.isnan(factor)
        self.factor1 = np.where(self.keep1, factor, 0.0)
        smooth = (pair.n + self.weight * self.root2) / (self.count[pair.place] + self.weight)
        self.p2 = np.where(self.keep1[pair.place], smooth, self.root2)  # in the state of its context, or the root
        three.told(self.answer(TRIPLE), len(self.ids))
        self.first3 = pair.at[three.place]
        second = pair.at[three.place + 1]
        self.parent3, self.root3 = self.p2[second], self.root2[second]

    def ask_states(self, buckets: int):
        own, k = self.three.own, len(self.pair.keys)
        sums = self._sums(self.three.n[own], self.parent3[own], self.first3[own], k)
        yield from _ask(self.no, TWO, buckets, self.pair.keys, np.where(sums[0] > 0, self.pair.n, 0), *sums)

    # -- all known
    def scored(self) -> pa.Table:
        base, known = self.without_number()
        return pa.table({"row": pa.array(self.rows), "gain": pa.array(self.gains()),
                         "other_base": pa.array(base), "other_known": pa.array(known.astype(np.int64))})

    def gains(self) -> np.ndarray:
        """Sum over each document's symbols of log10 P(state) - log10 P(root)."""
        pair, three = self.pair, self.three
        gain = np.zeros(len(self.ids))
        gain[1:] = self.factor1[:-1]  # the end has no state, its factor is 0
        at = np.flatnonzero((pair.at >= 0) & self.keep1)
        gain[at + 1] = (np.log10(self.p2) - np.log10(self.root2))[pair.at[at]]
        factor = self.answer(TWO)
        at = np.flatnonzero((pair.at[:-1] >= 0) & (self.ids[1:] != 0))
        at = at[~np.isnan(factor[pair.at[at]])]
        p3 = (three.n + self.weight * self.parent3) / (pair.n[self.first3] + self.weight)
        gain3 = np.r_[np.log10(p3) - np.log10(self.root3), 0.0]
        t = three.at[at]
        gain[at + 2] = np.where(t >= 0, gain3[t], gain[at + 2] + factor[pair.at[at]])
        return np.add.reduceat(gain, np.cumsum(self.sizes) - self.sizes)


def _gains(texts: DataFrame, parts: int, model: tuple, n_all: int, least: int, divergence: float) -> DataFrame:
    """(row, gain, other_base, other_known) of every document: the gain, and what
    ``without_number`` returns."""
    buckets = max(16, -(-n_all // _BUCKET))
    shared = texts.sparkSession.sparkContext.broadcast(model)  # numbered words at most

    def each(known: DataFrame, do, schema: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    no, text, *answers = (c[i].as_py() for c in batch.columns)
                    chunk = _Chunk(no, text, answers, shared.value)
                    text = answers = None  # unpacked
                    out, chunk = do(chunk), None
                    pa.default_memory_pool().release_unused()
                    yield from out.to_batches()
        return known.mapInArrow(run, schema)

    known = texts
    rounds = (_Chunk.ask_words, _Chunk.ask_pairs, _Chunk.ask_triples, _Chunk.ask_states)
    with _chunk_by_chunk(texts.sparkSession):
        for i, ask in enumerate(rounds):
            asked = each(known, lambda c, ask=ask: _block_rows(ask(c, buckets)), _BLOCK)
            told = _answered(asked, buckets, parts, f"told{i}", least, model[3], divergence)
            known = known.join(told.hint("merge"), "chunk", "left")  # both lie in buckets of the chunk: no shuffle
        return staged(each(known, _Chunk.scored, "row long, gain double, other_base double, other_known long"))


def score(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", add: float = ADD,
          support: float = SUPPORT, floor: int = FLOOR, divergence: float = DIVERGENCE, weight: float = WEIGHT,
          frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).
    ``held``: the condition of rows that are not learned from."""
    spark = docs.sparkSession
    counts = staged(word_counts(docs, held, text), "zstd")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    ends = docs.where(~held).count()
    n_all, v_all = words + ends, distinct + (1 if ends else 0)
    top = counts.where((F.length("word") <= LONGEST) & (F.col("n") > 0)).orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    numbered = dict(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True))
    same = alike(counts).limit(FREQUENT + 1).collect()
    if len(same) > FREQUENT:
        raise ValueError("too many words share their codes")
    numbered |= {bytes(r["word"]): r["n"] for r in same}
    number_counts = np.array([ends, *numbered.values()], np.int64)
    part = max(support, floor / n_all) if n_all else 1.0
    least = max(1, math.ceil(part * n_all - 1e-9))
    parts = min(_MOST_PARTS, max(48, -(-n_all // _CHUNK)))
    chunks = _by_chunk(_encode(docs, doc_id, text, held, (list(numbered), number_counts), add, least), parts)
    norm = n_all + add * (v_all + 1) if n_all else 1.0
    coded = chunks.select(F.explode("docs").alias("x")).select("x.*")
    carried = coded.select("row", "doc_id", "held_out", "n_numbered", "base", "n_tokens")
    model = number_counts, norm, add, weight, least
    out = carried.join(_gains(chunks.select("chunk", "data"), parts, model, n_all, least, divergence), "row") if n_all else (
        carried.select("*", F.lit(0.0).alias("gain"), F.lit(0.0).alias("other_base"), F.lit(0).alias("other_known")))
    base = (F.col("base") + F.col("other_base") - F.col("n_tokens") * F.lit(math.log10(norm)) if n_all else F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_numbered") + F.col("other_known")).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("gain")).alias("score"))
