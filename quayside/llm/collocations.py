"""Phrase collocations: Misra-Gries summaries, then exact counts.

Text: A-Z are lower-cased, ``[.,;:!?\\x0A-\\x0D]`` end a piece, words are the runs
of bytes other than space and tab. A phrase is 1 to ``longest`` consecutive
words of one piece; its frequency is counted per language, overlaps included.

First pass, one scan per phrase length m: phrases (as 64-bit hashes with the
language) are dealt to hash partitions. Each task adds up its own phrases and
sends every partition its part, with the mass (occurrences) it stands for. A
partition learns its whole mass first, then merges the parts into one
Misra-Gries summary of more than ``slack`` * mass / floor counters: whenever
there are more, the value of the first counter too many is taken off all of
them and those at zero go. What is taken off in all is less than floor / slack,
so every phrase of ``floor`` occurrences survives, and a counter plus what was
taken off bounds its phrase's frequency from above; those below the floor go.
A phrase of m words can reach the floor only if its first and last m - 1 words
do, so a scan offers no others: survivors are handed to the next scan as a
bitmap of ``FILTER_BITS`` bits at most (16 MB, whatever the input). A false
positive there costs a counter, never a result; the same goes for two phrases
with one hash, since both passes are exact by text in the end:

Second pass, one scan for all lengths: phrases that the bitmaps let through are
counted exactly, as texts, and those below the floor go.

Scores come from joins of that table with itself. All parts of a phrase are at
least as frequent as it, so they are in the table.

Defined cases: a null text is empty; a null language is ``und``; repeated rows
count each time; ties are settled by phrase; an empty table gives an empty
result; other columns are ignored. Texts of any length are read in slices that
carry the last words over; a word longer than a slice makes it longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, share, small_batches, staged

UND = "und"
#: Bits of the bitmap that hands survivors from one scan to the next, at most.
FILTER_BITS = 1 << 27
#: Occurrences that one hash partition should stand for; partitions at most.
PARTITION_MASS, PARTITIONS = 1 << 23, 1 << 16
#: Phrases that a task adds up before it sends them, those in one row; words it
#: keeps numbered.
_HELD, _ROW, _WORDS = 1 << 22, 1 << 13, 1 << 18
#: Bytes of a slice in the first pass (its arrays fit a cache) and in the second
#: (phrases are added up within one).
_SLICE, _COUNTED = 1 << 17, 1 << 21
_FOLD = bytes(10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
              for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What each byte adds to a word's polynomial; 0 for the two that part words.
_KIND = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)
_KIND[[10, 32]] = 0
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        for i, base in enumerate((int(_ODD), pow(int(_ODD), -1, 1 << 64))):
            new = np.full(max(n, 1 << 16), base, np.uint64)
            new[0] = 1
            _POWERS[i:i + 1] = [np.cumprod(new)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Numbers(dict):
    """Words numbered as they come, for exact comparison."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Slice:
    """A stretch of folded texts: its words' hashes (polynomials of their bytes,
    all at once), the piece of each, how many the slice before has had."""

    def __init__(self, data: bytes, carried: int):
        self.data, self.carried = data, carried
        arr = np.frombuffer(data, np.uint8)
        value = _KIND[arr]
        inside = np.zeros(len(arr) + 2, bool)
        inside[1:-1] = value > 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, ends = edges[::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(arr == 10), self.starts)
        power, back = _powers(len(arr))
        total = np.zeros(len(arr) + 1, np.uint64)
        np.cumsum(value * power, out=total[1:])
        self.words = (total[ends] - total[self.starts]) * back[self.starts] + (ends - self.starts).astype(np.uint64)


def slices(texts: list[bytes], keep: int, size: int) -> Iterator[Slice]:
    """The texts, folded, slice by slice; the last ``keep`` words of a slice begin
    the next one."""
    for joined in _grouped(texts, size):
        data = joined.translate(_FOLD)
        lo, last = 0, np.zeros(0, np.int64)
        while lo < len(data):
            hi = min(lo + size, len(data))
            if hi < len(data):
                ends = [e for e in (data.find(b" ", hi), data.find(b"\n", hi)) if e >= 0]
                hi = min(ends) if ends else len(data)
            first = int(last[0]) if len(last) else lo
            part = Slice(data[first:hi], len(last))
            yield part
            last = (part.starts + first)[-keep:] if keep else last
            lo = hi


def _grouped(texts: list[bytes], size: int) -> Iterator[bytes]:
    part: list[bytes] = []
    held = 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield b"\n".join(part)
            part, held = [], 0
    if part:
        yield b"\n".join(part)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 7) | 1)


def grams(part: Slice, seed: np.uint64, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For m = 1 to longest: (start, key) of the phrases of m words."""
    word = _mixed(part.words ^ seed)
    start, key = np.arange(len(word)), word
    yield start, key
    for m in range(2, longest + 1):
        ok = np.flatnonzero(start + (m - 1) < len(word))
        ok = ok[part.piece[start[ok] + (m - 1)] == part.piece[start[ok]]]
        start, key = start[ok], key[ok]
        key = _mixed((key * _ODD) + word[start + (m - 1)])
        yield start, key


class Filter:
    """A bitmap of keys; the leading bits of a key are its place."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]]):
        self.shift = np.uint64(64 - bits.bit_length() + 1)
        self.bits = np.zeros(max(bits // 8, 1), np.uint8)
        for bucket, data in parts:  # Spark's buckets hold 32,768 bits and count from 1
            lo = (bucket - 1) * 4096
            part = np.frombuffer(data, np.uint8)[:len(self.bits) - lo]
            self.bits[lo:lo + len(part)] = part

    def __call__(self, key: np.ndarray) -> np.ndarray:
        at = key >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def build_filter(spark: SparkSession, keys: DataFrame) -> Filter:
    """The bitmap of the ``key`` column, about 32 bits a key, made by Spark's
    bitmap aggregates: what reaches the driver is the bitmap."""
    n = keys.count()
    bits = min(max(1 << (max(n, 1) * 32 - 1).bit_length(), 1 << 15), FILTER_BITS)
    at = keys.select((F.shiftrightunsigned("key", 64 - bits.bit_length() + 1) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    return Filter(bits, [(r["bucket"], bytes(r["bits"])) for r in parts.collect()])


def _offered(part: Slice, seed: np.uint64, filters: list[Filter]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For m = 1 to len(filters) + 1: (start, key) of the phrases of m words
    whose parts passed their filters; the last ones are not filtered themselves."""
    good = np.ones(len(part.words) + 1, bool)
    for m, (start, key) in enumerate(grams(part, seed, len(filters) + 1)):
        take = good[start] & good[start + 1] if m else np.ones(len(start), bool)
        if m < len(filters):
            take &= filters[m](key)
        good = np.zeros(len(part.words) + 1, bool)
        good[start[take]] = True
        yield start[take], key[take]


def _by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    by: dict[str, list[bytes]] = {}
    for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        if body:
            by.setdefault(UND if lang is None else lang, []).append(body)
    return by


def _sent(source: DataFrame, m: int, shared, partitions: int) -> DataFrame:
    """(part, mass, keys, counts): each task's added-up phrases of m words, one
    row per hash partition; ``mass`` stands on a row of its own that sorts
    before the others."""
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        part = (key % np.uint64(partitions)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        key, n, part = key[order], n[order].astype(np.uint32), part[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        where, mass = part[cuts].tolist(), np.add.reduceat(n.astype(np.int64), cuts).tolist()
        none = [None] * len(where)
        spans = [(p, i, min(i + _ROW, hi)) for p, lo, hi in zip(where, cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=True)
                 for i in range(lo, hi, _ROW)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(where + [p for p, _, _ in spans], pa.int64()), pa.array(mass + [0] * len(spans), pa.int64()),
             pa.array(none + [key[a:b].tobytes() for _, a, b in spans], pa.binary()),
             pa.array(none + [n[a:b].tobytes() for _, a, b in spans], pa.binary())],
            names=["part", "mass", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared()
        held, size = [], 0
        for batch in batches:
            for lang, texts in _by_lang(batch).items():
                seed = _seed(lang)
                for part in slices(texts, m - 1, _SLICE):
                    for start, key in _offered(part, seed, filters):
                        pass
                    held.append(key[start + m > part.carried])
                    size += len(held[-1])
                    if size >= _HELD:
                        yield from flush(held)
                        held, size = [], 0
        if size:
            yield from flush(held)
    return source.mapInArrow(run, "part long, mass long, keys binary, counts binary")


class Summary:
    """A mergeable Misra-Gries summary: keys and counters, what was taken off."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.new]])
        counts = np.concatenate([self.counts, *[c for _, c in self.new]])
        self.new, self.waiting = [], 0
        self.keys, back = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(back, counts, len(self.keys)).astype(np.int64)
        if len(self.keys) > self.capacity:
            over = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, over)[over])  # the first counter too many
            stay = self.counts > cut
            self.keys, self.counts, self.taken = self.keys[stay], self.counts[stay] - cut, self.taken + cut


def capacity(mass: int, floor: int, slack: int) -> int:
    """Counters of a summary: more than ``slack`` * mass / floor."""
    return slack * mass // floor + 1


def survivors(source: DataFrame, m: int, floor: int, slack: int, shared, mass: int) -> DataFrame:
    """(key): hashes of the phrases of m words that may reach the floor."""
    spark = source.sparkSession
    partitions = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass // PARTITION_MASS)), PARTITIONS)
    parts = _sent(source, m, shared, partitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass_, summary = None, 0, None

        def done():
            if summary is not None:
                summary.settle()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(summary.keys[summary.counts + summary.taken >= floor].view(np.int64))], names=["key"])
        for batch in batches:
            for p, n, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != part:
                    yield from done()
                    part, mass_, summary = p, 0, None
                if keys is None:
                    mass_ += n
                else:
                    summary = summary or Summary(capacity(mass_, floor, slack))
                    summary.merge(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64))
        yield from done()
    dealt = parts.repartition(partitions, "part").sortWithinPartitions("part", F.col("keys").isNotNull())
    return staged(dealt.mapInArrow(run, "key long"))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5, floor: int = 100,
                  slack: int = 4) -> DataFrame:
    """(lang, phrase, words, f): the phrases of 1 to ``longest`` words with at
    least ``floor`` occurrences, phrase as binary; the row without a phrase has
    all words of the language."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(quoted(lang).cast("string").alias("lang"), quoted(text).cast("binary").alias("body"))
    mass = docs.select(F.sum(F.octet_length(quoted(text)))).first()[0] or 0  # words are fewer than bytes
    filters: list[Filter] = []
    for m in range(1, longest + 1):
        found = survivors(source, m, floor, slack, share(spark, filters), mass // 2 + 1)
        filters.append(build_filter(spark, found))
    shared = share(spark, filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, numbers = shared(), Numbers()
        for batch in batches:
            for lang_, texts in _by_lang(batch).items():
                seed = _seed(lang_)
                for part in slices(texts, longest - 1, _COUNTED):
                    if len(numbers) > _WORDS:
                        numbers = Numbers()
                    tokens = part.data.split()
                    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
                    out: list[bytes] = [b""]
                    size, freq = [0], [len(tokens) - part.carried]
                    exact = ids
                    for m, (start, _) in enumerate(islice(_offered(part, seed, filters), longest), 1):
                        if m > 1:  # equal phrases of this slice by their words' numbers, not by hash
                            pair = exact[start] * np.int64(len(numbers)) + ids[start + (m - 1)]
                            exact = np.zeros(len(ids), np.int64)
                            exact[start] = np.unique(pair, return_inverse=True)[1]
                        start = start[start + m > part.carried]
                        _, first, n = np.unique(exact[start], return_index=True, return_counts=True)
                        out += [b" ".join(tokens[i:i + m]) for i in start[first].tolist()]
                        size += [m] * len(first)
                        freq += n.tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang_] * len(out)), pa.array(out, pa.binary()), pa.array(size, pa.int32()),
                         pa.array(freq, pa.int64())], names=["lang", "phrase", "words", "f"])
    counted = source.mapInArrow(run, "lang string, phrase binary, words int, f long")
    return (counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
            .where((F.col("f") >= floor) | (F.col("words") == 0)))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 5, floor: int = 100,
                 top: int = 2000, slack: int = 4) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    of 2 to ``longest`` words by floor(1000 * a * n / (l * r)) of their worst
    cut. A phrase goes if a longer one around it is as frequent; the next
    longer ones tell, since frequency never grows with length."""
    table = staged(phrase_counts(docs, text, lang, longest, floor, slack))
    known = table.where("words > 0").select("lang", "phrase", "words", "f")
    total = table.where("words = 0").select("lang", F.col("f").alias("n"))
    split = F.split(F.col("phrase").cast("string"), " ", -1)
    join = lambda words: F.array_join(words, " ").cast("binary")
    longer = known.where("words > 2").select("lang", "f", "words", split.alias("w"))
    around = longer.select("lang", "f", F.explode(F.array(
        join(F.slice("w", F.lit(1), F.col("words") - 1)), join(F.slice("w", F.lit(2), F.col("words") - 1)))).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    own = known.where("words > 1").join(around, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("around") < F.col("f"), F.lit(True)))
    cuts = (own.select("lang", "phrase", F.col("f").alias("a"), "words", split.alias("w"))
            .select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", join(F.slice("w", F.lit(1), F.col("k"))).alias("head"),
                    join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest")))
    part = lambda side, name: known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).join(total, "lang")
    # decimals of 38 digits: a * n and l * r below 10 ** 35 are exact
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("up", (whole("a") * whole("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")) \
               .withColumn("down", (whole("l") * whole("r")).cast("decimal(38,0)")) \
               .withColumn("score", F.expr("up div down"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select(
        "lang", "phrase", "a", "n", "x.score", "x.l", "x.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of many parts of a language first, so no task ranks a whole language
    best = best.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(1024)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(
        F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
                       "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
