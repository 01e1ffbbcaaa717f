"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words: after lower-casing A-Z, the runs of characters other than the ASCII
characters that are neither digit nor letter. A window is ``window``
consecutive words of a benchmark item; an item of fewer words, but not none,
is one window. A document word inside any occurrence of a window is hit.

The symbols of the search are words. Windows are grouped by length m (the full
length, and one group for each length of short items), so short strings don't
shorten the shifts of long ones. In a group the block is the last two words
(one, if m = 1): the shift table says how far the text may be moved for a
block, m - 1 for a block in no window; at shift 0 the suffix bucket of the
block lists windows, which are compared word by word.

The benchmark is the query set: it is cut into pieces (overlapping by
window - 1 words) and dealt into blocks of at most ``block_bytes``, whose
search tables are broadcast one block at a time; the size is checked before.
The documents are never shuffled unless there is more than one block (then
each block's hits are written to the shared folder and met by row).

Defined cases: a null text has no words, and no word is hit; an item without
words has no window; an item with a null id hits words but is not counted or
listed; rows that repeat an item id are one item; repeated documents get a row
each; empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, fresh, map_texts, quoted, staged

WINDOW = 13
#: Most bytes of benchmark words in one broadcast block.
BLOCK_BYTES = 8 << 20
_PIECE_WORDS, _LONG_WORD = 4096, 256
_LETTERS = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; characters beyond ASCII are word characters."""
    return text.translate(_TABLE).split() if text else []


def symbols_of(text: bytes | None) -> list[bytes]:
    """The words as the search compares them: one of more than ``_LONG_WORD``
    bytes is its SHA-256 digits behind a byte that no word has, so a piece of
    the benchmark has a bounded size whatever its words."""
    words = words_of(text)
    if words and max(map(len, words)) > _LONG_WORD:
        return [w if len(w) <= _LONG_WORD else b"\x00" + hashlib.sha256(w).hexdigest().encode() for w in words]
    return words


class WuManber:
    """Search tables for windows (tuples of words), grouped by length."""

    def __init__(self, windows: dict[tuple, dict]):
        self.groups = []
        by_len: dict[int, list[tuple]] = {}
        for w in windows:
            by_len.setdefault(len(w), []).append(w)
        for m, group in sorted(by_len.items()):
            b = min(2, m)
            shift: dict = {}
            bucket: dict = {}
            for w in group:
                for end in range(b, m + 1):
                    block = w[end - b:end] if b == 2 else w[0]
                    shift[block] = min(shift.get(block, m), m - end)
                bucket.setdefault(w[m - b:] if b == 2 else w[0], []).append(w)
            self.groups.append((m, b, m - b + 1, shift, bucket))
        self.windows = windows

    def search(self, words: list[bytes]):
        """(start, window) of every occurrence."""
        n = len(words)
        for m, b, far, shift, bucket in self.groups:
            get, end = shift.get, m
            if b == 1:
                for i, w in enumerate(words):
                    if w in bucket:
                        yield i, bucket[w][0]
                continue
            while end <= n:
                step = get((words[end - 2], words[end - 1]), far)
                if step:
                    end += step
                    continue
                for w in bucket[(words[end - 2], words[end - 1])]:
                    if words[end - m:end] == list(w):
                        yield end - m, w
                end += 1


def _covered(hits: list[tuple[int, int]], n: int) -> int:
    """Words inside the union of (start, end) spans."""
    total, right = 0, 0
    for a, b in sorted(hits):
        a = max(a, right)
        if b > a:
            total += b - a
            right = b
    return total


def _pieces(bench: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, piece): items of many words in overlapping pieces, none lost."""
    def make():
        def kernel(texts):
            out = []
            for t in texts:
                w = symbols_of(t)
                step = _PIECE_WORDS
                out.append([b" ".join(w[i:i + step + window - 1]) for i in range(0, max(1, len(w) - window + 1), step)]
                           if w else [])
            return [pa.array(out, pa.list_(pa.binary()))]
        return kernel
    cut = map_texts(bench, text, [item_id], [field("pieces", "array<binary>")], make)
    return cut.select(cut[cut.columns[0]].cast("string").alias("item"), F.explode("pieces").alias("piece"))


def _blocks(bench: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list[DataFrame]:
    """The distinct pieces, staged, in blocks of at most ``block_bytes``: by
    hash buckets, doubled until the largest block fits. Repeated rows count
    once, or no number of buckets would part them."""
    pieces = staged(_pieces(bench, item_id, text, window).distinct())
    size = F.length("piece") + 64
    total = pieces.agg(F.sum(size)).first()[0] or 0
    k = max(1, -(-total // block_bytes))
    widest = pieces.agg(F.max(size)).first()[0] or 0
    if widest > block_bytes:
        raise ValueError("a benchmark piece is larger than a block")
    while k > 1:
        block = F.pmod(F.xxhash64("item", "piece"), F.lit(k))
        most = pieces.groupBy(block.alias("b")).agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]
        if most <= block_bytes:
            return [pieces.where(block == i) for i in range(k)]
        k *= 2
    return [pieces]


def _tables(rows, window: int) -> WuManber:
    windows: dict[tuple, dict] = {}
    for item, piece in rows:
        w = bytes(piece).split(b" ")
        for i in range(max(1, len(w) - window + 1)):
            owners = windows.setdefault(tuple(w[i:i + window]), {})
            if item is not None:
                owners[item] = None
    return WuManber(windows)


def _scan(docs: DataFrame, key: str, text: str, rows: list, window: int) -> DataFrame:
    """(key, n_words, spans, items) of each row for one block of windows."""
    shared = docs.sparkSession.sparkContext.broadcast([(r[0], bytes(r[1])) for r in rows])

    def make():
        search = _tables(shared.value, window)

        def kernel(texts):
            n_words, spans, items = [], [], []
            for t in texts:
                words = symbols_of(t)
                ends: dict[int, int] = {}
                found: set = set()
                for at, w in search.search(words):
                    ends[at] = max(ends.get(at, 0), at + len(w))
                    found.add(w)
                n_words.append(len(words))
                merged: list[int] = []
                for a, b in sorted(ends.items()):
                    if merged and a <= merged[-1]:
                        merged[-1] = max(merged[-1], b)
                    else:
                        merged += [a, b]
                spans.append(merged)
                items.append(sorted({i for w in found for i in search.windows[w]}))
            return [n_words, spans, items]
        return kernel
    return map_texts(docs, text, [key], [field("n_words", "long"), field("spans", "array<int>"),
                                         field("items", "array<string>")], make).toDF("key", "n_words", "spans", "items")


def _hits(docs: DataFrame, bench: DataFrame, doc_key: str, text: str, item_id: str, item_text: str,
          window: int, block_bytes: int) -> DataFrame:
    blocks = _blocks(bench, item_id, item_text, window, block_bytes)
    if len(blocks) == 1:
        return _scan(docs, doc_key, text, blocks[0].collect(), window)  # within block_bytes
    row = fresh(docs, "row")
    whole = staged(docs.select(F.monotonically_increasing_id().alias(row), quoted(doc_key).alias("key"),
                               quoted(text).alias("body")))
    parts = [staged(_scan(whole, row, "body", b.collect(), window)) for b in blocks]
    met = parts[0]
    for p in parts[1:]:
        met = met.unionByName(p)
    met = met.groupBy(F.col("key").alias(row)).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return whole.select(row, "key").join(met, row).drop(row)


def contamination(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row;
    contaminated: some word is hit and share * n_hit >= n_words."""
    met = _hits(docs, bench, doc_id, text, item_id, item_text, window, block_bytes)
    # union of the spans: sort them, then each adds what lies right of all before
    pairs = F.expr("""array_sort(transform(sequence(1, cast(size(spans) / 2 as int)),
                      i -> struct(spans[2 * i - 2] as a, spans[2 * i - 1] as b)))""")
    n_hit = F.expr("""aggregate(pairs, struct(0L as n, 0 as r),
        (s, x) -> struct(s.n + greatest(0, x.b - greatest(s.r, x.a)) as n, greatest(s.r, x.b) as r), s -> s.n)""")
    out = met.withColumn("pairs", F.when(F.size("spans") > 0, pairs)).withColumn(
        "n_hit", F.coalesce(n_hit, F.lit(0)).cast("long"))
    return out.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def items_digest(items):
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def keep_clean(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, share: int = 20,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all columns."""
    blocks = _blocks(bench, item_id, item_text, window, block_bytes)
    body = fresh(docs, "body")
    if len(blocks) > 1:
        row = fresh(docs, "row")
        whole = staged(docs.withColumn(row, F.monotonically_increasing_id()))
        found = contamination(whole, bench, row, text, item_id, item_text, window, share, block_bytes)
        return whole.join(found.where("contaminated").select(F.col("doc_id").alias(row)), row, "left_anti").drop(row)
    shared = docs.sparkSession.sparkContext.broadcast([(r[0], bytes(r[1])) for r in blocks[0].collect()])
    flag = fresh(docs, "contaminated")

    def make():
        search = _tables(shared.value, window)

        def kernel(texts):
            out = []
            for t in texts:
                words = symbols_of(t)
                hit = _covered([(at, at + len(w)) for at, w in search.search(words)], len(words))
                out.append(hit > 0 and share * hit >= len(words))
            return [out]
        return kernel
    flagged = map_texts(docs.withColumn(body, quoted(text)), body, docs.columns, [field(flag, "boolean")], make)
    return flagged.where(~F.col(flag)).drop(flag)


def digest(items: list[str]) -> str:
    """The items' digest as the query returns it (used by tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


__all__ = ["WINDOW", "WuManber", "contamination", "digest", "items_digest", "keep_clean", "words_of"]
