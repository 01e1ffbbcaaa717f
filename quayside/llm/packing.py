"""Best-fit packing with conflicts.

Documents are cut into pieces of at most ``capacity`` words (+1 for the
separator that follows a document); pieces that fill a bin are bins of their
own, the others are packed by best fit, largest first. Open bins are kept
ordered by residual; each carries a bitmap of the sources and one of the
duplicate clusters it holds. The search starts at the smallest residual that
fits (the successor of the size) and goes on to the next larger one until a bin
is found that has neither the piece's source nor its cluster: the tightest
compatible bin. Without one, a bin is opened.

Packing runs on shards of about ``shard`` pieces, dealt by a hash of the row and
the piece, so a hot source or a large group of copies is spread evenly and no
task gets an unbounded group; a bin never spans shards. What is shuffled is
(id, piece, size, source, cluster), never texts.

Clusters are the components of near duplicates (see simhash): a text's
fingerprint is taken while its words are counted, and finds its component's
smallest fingerprint by a join; a text without words has no cluster.

Defined cases: a null source or cluster conflicts with nothing; a null or empty
text is one piece of size 1; a null id is packed like any other; repeated rows
are pieces of their own; an empty table gives no bins. Very long texts become
full bins and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, map_texts, small_batches, staged
from .simhash import components, fingerprint, trie_links

CAPACITY, SHARD = 2048, 2048
SHINGLE, MAX_BITS = 3, 2  # as in the near-duplicate query


def pack(pieces: list[tuple[int, object, object]], capacity: int) -> list[int]:
    """Bin number of each (size, source, cluster), best fit decreasing."""
    order = sorted(range(len(pieces)), key=lambda i: -pieces[i][0])
    bit: dict = {}
    out = [-1] * len(pieces)
    bins: list[tuple[int, int]] = []  # (residual, bin), ordered
    sources: list[int] = []  # bitmaps, by bin
    clusters: list[int] = []
    for i in order:
        size, source, cluster = pieces[i]
        s = 0 if source is None else 1 << bit.setdefault(("s", source), len(bit))
        c = 0 if cluster is None else 1 << bit.setdefault(("c", cluster), len(bit))
        k = bisect_left(bins, (size, -1))
        while k < len(bins) and (sources[bins[k][1]] & s or clusters[bins[k][1]] & c):
            k += 1
        if k < len(bins):
            left, b = bins.pop(k)
        else:
            left, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= s
        clusters[b] |= c
        out[i] = b
        if left > size:
            insort(bins, (left - size, b))
    return out


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, cluster): words and one separator; the cluster is
    the smallest fingerprint of the text's near duplicates."""
    def make():
        def kernel(texts):
            size, cluster = [], []
            for t in texts:
                words = len((t or b"").split())
                size.append(words + 1)
                fp = fingerprint(t, SHINGLE)
                cluster.append((fp - (1 << 64) if fp >> 63 else fp) if words else None)
            return [size, cluster]
        return kernel
    rows = staged(map_texts(docs, text, [doc_id, source], [field("words", "long"), field("same", "long")], make).toDF(
        "doc_id", "source", "size", "fp"))
    roots = components(trie_links(rows.where("fp is not null").select("fp").distinct(), MAX_BITS))
    # a fingerprint that isn't in a component, or is its smallest, has no row in roots
    return rows.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left").select(
        "doc_id", "source", "size", F.coalesce("v", "fp").alias("cluster"))


def packed(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """items (doc_id, source, size, cluster) -> (doc_id, source, piece, n_pieces,
    start, size, bin_id, full): ``start`` is the piece's first word."""
    items = staged(items.withColumn("row", F.monotonically_increasing_id()))  # read three times below
    small_batches(items.sparkSession, 10_000)
    full = F.expr(f"cast((size - 1) div {capacity} as int)")
    cut = items.withColumn("pieces", full + 1).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "cluster", "row",
        F.col("pieces").alias("n_pieces"), "size",
        F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"))
    cut = cut.select("doc_id", "source", "cluster", "row", "piece", "n_pieces",
                     (F.col("piece").cast("long") * capacity).alias("start"),
                     F.least(F.col("size") - F.col("piece").cast("long") * capacity, F.lit(capacity).cast("long")).alias("size"))
    n = items.count()
    shards = max(1, -(-n // shard))
    dealt = cut.withColumn("shard", F.expr(f"cast(pmod(xxhash64(row, piece), {shards}) as int)"))
    whole = dealt.where(F.col("size") == capacity)
    rest = dealt.where(F.col("size") < capacity)
    schema = ("doc_id long, source string, piece int, n_pieces int, start long, size long, bin_id string, full boolean")

    def shard_bins(t: pa.Table) -> pa.Table:
        order = [("size", "descending"), ("row", "ascending"), ("piece", "ascending")]
        t = t.sort_by(order)
        rows = list(zip(t["size"].to_pylist(), t["source"].to_pylist(), t["cluster"].to_pylist(), strict=True))
        bins = pack(rows, capacity)
        no = t["shard"].to_pylist()
        return pa.table({
            "doc_id": t["doc_id"], "source": t["source"], "piece": t["piece"], "n_pieces": t["n_pieces"],
            "start": t["start"], "size": t["size"],
            "bin_id": pa.array([f"s{s}-{b}" for s, b in zip(no, bins, strict=True)], pa.string()),
            "full": pa.array([False] * len(rows), pa.bool_())})
    mixed = rest.groupBy("shard").applyInArrow(shard_bins, schema)
    # a full piece is its bin: the row and the piece name it
    own = whole.select("doc_id", "source", "piece", "n_pieces", "start", "size",
                       F.format_string("f%d-%d", "row", "piece").alias("bin_id"),
                       F.lit(True).alias("full"))
    return mixed.unionByName(own)


def best_fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Pack the documents of a table (see the module)."""
    return packed(sized(docs, doc_id, text, source), capacity, shard)


__all__ = ["best_fit", "pack", "packed", "sized"]
