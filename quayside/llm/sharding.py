"""Sharding by longest-processing-time scheduling (LPT).

Rows with equal texts form a group that stays together. Groups, sorted by
size, go one by one to the least-loaded shard, which a heap yields (ties: the
lowest shard). A row's size is the UTF-8 bytes of its text plus one.

Groups of one size are interchangeable, so the schedule runs over the
histogram (size, number of groups), greatest size first: all groups of a size
are dealt at once, to the same loads as one by one. k distinct sizes add up to
k * k / 2 bytes at least, so the histogram has at most sqrt(2 * total bytes)
rows (14 million for 100 TB); they stream through one task that keeps one load
a shard. Everything that is as long as the table stays distributed: groups are
ranked within their size by range partitions with offsets, and slots are
numbered the same way. No text is shuffled: groups are keyed by the SHA-256 of
the text; counts are added map side first, so a group of copies meets as one
row per task; the join that hands shards back to the rows may be split where
one group is hot.

Defined cases: a null text has size 1 and is in one group with empty texts;
null or repeated ids are kept, each row gets its own slot; an empty table gives
an empty result; other columns are ignored. Slots follow no order. A group
larger than the mean shard makes its shard larger than the others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, staged


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of one size each shard gets, one by one to
    the least-loaded shard; ``loads`` are brought up to date."""
    n = len(loads)
    got = [0] * n
    if count > 4 * n:
        # the first count - n steps at once: all values load + size * j below a
        # level are taken, the level is found by halving
        want = count - n
        low, high = min(loads), max(loads) + size * count
        while low < high:
            mid = (low + high + 1) // 2
            if sum(max(0, -(-(mid - x) // size)) for x in loads) <= want:
                low = mid
            else:
                high = mid - 1
        got = [max(0, -(-(low - x) // size)) for x in loads]
    heap = [(x + size * g, i) for i, (x, g) in enumerate(zip(loads, got, strict=True))]
    heapq.heapify(heap)
    for _ in range(count - sum(got)):
        load, i = heap[0]
        got[i] += 1
        heapq.heapreplace(heap, (load + size, i))
    for i, g in enumerate(got):
        loads[i] += size * g
    return got


def _schedule(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [0] * shards
        for batch in batches:
            upto = [np.cumsum(deal(loads, size, n)).tolist()
                    for size, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(upto, pa.list_(pa.int64()))],
                                             names=["of_size", "upto"])
    return run


def numbered(df: DataFrame, group: str, out: str) -> DataFrame:
    """``df`` with ``out``: a number from 0 for the rows of each group, without
    gaps, in the order of partitions and rows. Each task counts its own rows;
    the tasks' counts (one row per task and group) become offsets. The rows are
    written once in between, so both steps see the same partitions. ``group``
    is a column of whole numbers."""
    at = df.columns.index(group)
    schema = T.StructType([*df.schema.fields, T.StructField("in_task", T.LongType()), T.StructField("task", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        task = TaskContext.get().partitionId()
        for batch in batches:
            key, back = np.unique(batch.column(at).to_numpy(zero_copy_only=False), return_inverse=True)
            order = np.argsort(back, kind="stable")
            sizes = np.bincount(back, minlength=len(key))
            local = np.empty(len(back), np.int64)
            local[order] = np.arange(len(back)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            local += np.array([seen.get(k, 0) for k in key.tolist()], np.int64)[back]
            for k, n in zip(key.tolist(), sizes.tolist(), strict=True):
                seen[k] = seen.get(k, 0) + n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(local), pa.array(np.full(len(back), task, np.int32))], names=schema.names)

    done = staged(df.mapInArrow(run, schema))
    counts = done.groupBy(quoted(group).alias("of_group"), F.col("task").alias("of_task")).agg(
        F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("of_group").orderBy("of_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("of_group", "of_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return (done.join(offsets, (quoted(group) == F.col("of_group")) & (F.col("task") == F.col("of_task")))
            .select(*[quoted(c) for c in df.columns], (F.col("first") + F.col("in_task")).alias(out)))


def by_bytes(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per input row: sizes of
    the shards near equal, equal texts in one shard, slots from 0 in each."""
    body = F.coalesce(quoted(text).cast("string"), F.lit("")).cast("binary")
    rows = staged(docs.select(
        quoted(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("copies")))
    groups = rows.groupBy("copies").agg(F.sum("size").alias("of_size"))
    ranged = groups.repartitionByRange("of_size", "copies")
    ranked = staged(numbered(ranged, "of_size", "rank"))
    sizes = ranked.groupBy("of_size").agg(F.count(F.lit(1)).alias("n"))
    plan = (sizes.repartition(1).sortWithinPartitions(F.desc("of_size"))
            .mapInArrow(_schedule(shards), "of_size long, upto array<long>"))
    placed = ranked.join(staged(plan), "of_size").select(
        "copies", F.size(F.filter("upto", lambda x: x <= F.col("rank"))).cast("int").alias("shard"))
    return numbered(rows.join(placed, "copies").drop("copies"), "shard", "slot")
