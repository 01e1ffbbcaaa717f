"""Structured Streaming ingest of posted bodies (STR-1, STR-2).

A post is one file in a landing folder: a JSON array of objects, as it was
posted (SRC-6). The file source hands each body over whole, with the path of
its file as the post's id; ``posexplode`` gives every object its position. Tags
(WN-1, WN-2) are per post: two posts in one micro-batch don't see each other,
and the key of the output is (post, pos). Rows without a document or id go to
``<output>_quarantine`` as they came; nothing is dropped.

Each micro-batch is written to ``<output>/run=<id>/epoch=<n>`` with overwrite: a
replayed epoch rewrites its folder, so the sink is idempotent. The run id is
that of the stream's checkpoint, so a new checkpoint on an old output never
overwrites rows of an earlier one. ``max_files`` bounds a micro-batch.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.plans import jobs

#: Posts of one micro-batch at most.
MAX_FILES = 10_000

BatchStamp = Callable[[int], _dt.datetime]


def _stamp(batch_ts: _dt.datetime | BatchStamp) -> BatchStamp:
    return batch_ts if callable(batch_ts) else (lambda _epoch: batch_ts)


def posts(spark: SparkSession, landing: str, max_files: int = MAX_FILES) -> DataFrame:
    """A stream of (post, pos, raw): the objects of each posted array as JSON
    text. A body that is no array of objects is one row with a null position."""
    body = (spark.readStream.format("text").option("wholetext", "true")
            .option("maxFilesPerTrigger", max_files).load(landing)
            .select(F.col("_metadata.file_path").alias("post"), F.col("value").alias("body")))
    return split_bodies(body)


def split_bodies(bodies: DataFrame) -> DataFrame:
    """(post, body) -> (post, pos, raw); ``raw`` keeps each object's own keys."""
    parsed = F.from_json("body", "array<variant>")
    return bodies.select("post", F.posexplode_outer(F.coalesce(parsed, F.array().cast("array<variant>"))).alias("pos", "item"),
                         "body").select("post", F.col("pos").cast("long").alias("pos"),
                                        F.coalesce(F.to_json("item"), F.col("body")).alias("raw"))


def _run(spark: SparkSession, stream: DataFrame, tag, output: str, checkpoint: str, available_now: bool,
         processing_time: str | None) -> StreamingQuery:
    def handle(batch: DataFrame, epoch: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for the rows and for the quarantine
        try:
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"
            tagged, quarantine = tag(batch, epoch)
            tagged.write.mode("overwrite").parquet(f"{output}/run={run}/epoch={epoch}")
            quarantine.write.mode("overwrite").parquet(f"{output}_quarantine/run={run}/epoch={epoch}")
        finally:
            batch.unpersist()
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def invoice_stream(spark: SparkSession, landing: str, output: str, checkpoint: str,
                   batch_ts: _dt.datetime | BatchStamp, available_now: bool = True,
                   processing_time: str | None = None, max_files: int = MAX_FILES) -> StreamingQuery:
    """STR-1 + SNK-19: invoice posts → tagged rows appended per epoch."""
    stamp = _stamp(batch_ts)
    return _run(spark, posts(spark, landing, max_files),
                lambda batch, epoch: jobs.tag_posted_invoices(batch, stamp(epoch)),
                output, checkpoint, available_now, processing_time)


def syslog_stream(spark: SparkSession, landing: str, output: str, checkpoint: str,
                  batch_ts: _dt.datetime | BatchStamp, available_now: bool = True,
                  processing_time: str | None = None, max_files: int = MAX_FILES) -> StreamingQuery:
    """STR-2 + SNK-19: log posts → tagged rows; objects without any id are quarantined."""
    stamp = _stamp(batch_ts)
    return _run(spark, posts(spark, landing, max_files),
                lambda batch, epoch: jobs.tag_syslog_lines(batch, stamp(epoch), batch_col="post"),
                output, checkpoint, available_now, processing_time)


def read_output(spark: SparkSession, output: str) -> DataFrame:
    """All epochs written so far. The run and epoch folders are no columns, so
    columns of those names in the rows stay."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(output)
