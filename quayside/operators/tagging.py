"""Duplicate tagging.

Semantics, in batch order: the first row of a document gets ``Dup_Value = 1``;
every later repeat gets ``1 +`` the running count of *all* repeats seen so
far in the batch, itself included (the counter is shared by all documents).
Documents A,B,A,B,C,A → 1,1,2,3,1,4.

With a batch column (one posted body is one batch, bounded by its size) the
tags are windows over the batch: one exchange on the batch column.

Without one, the whole frame is the batch and nothing runs in one task:

* "is this row a repeat" = ``pos > min(pos)`` of its document: a partial/final
  aggregate joined back on the document. AQE splits a hot document; the other
  side has one row per document.
* the running count is a two-pass prefix sum over ranges of ``pos`` that hold
  about equally many rows (``equi_depth_cuts``). Repeats before a range = rows
  before it minus documents that begin before it, so the totals need only the
  positions and the minima: the wide rows are joined once and shuffled once to
  their range.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import UNIQUE_STAMP_FORMAT, ts_literal
from quayside.functions.util import col_of, quote
from quayside.functions.values import json_has_key


#: Cells of the position histogram per range that is asked for.
CELLS_PER_RANGE = 8


def _cell(pos, starts: list[int]):
    """Number of the last of the ascending ``starts`` that is not above ``pos``:
    halving over a literal array, inside the JVM."""
    bits = max(1, (len(starts) - 1).bit_length())
    padded = [*starts, *[None] * ((1 << bits) - len(starts))]
    cuts = F.from_json(F.lit(json.dumps(padded)), "array<bigint>")  # folded to one literal
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step) <= pos, at + step).otherwise(at))


def equi_depth_cuts(df: DataFrame, pos, n: int) -> list[int]:
    """Where to cut the positions into about ``n`` ranges of nearly equal row
    counts: the first position of each range, ascending.

    An exact histogram over equal cells; a cell with more than half of a
    range's mean is cut into finer cells and counted again, until none is too
    full or it is one position wide (positions are unique, so that is one row).
    Neighbouring cells then join to ranges: none exceeds 1.5 times the mean.
    However the positions lie, the driver holds ``CELLS_PER_RANGE * n`` counts
    a round, and a round reads the position column only."""
    pos = col_of(pos).cast("long")
    lo, hi, rows = df.agg(F.min(pos), F.max(pos), F.count(pos)).first()
    if not rows:
        return []
    most = max(1, rows // (2 * n))
    cells: list[tuple[int, int]] = []
    todo = [(lo, hi - lo + 1, rows)]
    while todo:
        starts = [a for a, _, _ in todo]
        pieces = max(2, -(-CELLS_PER_RANGE * n // len(todo)))
        widths = [max(1, -(-w // pieces)) for _, w, _ in todo]
        i = _cell(pos, starts)
        at = lambda values: F.get(F.from_json(F.lit(json.dumps(values)), "array<bigint>"), F.col("i"))
        inside = df.select(pos.alias("p"), i.alias("i")).where(
            (F.col("p") >= starts[0]) & (F.col("p") - at(starts) < at([w for _, w, _ in todo])))
        counted = inside.select("i", (F.col("p") - at(starts)).alias("d"),
                                at(widths).alias("w")).groupBy("i", F.expr("d div w").alias("k")).agg(F.count(F.lit(1)).alias("n"))
        found = [(starts[r["i"]] + r["k"] * widths[r["i"]], widths[r["i"]], r["n"]) for r in counted.collect()]
        cells += [(a, c) for a, w, c in found if c <= most or w == 1]
        todo = sorted((a, w, c) for a, w, c in found if c > most and w > 1)
    cuts, held, mean = [], 0, rows / n
    for start, count in sorted(cells):
        if not cuts or held + count / 2 > mean:
            cuts.append(start)
            held = 0
        held += count
    return cuts


def _per_batch(df: DataFrame, doc_txt: str, pos_col: str, batch_col: str, out: str) -> DataFrame:
    batch = quote(batch_col)
    flagged = df.withColumn("__rep", (col_of(pos_col) > F.min(col_of(pos_col)).over(
        Window.partitionBy(batch, doc_txt))).cast("int"))
    run = Window.partitionBy(batch).orderBy(col_of(pos_col)).rowsBetween(Window.unboundedPreceding, 0)
    tag = F.when(F.col("__rep") == 1, F.sum("__rep").over(run) + 1).otherwise(F.lit(1)).cast("long")
    # one exchange on the batch serves both windows
    return flagged.withColumn(out, tag).drop("__rep")


def dup_tags(df: DataFrame, doc_col: str, pos_col: str, batch_col: str | None = None,
             out: str = "Dup_Value", n_ranges: int | None = None) -> DataFrame:
    """WN-1: add ``out`` (long) to every row. Documents are compared as text
    (Q19); a null document is a document of its own. ``pos_col`` is an integer,
    unique within a batch, as array positions are; the span of all positions fits
    a long."""
    doc = "__doc"
    keyed = df.withColumn(doc, col_of(doc_col).cast("string"))
    if batch_col:
        return _per_batch(keyed.repartition(col_of(batch_col)), doc, pos_col, batch_col, out).drop(doc)
    pos = col_of(pos_col).cast("long")
    n = n_ranges or 4 * max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cuts = equi_depth_cuts(df, pos, n) or [0]

    firsts = keyed.groupBy(doc).agg(F.min(pos).alias("__first"))
    rows = df.select(_cell(pos, cuts).alias("__range")).groupBy("__range").agg(
        F.count(F.lit(1)).alias("__n"))
    begun = firsts.select(_cell(F.col("__first"), cuts).alias("__range")).groupBy("__range").agg((-F.count(F.lit(1))).alias("__n"))
    totals = rows.unionByName(begun).groupBy("__range").agg(F.sum("__n").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    offsets = F.broadcast(offsets)  # one row per range: n + 1 at most

    flagged = (keyed.join(firsts.withColumnRenamed(doc, "__fdoc"), F.col(doc).eqNullSafe(F.col("__fdoc")))
               .drop("__fdoc", doc)
               .withColumn("__rep", (pos > F.col("__first")).cast("int"))
               .withColumn("__range", _cell(pos, cuts)))
    local = Window.partitionBy("__range").orderBy(col_of(pos_col)).rowsBetween(Window.unboundedPreceding, 0)
    counted = flagged.withColumn("__local", F.sum("__rep").over(local)).join(offsets, "__range", "left")
    tag = F.when(F.col("__rep") == 1, F.col("__offset") + F.col("__local") + 1).otherwise(F.lit(1))
    return counted.withColumn(out, tag.cast("long")).drop("__rep", "__local", "__offset", "__first", "__range")


def unique_value(doc, batch_ts: _dt.datetime | str, dup="Dup_Value"):
    """WN-3: ``doc-ddMMHHmmss-dup`` with the batch timestamp as a parameter."""
    return F.concat_ws("-", col_of(doc).cast("string"),
                       F.date_format(ts_literal(batch_ts), UNIQUE_STAMP_FORMAT),
                       col_of(dup).cast("string"))


def syslog_id(raw, doc_field: str = "Sales_Document", fallback: str = "SAP_Shipment"):
    """WN-2 id: the document when its key is *present* in the raw JSON object,
    else the shipment field. A present-but-null document yields null, which the
    job routes to quarantine (Q19)."""
    present = json_has_key(raw, doc_field)
    return F.when(present, F.get_json_object(col_of(raw), f"$.{doc_field}")) \
            .otherwise(F.get_json_object(col_of(raw), f"$.{fallback}"))
