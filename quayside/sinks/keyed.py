"""Tables that are changed by key in place (SNK-10 to SNK-14 as writes).

A table is a folder partitioned on a hash of its key columns. An update reads
and rewrites only the partitions that hold changed keys: the next rows of those
partitions are staged first (a failed plan changes nothing), then put in their
place by Spark's dynamic partition overwrite. All other files stay as they are,
names included.

The staged folder is noted in ``_pending`` before the overwrite and the note is
removed after it. A job that is lost in between is finished by the next one that
opens the table: writing the staged partitions again gives the same files'
rows. None of these transitions removes rows, so a partition never becomes
empty. One writer per table, as in the reference.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.util import col_of
from quayside.session import checkpoint_root, work_dir

BUCKET = "__bucket"


def with_ids(rows: DataFrame, first: int, order_by: Sequence[str], id_col: str = "ID") -> DataFrame:
    """``rows`` with consecutive ids from ``first``, in the order of ``order_by``
    (ties in no set order). Range partitions count their own rows; one offset a
    partition makes the ids consecutive, so no task sees all rows."""
    number = F.monotonically_increasing_id()  # partition << 33 | row
    cut = rows.repartitionByRange(*[col_of(c) for c in order_by]).sortWithinPartitions(*[col_of(c) for c in order_by])
    checkpoint_root(rows.sparkSession)
    marked = cut.withColumn("__at", number).checkpoint()  # both uses below must see the same partitions
    task = F.shiftrightunsigned("__at", 33)
    counts = marked.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = F.col("__at").bitwiseAND((1 << 33) - 1)
    return (marked.withColumn("__task", task).join(offsets, "__task")
            .withColumn(id_col, F.lit(first).cast("long") + F.col("__before") + local)
            .drop("__task", "__at", "__before"))


class KeyedTable:
    """A table partitioned on the hash of ``keys``."""

    def __init__(self, spark: SparkSession, path: str | None, keys: Sequence[str], buckets: int = 64):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.path = (path or work_dir(spark, "keyed")).rstrip("/")
        #: Change rows that the last ``change`` or ``insert`` took.
        self.taken = 0
        self._finish()

    # -- folders -------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    def _finish(self) -> None:
        """Complete an overwrite that a lost job left behind."""
        fs, note = self._fs(f"{self.path}/_pending")
        if fs.exists(note):
            if fs.exists(self._fs(f"{self.path}/_pending/_SUCCESS")[1]):  # else the overwrite had not begun
                self._put(self.spark.read.text(f"{self.path}/_pending").first()[0])
            fs.delete(note, True)

    def _bucket(self):
        return F.pmod(F.xxhash64(*[col_of(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _put(self, staged: str) -> None:
        rows = self.spark.read.parquet(staged)
        (rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self._rows))

    # -- rows ----------------------------------------------------------------
    def create(self, df: DataFrame) -> DataFrame:
        """Write the table anew."""
        df.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._rows)
        return self.read()

    def read(self) -> DataFrame:
        return self._all().drop(BUCKET)

    def _all(self) -> DataFrame:
        return self.spark.read.parquet(self._rows)

    def change(self, changes: DataFrame, transition: Callable[[DataFrame, DataFrame], DataFrame],
               change_keys: Sequence[str] | None = None) -> DataFrame:
        """Apply ``transition(old rows, changes)`` to the partitions that hold a
        key of ``changes`` (named ``change_keys`` there) and put their next rows
        in place. At most one number a partition reaches the driver."""
        schema = self._all().schema
        cast = {f.name: f.dataType for f in schema.fields}
        keyed = [col_of(c).cast(cast[k]).cast("string") for k, c in zip(self.keys, change_keys or self.keys, strict=True)]
        number = F.pmod(F.xxhash64(*keyed), F.lit(self.buckets)).cast("int")
        touched = [r[0] for r in changes.select(number.alias(BUCKET)).distinct().collect()]
        if not touched:
            self.taken = 0
            return self.read()
        old = self._all().where(F.col(BUCKET).isin(touched)).drop(BUCKET)  # prunes to those partitions
        staged, seen = f"{self.path}/_staging/{uuid.uuid4().hex[:12]}", Observation()
        watched = changes.observe(seen, F.count(F.lit(1)).alias("rows"))
        transition(old, watched).withColumn(BUCKET, self._bucket()).write.parquet(staged)
        self.spark.createDataFrame([(staged,)], "value string").coalesce(1).write.text(f"{self.path}/_pending")
        self._put(staged)
        for done in ("_pending", "_staging"):
            fs, p = self._fs(f"{self.path}/{done}")
            fs.delete(p, True)
        self.taken = seen.get.get("rows") or 0
        return self.read()

    def insert(self, rows: DataFrame) -> DataFrame:
        """Append rows: files are added, none is rewritten."""
        seen = Observation()
        (rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").partitionBy(BUCKET).parquet(self._rows))
        self.taken = seen.get.get("rows") or 0
        return self.read()

    def highest(self, col: str) -> int:
        """The greatest value of a whole-number column (0 for none)."""
        return self._all().agg(F.max(col_of(col))).first()[0] or 0
