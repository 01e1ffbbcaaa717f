"""Table state without a transactional table format.

A table is a folder of numbered versions ``v000001``, ``v000002``, … under a
root in the shared folder. A job reads version *n*, computes version *n+1*
as a DataFrame (a next-state function, see ``transitions``), and
``replace`` writes it to a work folder of its own and renames that to the next
version, so a failed or lost job leaves the old version in place, and what it
left behind is in nobody's way (the atomicity the reference gets from
rollback). A job claims its version number by creating a file that must not
exist, so two jobs never rename to one number. The previous version stays on
disk: it is the "hist" snapshot of SNK-5. ``retain`` removes older versions,
work folders and staged copies.

Append-only tables (run log, alert changes, ingested rows) are a folder of
parts, one per append. Each distinct schema is kept once beside the parts, so
an append or a read opens no earlier part, and a column that a later append
brings is there, null in earlier rows. ``compact`` makes one part of many.

Row counts (AG-7) and emptiness (SNK-6, SNK-7) are observed while the rows are
written, in the writing stage, not read back.

Rows to be written may be given as a list of frames: they are written one after
another and become one version, part or staged copy when all are there. The
exchanges of a write are deleted as soon as it ends, so a job in pieces keeps
the exchanges of one piece on disk, not of all (else they stay until the driver
happens to collect its garbage).
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import hashlib
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import ts_literal
from quayside.session import work_dir

LOAD_BATCH_ROWS = 50_000  # fixed value: rows per insert batch / output file (SNK-17)

# Schemas of the versions this process wrote: reading them back needs no
# schema-inference job.
_WRITTEN: dict[str, T.StructType] = {}

_FREE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Rows = DataFrame | Sequence[DataFrame]  # a list: its frames' rows together


def _frames(rows: Rows) -> list[DataFrame]:
    return [rows] if isinstance(rows, DataFrame) else list(rows)


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or work_dir(spark, "tables")).rstrip("/")

    # -- file system helpers (Hadoop FS, so any shared store works) ----------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _numbers(self, name: str) -> list[int]:
        """Numbers of all version folders, finished or not."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def versions(self, name: str) -> list[int]:
        return [v for v in self._numbers(name) if self._exists(f"{self.path(name, v)}/_SUCCESS")]

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:06d}"

    # -- reads ---------------------------------------------------------------
    def _read_path(self, path: str) -> DataFrame:
        schema = _WRITTEN.get(path)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        out = reader.parquet(path)
        out._store_files = path  # marks a plain read of written files (see stage)
        return out

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        vs = self.versions(name)
        if not vs:
            return None
        v = vs[-1] if version is None else version
        return self._read_path(self.path(name, v))

    def current(self, name: str) -> DataFrame | None:
        return self.read(name)

    def previous(self, name: str) -> DataFrame | None:
        """SNK-5: the version before the current one ("hist")."""
        vs = self.versions(name)
        return self.read(name, vs[-2]) if len(vs) >= 2 else None

    # -- writes --------------------------------------------------------------
    def replace(self, name: str, df: Rows, max_records_per_file: int | None = None) -> DataFrame:
        """SNK-1/SNK-3/SNK-4: write ``df`` as the next version and return it
        read back (its lineage is cut: later steps read the files)."""
        work, rows = self._write(name, df, max_records_per_file)
        return self._commit(name, work, _frames(df)[0].schema, rows)

    def _write(self, name: str, df: Rows, max_records_per_file: int | None = None) -> tuple[str, int]:
        work = f"{self.root}/{name}/_work/{uuid.uuid4().hex[:12]}"
        return work, self._counted(df, work, max_records_per_file)

    def _counted(self, df: Rows, folder: str, max_records_per_file: int | None = None) -> int:
        """Write ``df`` to a new folder; the rows it had."""
        rows = 0
        for k, frame in enumerate(_frames(df)):
            seen = Observation()
            w = frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append" if k else "errorifexists").option("compression", "zstd")
            if max_records_per_file:
                w = w.option("maxRecordsPerFile", max_records_per_file)
            with self._exchanges_freed():
                w.parquet(folder)
            rows += seen.get.get("rows") or 0
        return rows

    @contextlib.contextmanager
    def _exchanges_freed(self) -> Iterator[None]:
        """What ends in here deletes its shuffle files at its end."""
        was = self.spark.conf.get(_FREE_EXCHANGES, None)
        self.spark.conf.set(_FREE_EXCHANGES, "true")
        try:
            yield
        finally:
            if was is None:
                self.spark.conf.unset(_FREE_EXCHANGES)
            else:
                self.spark.conf.set(_FREE_EXCHANGES, was)

    def _commit(self, name: str, work: str, schema: T.StructType, rows: int | None = None) -> DataFrame:
        """Make a written work folder the next version."""
        fs, src = self._fs(work)
        number = max([0, *self._numbers(name)]) + 1  # unfinished folders count too
        while not self._claimed(name, number):
            number += 1
        target = self.path(name, number)
        if not fs.rename(src, self._fs(target)[1]):
            raise RuntimeError(f"{work} could not become {target}")
        _WRITTEN[target] = schema
        out = self._read_path(target)
        out._store_rows = rows
        out.createOrReplaceTempView(name)
        return out

    def _claimed(self, name: str, number: int) -> bool:
        """Take a version number; false if another job has taken it."""
        fs, p = self._fs(f"{self.root}/{name}/_claims/{number:06d}")
        try:
            return fs.createNewFile(p) and not self._exists(self.path(name, number))
        except Exception as e:  # noqa: BLE001 - some stores raise where others return false
            if fs.exists(p):
                return False
            raise e

    @staticmethod
    def rows_of(table: DataFrame) -> int:
        """AG-7: the row count of a table just written, as seen while writing."""
        known = getattr(table, "_store_rows", None)
        return table.count() if known is None else known

    def retain(self, name: str, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions (2: current and hist), and
        the work and staging folders of the table. For a time when no job runs
        on it."""
        for v in self.versions(name)[:-keep]:
            fs, p = self._fs(self.path(name, v))
            fs.delete(p, True)
        for part in ("_work", "_staging"):
            fs, p = self._fs(f"{self.root}/{name}/{part}")
            fs.delete(p, True)

    def stage(self, name: str, df: Rows) -> DataFrame:
        """Write ``df`` once to a staging folder of the table and return it read
        back: the lineage is cut, so later checks and transitions read files
        instead of recomputing the input (and a lost executor only costs a
        re-read). A frame that already is a plain read of this store's files
        is returned as it is: writing it again would only copy the files."""
        if getattr(df, "_store_files", None):
            return df
        target = f"{self.root}/{name}/_staging/{uuid.uuid4().hex[:12]}"
        rows = self._counted(df, target)
        _WRITTEN[target] = _frames(df)[0].schema
        out = self._read_path(target)
        out._store_rows = rows
        return out

    def replace_unless_empty(self, name: str, df: DataFrame) -> DataFrame | None:
        """SNK-7: an empty result leaves the current version alone."""
        work, rows = self._write(name, df)
        if not rows:
            fs, p = self._fs(work)
            fs.delete(p, True)
            return None
        return self._commit(name, work, df.schema, rows)

    def append(self, name: str, df: Rows, only_if_rows: bool = False) -> DataFrame:
        """SNK-6 / SNK-19 / SET-2: append rows to an append-only table. Several
        frames are written to a work folder, which becomes the part."""
        frames = _frames(df)
        part = f"{self.root}/{name}/append/part={uuid.uuid4().hex[:12]}"
        folder, rows = self._write(name, frames) if len(frames) > 1 else (part, self._counted(frames, part))
        fs, p = self._fs(folder)
        if only_if_rows and not rows:
            fs.delete(p, True)
            if not self._schemas(name):
                return frames[0].limit(0)
        else:
            if folder != part:
                fs.mkdirs(self._fs(part)[1].getParent())
                if not fs.rename(p, self._fs(part)[1]):
                    raise RuntimeError(f"{folder} could not become {part}")
            self._note_schema(name, frames[0].schema)
        out = self.read_appended(name)
        out.createOrReplaceTempView(name)
        return out

    def _note_schema(self, name: str, schema: T.StructType) -> None:
        text = schema.json()
        fs, p = self._fs(f"{self.root}/{name}/_schemas/{hashlib.sha256(text.encode()).hexdigest()[:16]}")
        if not fs.exists(p):
            stream = fs.create(p, True)  # equal schemas write equal files
            stream.write(bytearray(text.encode()))
            stream.close()

    def _schemas(self, name: str) -> list[T.StructType]:
        """The schemas of the parts, oldest first."""
        fs, p = self._fs(f"{self.root}/{name}/_schemas")
        if not fs.exists(p):
            return []
        io = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        out = []
        for st in sorted(fs.listStatus(p), key=lambda st: (st.getModificationTime(), st.getPath().getName())):
            stream = fs.open(st.getPath())
            out.append(T._parse_datatype_json_string(io.toString(stream, "UTF-8")))
            stream.close()
        return out

    def read_appended(self, name: str) -> DataFrame:
        """All rows of an append-only table, with every append's columns."""
        folder = f"{self.root}/{name}/append"
        fields: dict[str, T.StructField] = {}
        for schema in self._schemas(name):
            for f in schema.fields:
                have = fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
                if have.dataType != f.dataType:
                    raise ValueError(f"{name}.{f.name} was appended as {have.dataType} and {f.dataType}")
        # the folders' names are no columns, whatever the rows' columns are called
        return self.spark.read.schema(T.StructType(list(fields.values()))).option("recursiveFileLookup", "true").parquet(folder)

    def compact(self, name: str) -> DataFrame:
        """Make one part of an append-only table's parts. For a time when no job
        runs on it, like ``retain``."""
        fs, folder = self._fs(f"{self.root}/{name}/append")
        old = [st.getPath() for st in fs.listStatus(folder)]
        merged = f"{self.root}/{name}/_work/{uuid.uuid4().hex[:12]}"
        self.read_appended(name).write.parquet(merged)
        fs.rename(self._fs(merged)[1], self._fs(f"{self.root}/{name}/append/part={uuid.uuid4().hex[:12]}")[1])
        for p in old:
            fs.delete(p, True)
        return self.read_appended(name)

    # -- run log (SNK-15) ----------------------------------------------------
    RUN_LOG_SCHEMA = T.StructType([
        T.StructField("job", T.StringType()), T.StructField("target", T.StringType()),
        T.StructField("file_name", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()), T.StructField("logged_at", T.TimestampNTZType())])

    def log_run(self, job: str, target: str, status: str, rows: int | None,
                logged_at: _dt.datetime, file_name: str | None = None) -> DataFrame:
        row = self.spark.createDataFrame(
            [(job, target, file_name, status, rows, logged_at)], self.RUN_LOG_SCHEMA)
        return self.append("run_log", row)


def run_log_rows(counts: DataFrame, job: str, logged_at: _dt.datetime,
                 status: str = "Success") -> DataFrame:
    """SNK-15 as a DataFrame: one log row per ``(target, rows)`` input row."""
    return counts.select(
        F.lit(job).alias("job"), F.col("target"), F.lit(None).cast("string").alias("file_name"),
        F.lit(status).alias("status"), F.col("rows").cast("long").alias("rows"),
        ts_literal(logged_at).alias("logged_at"))
