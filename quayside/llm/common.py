"""Shared pieces of the operators: reading tables, staging, Arrow kernels."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import checkpoint_root

#: Most labels whose counts are broadcast.
MOST_LABELS = 10_000

#: Rows of one Arrow batch handed to a Python worker: bounds its memory.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small (a session setting; it changes
    no result)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def new_folder(spark: SparkSession) -> str:
    """A fresh path under the cluster's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{uuid.uuid4().hex[:16]}"


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the plan is cut
    there, and a lost executor costs no recomputation of what is behind it."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark compares without case)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def remainder(key: Column, mod: int) -> Column:
    """crc32 of the key's text, modulo ``mod`` (null counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


Kernel = Callable[[list], list]


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[T.StructField],
              make: Callable[[], Kernel], as_bytes: bool = True) -> DataFrame:
    """``keep`` columns of ``df`` plus the columns that a kernel computes from
    the text column, one Arrow batch at a time (no row of another batch is
    held). ``make`` runs once per task and returns the kernel; the kernel gets
    a list of texts (bytes or str, None for null) and returns one Arrow array
    or list per field."""
    small_batches(df.sparkSession)
    col = quoted(text).cast("string")
    src = df.select(*[quoted(c) for c in keep],
                    (col.cast("binary") if as_bytes else col).alias(fresh(df, "kernel_text")))
    schema = T.StructType([f for f in src.schema.fields[:-1]] + fields)
    names = schema.names
    types = [_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in batches:
            out = kernel(batch.column(batch.num_columns - 1).to_pylist())
            new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, names=names)

    return src.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind) if kind not in _SIMPLE else _SIMPLE[kind], True)


_SIMPLE = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
           "boolean": T.BooleanType(), "binary": T.BinaryType(), "float": T.FloatType(),
           "array<string>": T.ArrayType(T.StringType()), "array<int>": T.ArrayType(T.IntegerType()),
           "array<long>": T.ArrayType(T.LongType())}


def share(spark: SparkSession, model: object) -> Callable[[], object]:
    """Broadcast a fitted model, its class by value; the result unpacks it in a
    task. Only for models whose size has a bound that their module states."""
    import pickle

    from pyspark import cloudpickle
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    return lambda: pickle.loads(packed.value)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object kept for the life of one Python worker process (a cache)."""
    import sys
    import types
    home = sys.modules.setdefault("quayside_llm_worker_state", types.ModuleType("quayside_llm_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def labelled_sample(df: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """A bounded sample of labelled rows for fitting: of each label about
    ``per_label`` rows, all of them where there are fewer, chosen by a hash of
    the key (so the same rows every time). Only the pruned label column is read
    to count; the counts table has one row per label."""
    spread = 1 << 30
    known = df.where(quoted(label).isNotNull())
    value, rows = fresh(df, "sample_label"), fresh(df, "sample_rows")
    counts = known.groupBy(quoted(label).alias(value)).agg(F.count(F.lit(1)).alias(rows))
    few = counts.limit(MOST_LABELS + 1).collect()
    if len(few) <= MOST_LABELS:  # the checked bound of the broadcast; texts are not shuffled
        counts = F.broadcast(df.sparkSession.createDataFrame(few, counts.schema))
    u = F.pmod(F.xxhash64(quoted(key), F.lit("sample")), F.lit(spread))
    return (known.join(counts, quoted(label) == quoted(value))
            .where(u < F.lit(float(spread * per_label)) / quoted(rows))
            .drop(value, rows))
