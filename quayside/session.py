"""Session construction and the shared working folder.

Every job takes a ``SparkSession``; this module only builds one for tests,
benchmarks and the command line, and resolves the folder where state
versions, landing zones and stream checkpoints live.

The working folder is always derived from ``spark.checkpoint.dir`` (the
shared folder a cluster names for checkpoints). A private folder under the
system temp directory is created only when the setting is absent *and* the
session runs in local mode, i.e. in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A compiled method of more than 8,000 bytes stays interpreted on the JVM: let
    # wide projections be compiled in pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Option lists and JSON text must keep null fields (SNK-18).
    "spark.sql.jsonGenerator.ignoreNullFields": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quayside", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf of an already running session
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` / the context's checkpoint dir. Only
    a local-mode session without one gets a private folder (tests).
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster run needs a shared folder")
        root = tempfile.mkdtemp(prefix="quayside-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = checkpoint_root(spark) + "/quayside"
    if unique:
        base += "/" + uuid.uuid4().hex[:12]
    path = "/".join([base, *parts])
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if path.startswith("file:") or (path.startswith("/") and default.startswith("file:")):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path
