"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Static settings have to be on the builder; changing them later is an error.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# HotSpot does not compile methods beyond this size. A wide decode exceeds it as
# one generated method; as separate projections, which are split, it is compiled.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name="cambist", master=None, shuffle_partitions=None, extra=None) -> SparkSession:
    """A session with this library's settings.

    ``shuffle_partitions`` is an upper bound: adaptive execution merges small
    partitions, so on a cluster set it for the largest shuffle (total shuffle
    bytes / 128 MB), not for the typical one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SESSION_CONF, **RUNTIME_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """What this library relies on, in a session someone else built: days are UTC days."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. A machine-local
    folder is used only where all tasks run on this machine.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        return tempfile.mkdtemp(prefix=f"cambist-{label}-")
    return f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"
