"""Session helpers: settings, table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should carry. Skewed joins are split at run time and
# every broadcast is decided by Spark from the measured size of the side.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"
SPREAD_CONF = "spark.millrace.spread.tasks"
LOCAL_SCRATCH_CONF = "spark.millrace.local.scratch"
ARROW_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WIDE_ROWS = 512  # rows of an Arrow batch whose cells are whole texts or blocks of keys


def local_session(
    cpus: int | str = "*", app: str = "millrace", memory: str = "8g", conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config(SPREAD_CONF, partitions)
    )
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows by key over as many tasks as the caller has asked for in SPREAD_CONF; unset, the table passes as it is read.

    For tables that lie in one file of one row group, as test tables do, while their rows cost much work.
    """
    tasks = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(tasks), key) if tasks else df


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def wide_rows(spark: SparkSession) -> str:
    """The session's rows of an Arrow batch, or WIDE_ROWS if that is fewer: a task holds a batch in the executor and in its worker."""
    rows = int(spark.conf.get(ARROW_ROWS_CONF))
    return str(min(rows, WIDE_ROWS) if rows > 0 else WIDE_ROWS)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    root = spark.conf.get(LOCAL_SCRATCH_CONF, None)
    if root is None:
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set(LOCAL_SCRATCH_CONF, root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later uses see the same rows even when executors are lost, which a
    recomputed plan with sampled or run-time column values cannot promise.
    Shuffle files of the write go when it is done: what reads the table needs them
    no more, and else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with setting(spark, CLEANUP_CONF, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
