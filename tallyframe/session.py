"""Session helpers: runtime settings, lineage cuts and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; all are runtime SQL settings.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # long texts: what a Python worker gets at a time is bounded by bytes, not by rows alone
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}
# Shuffled bytes that adaptive execution puts into one task, unless the session says otherwise. Spark's own 64 MB
# are compressed: a task that sorts both sides of a join holds several hundred MB of them.
ADVISORY, TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", {"67108864b": "16m"}
# Partitions of a shuffle before adaptive execution merges small ones, and the bytes of input files there is one for.
# Merging never splits: with a fixed number, partitions, and the memory of the tasks that sort them, grow with the input.
INITIAL, INPUT_BYTES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 4 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (idempotent)."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(ADVISORY, TASK_BYTES.get(spark.conf.get(ADVISORY), spark.conf.get(ADVISORY)))
    return spark


def deal_by_input(spark: SparkSession, paths: Iterable[str]) -> SparkSession:
    """Give shuffles as many partitions as the files of a job call for; a larger number of the session stays."""
    context, size = spark.sparkContext, 0
    for path in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        size += where.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    wanted = -(-size // INPUT_BYTES)
    if wanted > first_partitions(spark):
        spark.conf.set(INITIAL, str(wanted))
    return spark


def first_partitions(spark: SparkSession) -> int:
    """Partitions a shuffle starts with, before small ones are merged."""
    return int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (a test) gets a temporary
    folder; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root
    current = context.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so that later steps never recompute it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def by_merge(df: DataFrame) -> DataFrame:
    """``df``, to be joined by sorting and merging, not by broadcast.

    Spark estimates a table by the files it comes from. Rows exploded into keys, or files that compress
    well, are many times as large, and a broadcast of them stands in the driver and in every executor.
    """
    return df.hint("merge")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for a written table, below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
