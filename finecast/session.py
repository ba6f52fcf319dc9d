"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Shuffled bytes that one task of a job on very many keys should hold, and into how many pieces the usual tasks are cut.
TASK_BYTES, TASK_PIECES = 8 << 20, 8


def local_session(app: str = "finecast", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benches; on a cluster use the one you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables multiply in later joins; keep all cores busy.  On a
        # cluster leave partition coalescing on.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites are taken for every Column otherwise, a third of the time to state a long plan.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    may fall back to a folder of its own; elsewhere a missing setting is an
    error, since a machine-local folder would be invisible to other hosts.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where one intermediate feeds several actions or an iterative job:
    the copy survives executor loss and keeps the plan short.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bounded_tasks(spark: SparkSession, scans: bool = False) -> Iterator[None]:
    """Inside, shuffles are cut into more pieces, and these are merged up to ``TASK_BYTES`` only.

    For a job run at once whose aggregate keeps about one entry per row: keys
    shrink so well in a shuffle that tasks of the usual bytes hold many
    millions.  ``scans`` bounds the pieces of files too, for partial aggregates
    right over a scan.  The session's own settings hold again afterwards.
    """
    parts, merged, read = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (parts, merged, read)}
    spark.conf.set(parts, str(TASK_PIECES * int(before[parts])))
    spark.conf.set(merged, str(TASK_BYTES))
    if scans:
        spark.conf.set(read, str(TASK_BYTES))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
