"""Session helpers: building a session for local runs and cutting lineage.

Cluster jobs must get ``spark.checkpoint.dir`` from the cluster configuration
(a shared, fault-tolerant folder).  Only a local master falls back to a
private scratch folder, which is what the tests use.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortkit") -> SparkSession:
    """Session for tests and local benchmarks (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Order: the context's current folder, then ``spark.checkpoint.dir`` from the
    session.  Only when neither is set *and* the master is local, a scratch
    folder is created (tests, laptops).  On a cluster an unset folder is an
    error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


class _Scope(threading.local):
    """The tables to delete at the end of this thread's ``scratch_tables`` blocks, the innermost last."""

    def __init__(self):
        self.blocks: list[list[tuple[SparkSession, str]]] = []


_SCOPE = _Scope()


@contextmanager
def scratch_tables() -> Iterator[None]:
    """What ``cut_lineage`` writes in this block and thread is deleted at its
    end, but for tables written under ``outliving``, which belong to the block around it, if any.
    So a frame that leaves the block must be a scan of such a table."""
    _SCOPE.blocks.append([])
    try:
        yield
    finally:
        for spark, path in _SCOPE.blocks.pop():
            drop_path(spark, path)


@contextmanager
def outliving() -> Iterator[None]:
    """Tables written in this block outlive the ``scratch_tables`` around it."""
    block = _SCOPE.blocks.pop()
    try:
        yield
    finally:
        _SCOPE.blocks.append(block)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of this application's own scratch folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df``; the shuffle files behind it are deleted when it is written,
    not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    with _CLEANING:
        _CLEANING.enter(spark)
    try:
        out = df.write.mode("overwrite")
        (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    finally:
        with _CLEANING:
            _CLEANING.leave(spark)


class _Cleaning:
    """Spark's own cleaning of shuffle files is on while tables are written."""

    KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self):
        self.lock, self.writers, self.before = threading.Lock(), 0, "false"

    def __enter__(self):
        self.lock.acquire()

    def __exit__(self, *_):
        self.lock.release()

    def enter(self, spark: SparkSession) -> None:
        if not self.writers:
            self.before = spark.conf.get(self.KEY, "false")
            spark.conf.set(self.KEY, "true")
        self.writers += 1

    def leave(self, spark: SparkSession) -> None:
        self.writers -= 1
        if not self.writers:
            spark.conf.set(self.KEY, self.before)


_CLEANING = _Cleaning()


def cut_lineage(df: DataFrame, name: str = "cut", instead: DataFrame | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from a scan of it (never ``localCheckpoint``).

    One job writes the table; the plan above is replaced by a file scan, so
    plan depth stays bounded, a lost executor is recovered from the files
    rather than by replaying every upstream stage, and the scan carries
    file-size statistics the adaptive planner uses for join choices.
    ``instead``: an earlier result that only ``df`` was made from; its table is deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path)
    if _SCOPE.blocks:
        _SCOPE.blocks[-1].append((spark, path))
    if instead is not None:
        drop_path(spark, instead._scratch)
    out = spark.read.parquet(path)
    out._scratch = path
    return out
