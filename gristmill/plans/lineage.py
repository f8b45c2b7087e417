"""Cutting lineage and sizing broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Spark 4.1 and later: a query that ends drops its shuffle files. Earlier ones ignore it and wait for the garbage collector.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders written inside the innermost open ``scratch``, for each open one.
_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; one of our own only in local mode.

    Executors on other machines would not see a folder that the driver makes for itself.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="gristmill-")
        spark.conf.set(CHECKPOINT_CONF, named)
    return named.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs start from the files, so losing an executor costs no recomputation, and
    the scan gives the planner real sizes and column pruning. What was shuffled for them is
    deleted at once: nothing reads it again.
    """
    path = transient(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the block delete their shuffle files as they end."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before) if before is not None else spark.conf.unset(CLEANUP_CONF)


def transient(spark: SparkSession) -> str:
    """The name of a folder to write to, deleted with what is settled in the innermost open ``scratch``."""
    path = f"{shared_dir(spark)}/gristmill-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def without_summary(spark: SparkSession, model):
    """A fitted MLlib model, saved and read back.

    What a fit returns keeps its training summary and with that the session. Tasks get the whole model, and a session with
    job tags or observations can't be sent.
    """
    path = f"{shared_dir(spark)}/gristmill-{uuid.uuid4().hex}"
    try:
        model.write().save(path)
        return type(model).load(path)
    finally:
        remove(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside the block when it ends; results must be written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def small_side(df: DataFrame, max_rows: int = 10_000, max_bytes: int = 32 << 20) -> DataFrame:
    """``df`` as a join side: broadcast when it is measured to be small, else left alone.

    The measurement fetches at most ``max_rows + 1`` rows. Beyond either limit the plan keeps
    the ordinary shuffled join, which adaptive execution sizes and splits.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, df.schema))


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with at least one partition per core, for work that is heavy per row.

    Does nothing where the files already give enough splits, as any large table does; only
    a small table in one file, which a single task would read, is dealt out.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
