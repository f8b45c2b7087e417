"""What several operators share: tables, column expressions and worker-side text helpers."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Task functions are shipped whole, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The folds of a document are crc32 of its id as text, modulo 3; fold 1 is held out.
FOLDS, HELD_OUT = 3, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """True where a document belongs to the fold no model may learn from; false for a null id."""
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def ship(module: str) -> None:
    """Send the functions of ``module`` to tasks by value."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def with_row(df: DataFrame) -> DataFrame:
    """Add ``row``, a number unique to each row; write the result before using it twice."""
    return df.withColumn("row", F.monotonically_increasing_id())


def dealt(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt evenly over at least one partition per core, for heavy work on each row.

    Only an input of fewer partitions than cores is shuffled.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def join_sliced(rows: DataFrame, verdict: DataFrame, key: list[str], spread_by: str, slice_rows: int = 100_000) -> DataFrame:
    """Inner join of ``rows`` with ``verdict`` (one row per key) where a key may hold most rows.

    Rows are dealt into slices by a hash of ``spread_by``. The verdict meets each slice's
    distinct keys, so it is repeated once per slice at most, and a slice joins only its own
    rows. ``rows`` is read three times; hand in a table that is written.
    """
    slices = max(1, -(-rows.count() // slice_rows))
    placed = rows.withColumn("__slice", F.pmod(F.xxhash64(spread_by), F.lit(slices)))
    told = placed.select("__slice", *key).distinct().join(verdict, key)
    return placed.join(told, ["__slice", *key]).drop("__slice")
