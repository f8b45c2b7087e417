"""Exact ranks over tables too large to sort in one task.

A rank inside a class is found without a window over the whole class: rows are counted
per bucket of the sort key, the bucket that holds the wanted rank is known from those
counts, and only that bucket is numbered. What comes back is the *key* standing at each
wanted rank, a table of a few rows, so the large table itself is only compared with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gristmill.plans.lineage import settle

BUCKET = "bucket"
# Range partitions; None leaves their number to the session.
BUCKETS: int | None = None
# Rows a bucket of digests should have; the number of such buckets grows with the table.
BUCKET_ROWS = 50_000


def hash_key(seed: int, id_col: str = "id") -> Column:
    """A seeded order that depends on the id alone, not on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def hash_bucket(key: Column, rows: int) -> Column:
    """Even buckets in key order, of about ``BUCKET_ROWS``: the first hex digits of a digest."""
    digits = 1
    while rows > BUCKET_ROWS * 16 ** digits and digits < 8:
        digits += 1
    return F.substring(key, 1, digits)


def in_ranges(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` written in range partitions of ``column``, with ``bucket``, the partition's number.

    Buckets ascend with ``column`` and rows equal in it share one, so fold rows first where values repeat. How many there are is the
    session's number of shuffle partitions; the driver picks that many bounds from a sample of fixed size
    a partition, however many rows there are. Only balance depends on the sample, never a result.
    """
    ranged = rows.repartitionByRange(column) if BUCKETS is None else rows.repartitionByRange(BUCKETS, column)
    return settle(ranged.withColumn(BUCKET, F.spark_partition_id()))


def keys_at_ranks(rows: DataFrame, wanted: DataFrame, stratum: str, order: list[str]) -> DataFrame:
    """The sort key that stands at each wanted rank of a stratum.

    ``rows`` has the stratum, ``bucket`` and the order columns; ``wanted`` has the
    stratum, ``cut`` and ``rank`` (from 1). Returns stratum, cut and the key struct.
    """
    counts = rows.groupBy(stratum, BUCKET).agg(F.count("*").alias("n"))
    below = F.coalesce(
        F.sum("n").over(Window.partitionBy(stratum).orderBy(BUCKET)
                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = counts.withColumn("below", below)
    hits = spans.join(F.broadcast(wanted), stratum) \
        .filter((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("n"))) \
        .select(stratum, BUCKET, "cut", (F.col("rank") - F.col("below")).alias("within"))
    # No more hits than wanted ranks.
    number = F.row_number().over(Window.partitionBy(stratum, BUCKET, "cut").orderBy(*order))
    return rows.join(F.broadcast(hits), [stratum, BUCKET]) \
        .withColumn("number", number) \
        .filter(F.col("number") == F.col("within")) \
        .select(stratum, "cut", F.struct(*order).alias("key"))


def with_running_count(per_value: DataFrame, column: str, measure: str) -> DataFrame:
    """Add ``upto``: the sum of ``measure`` over all values up to and including a row's own.

    ``per_value`` has one row per distinct value and its ``bucket``. The window stays inside
    a bucket; buckets are summed apart and joined back as offsets.
    """
    offsets = per_value.groupBy(BUCKET).agg(F.sum(measure).alias("own")).select(
        BUCKET,
        (F.sum("own").over(Window.partitionBy(F.lit(0)).orderBy(BUCKET)) - F.col("own")).alias("offset"))
    inside = F.sum(measure).over(Window.partitionBy(BUCKET).orderBy(column))
    return per_value.withColumn("upto", inside).join(F.broadcast(offsets), BUCKET) \
        .withColumn("upto", F.col("upto") + F.col("offset")).drop("offset")


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, ``median``. Equal values are folded before they are ranked."""
    values = df.select(column).filter(F.col(column).isNotNull())
    per_value = in_ranges(values.groupBy(column).agg(F.count("*").alias("n")), column)
    ranked = with_running_count(per_value, column, "n")
    total = per_value.agg(F.sum("n")).scalar()
    lower = F.min(F.when(F.col("upto") >= F.floor((total + 1) / 2), F.col(column)))
    upper = F.min(F.when(F.col("upto") >= F.floor(total / 2) + 1, F.col(column)))
    return ranked.agg(((lower + upper) / 2.0).alias("median"))


def keys_at_tied_ranks(rows: DataFrame, wanted: DataFrame, stratum: str, value: str) -> DataFrame:
    """As ``keys_at_ranks`` for the order (``value``, id), where many rows may share a value.

    The value at a rank comes from counts per distinct value. Only then are the rows that
    have just that value ranked, by id, in even buckets of ids.
    """
    folded = in_ranges(rows.groupBy(stratum, value).agg(F.count("*").alias("n")), value)
    offsets = folded.groupBy(stratum, BUCKET).agg(F.sum("n").alias("own")).select(
        stratum, BUCKET,
        (F.sum("own").over(Window.partitionBy(stratum).orderBy(BUCKET)) - F.col("own")).alias("offset"))
    inside = F.sum("n").over(Window.partitionBy(stratum, BUCKET).orderBy(value))
    below = F.col("offset") + F.col("upto") - F.col("n")
    hits = folded.withColumn("upto", inside).join(offsets, [stratum, BUCKET]) \
        .withColumn("below", below).join(F.broadcast(wanted), stratum) \
        .filter((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("n"))) \
        .select(stratum, "cut", F.col(value).alias("at"), (F.col("rank") - F.col("below")).alias("rank"))
    # As many rows as were asked for.
    hits = rows.sparkSession.createDataFrame(hits.toArrow(), hits.schema)
    step = F.concat_ws(":", F.col(stratum).cast("string"), F.col("cut").cast("string"))
    tied = rows.join(F.broadcast(hits), stratum).filter(F.col(value) == F.col("at")).select(
        step.alias("step"), "id")
    keys = keys_at_ranks(in_ranges(tied, "id"),
                         hits.select(step.alias("step"), "cut", "rank"), "step", ["id"])
    return hits.select(step.alias("step"), stratum, "at").join(F.broadcast(keys), "step").select(
        stratum, "cut", F.struct(F.col("at").alias(value), F.col("key")["id"].alias("id")).alias("key"))
