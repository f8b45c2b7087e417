"""Looking at a table before trusting it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gristmill.plans.lineage import small_side


def class_counts(df: DataFrame, by: str = "label") -> DataFrame:
    """Rows and share of rows per class."""
    counts = df.groupBy(by).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("percentage", F.col("rows") * F.lit(100.0) / total)


def top_texts(df: DataFrame, k: int = 20, by: str | None = None) -> DataFrame:
    """The most frequent texts with their share of all rows, overall or per class.

    Texts are counted by digest, so the shuffle moves 32 bytes for each distinct text of
    a map task instead of the text. The winners, at most k per class, fetch their text by
    the id of their first row. Equal counts rank by that id.
    """
    group = [by] if by else []
    digest = F.unhex(F.sha2(F.col("text"), 256)).alias("digest")
    counted = df.filter(F.col("text").isNotNull()).select("id", *group, digest).groupBy(*group, "digest").agg(
        F.count("*").alias("rows"), F.min("id").alias("id"))
    if by:
        totals = small_side(df.groupBy(by).agg(F.count("*").alias("total")))
        rank = F.row_number().over(
            Window.partitionBy(by).orderBy(F.desc("rows"), F.asc("id")))
        top = counted.withColumn("rank", rank).filter(F.col("rank") <= k).join(totals, by)
    else:
        total = df.agg(F.count("*")).scalar()
        top = counted.orderBy(F.desc("rows"), F.asc("id")).limit(k).withColumn("total", total)
    top = top.select(*group, "id", "rows",
                     (F.col("rows") * F.lit(100.0) / F.col("total")).alias("percentage"))
    return df.select("id", "text").join(small_side(top), "id").select(
        *group, F.col("id").alias("first_id"), "text", "rows", "percentage")


def length_histogram(df: DataFrame, by: str = "label", bins: int = 10) -> DataFrame:
    """Equal-width bins of text length between the least and greatest length of each class.

    The texts are read once: lengths are counted first, and bounds and bins come from
    that small table.
    """
    lengths = df.groupBy(by, F.length("text").alias("chars")).agg(F.count("*").alias("rows"))
    bounds = Window.partitionBy(by)
    low, high = F.min("chars").over(bounds), F.max("chars").over(bounds)
    spread = lengths.select(by, "chars", "rows", low.alias("low"), high.alias("high"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    position = F.floor((F.col("chars") - F.col("low")) / width).cast("int")
    bin_no = F.when(F.col("high") == F.col("low"), 0).otherwise(F.least(position, F.lit(bins - 1)))
    return spread.withColumn("bin", bin_no).groupBy(by, "bin").agg(
        F.sum("rows").alias("rows"),
        F.min("chars").alias("shortest"), F.max("chars").alias("longest"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls. One pass over the table."""
    facts = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.count("*").alias("rows"), F.count_if(F.col(f.name).isNull()).alias("nulls"))
        for f in df.schema.fields
    ])
    return df.agg(facts.alias("facts")).select(F.inline("facts"))


def first_rows(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    return df.orderBy(F.asc(order)).limit(n)


def last_rows(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def head_and_tail(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    """First and last rows, marked by ``part``."""
    parts = [first_rows(df, n, order).withColumn("part", F.lit("head")),
             last_rows(df, n, order).withColumn("part", F.lit("tail"))]
    return reduce(DataFrame.unionByName, parts)
