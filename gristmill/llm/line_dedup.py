"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines is hashed. Of each window that occurs more than once anywhere
in the table the first occurrence stays, by (id, text hash, position), and the lines that
any later occurrence covers are removed; overlapping occurrences merge.

Windows are counted in slices of documents first, so a passage that fills a third of the table
reaches its reducer as one row per slice; the decision goes back to the slices, and each
slice joins only its own windows.

A document of fewer than three lines has no window and stays whole. Null text counts as one
empty line. Windows of three empty lines are ignored. Rows equal in id and text are one document: each
keeps the same lines. A null id sorts first. All other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gristmill.plans.lineage import settle

LINES = 3
SLICE_ROWS = 100_000
ID, CHECK, GONE, STARTS = "__id", "__check", "__gone", "__starts"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(ID, F.col(id_col)).withColumn(CHECK, F.xxhash64(text))


def windows(keyed: DataFrame, text_col: str = "text") -> DataFrame:
    """id, check, pos and digest of every window that is not blank."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    starts = F.sequence(F.lit(0), F.size("lines") - LINES)

    def window(i: Column) -> Column:
        three = F.slice("lines", i + 1, LINES)
        return F.struct(i.alias("pos"), F.when(
            F.array_join(three, "") != "", F.unhex(F.md5(F.array_join(three, "\n")))).alias("digest"))

    return keyed.select(ID, CHECK, lines.alias("lines")).filter(F.size("lines") >= LINES) \
        .select(ID, CHECK, F.explode(F.transform(starts, window)).alias("w")) \
        .select(ID, CHECK, "w.pos", "w.digest").filter("digest IS NOT NULL")


def later_windows(keyed: DataFrame, text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """id, check and ``__starts``: where a document repeats a window that stands earlier."""
    found = settle(windows(keyed, text_col))
    slices = max(1, -(-found.count() // slice_rows))
    placed = found.withColumn("slice", F.pmod(F.xxhash64(ID), F.lit(slices)))
    at = F.struct(ID, CHECK, "pos")
    leaves = settle(placed.groupBy("slice", "digest").agg(F.min(at).alias("first"), F.count("*").alias("n")))
    repeated = leaves.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")) \
        .filter("n > 1").select("digest", "first")
    told = leaves.select("slice", "digest").join(repeated, "digest")
    return placed.join(told, ["slice", "digest"]).filter(~at.eqNullSafe(F.col("first"))) \
        .groupBy(ID, CHECK).agg(F.collect_set("pos").alias(STARTS))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``docs`` with ``__lines`` and ``__gone``: all lines and the sorted numbers of those to remove."""
    keyed = _keyed(docs, id_col, text_col)
    later = later_windows(keyed, text_col, slice_rows).withColumnsRenamed({ID: "__i", CHECK: "__c"})
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform(
        STARTS, lambda p: F.sequence(p, p + LINES - 1)))))
    none = F.array().cast("array<int>")
    return keyed.join(later, F.col(ID).eqNullSafe(F.col("__i")) & (F.col(CHECK) == F.col("__c")), "left") \
        .withColumn(GONE, F.coalesce(covered, none)) \
        .withColumn("__lines", F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")) \
        .drop("__i", "__c", STARTS, ID, CHECK)


def kept_lines() -> Column:
    """The lines that stay, of a marked document, in order."""
    numbers = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col(GONE))
    return F.transform(numbers, lambda i: F.get("__lines", i))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines, n_removed, n_spans (merged runs) and the digest of what stays."""
    starts_run = F.filter(GONE, lambda x, i: (i == 0) | (F.get(GONE, i - 1) != x - 1))
    return mark(docs, id_col, text_col).select(
        F.col(id_col), F.size("__lines").cast("long").alias("n_lines"),
        F.size(GONE).cast("long").alias("n_removed"), F.size(starts_run).cast("long").alias("n_spans"),
        F.sha2(F.array_join(kept_lines(), "\n"), 256).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines taken out; a document that loses all its lines goes.

    Documents without a repeated window come back untouched, null texts too.
    """
    marked = mark(docs, id_col, text_col)
    rest = F.when(F.size(GONE) == 0, F.col(text_col)).otherwise(F.array_join(kept_lines(), "\n"))
    return marked.filter(F.size(GONE) < F.size("__lines")).withColumn(text_col, rest) \
        .select(*docs.columns)
