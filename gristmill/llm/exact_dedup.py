"""Exact dedup by a tree of merged digest runs.

Documents are dealt into runs by a hash of their id. A run is a set of digests, each with its
keeper and its count. In every round ``fan_in`` neighbouring runs exchange their rows and merge
into one, digest by digest, until a single logical run is left. Runs are laid out by digest, so
even the last one is spread over all tasks. The decisions then travel back along the tree: the
root joins the leaves, where a digest has at most one row per run, and each leaf joins only the
documents of its own run. So a text that fills a third of the table never meets in one task.

Two texts count as equal when SHA-256, byte length and 64-bit XXHash all agree; the second
and third are the check that every merge repeats. Only SQL functions are used.

Null text counts as the empty text. Of rows with the same text and the same id, all have that
``keep_id``, and exactly one (they are interchangeable) has ``kept``. A null id sorts below all
others. Extra columns are ignored by ``decide`` and returned by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import ascii_lower, with_row
from gristmill.plans.lineage import settle

RUN_ROWS = 50_000
FAN_IN = 8
KEY = ("digest", "n_bytes", "check")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id, digest, n_bytes, check of every document's normalised text."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return with_row(docs.select(F.col(id_col).alias("id"), text.alias("text"))).select(
        "row", "id", F.sha2("text", 256).alias("digest"),
        F.octet_length("text").alias("n_bytes"), F.xxhash64("text").alias("check"))


def merge_round(runs: DataFrame, fan_in: int, keep: str) -> DataFrame:
    """Merge ``fan_in`` neighbouring runs into one, keeping the best (id, row) of each digest."""
    best = F.max("best") if keep == "last" else F.min("best")
    return runs.groupBy(F.floor(F.col("run") / fan_in).alias("run"), *KEY).agg(
        best.alias("best"), F.sum("n").alias("n"))


def decide(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "first",
    run_rows: int = RUN_ROWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: row, id, keep_id, group_size, kept, digest.

    ``keep`` is ``first`` (smallest id) or ``last`` (largest id).
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    if run_rows < 1 or fan_in < 2:
        raise ValueError("a run needs a row and a merge two runs")
    rows = settle(digests(docs, id_col, text_col))
    n_runs = max(1, -(-rows.count() // run_rows))
    placed = rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(n_runs)))
    best = F.struct("id", "row")
    leaves = settle(placed.groupBy("run", *KEY).agg(
        (F.max(best) if keep == "last" else F.min(best)).alias("best"), F.count("*").alias("n")))
    root, left = leaves, n_runs
    while left > 1:
        root = merge_round(root, fan_in, keep)
        left = -(-left // fan_in)
    verdict = root.select(*KEY, F.col("best").alias("final"), F.col("n").alias("total"))
    told = leaves.select("run", *KEY).join(verdict, list(KEY))
    return placed.join(told, ["run", *KEY]).select(
        "row", "id", F.col("final")["id"].alias("keep_id"), F.col("total").alias("group_size"),
        (F.col("row") == F.col("final")["row"]).alias("kept"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "first") -> DataFrame:
    """The documents that stay, with all their columns; ``id_col`` must be unique."""
    gone = decide(docs, id_col, text_col, keep).filter(~F.col("kept")).select(F.col("id").alias(id_col))
    return docs.join(gone, id_col, "left_anti")
