"""The corpus pipeline: language, lines, near copies, benchmark passages, mix.

Each stage works on all that the one before it kept. Its result is written under the shared folder and read
again, so a lost executor costs one stage at most. All stages but the last return the columns of
``documents``; the mix adds ``epoch`` and ``words``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gristmill.llm import decontaminate, language, line_dedup, mixing, simhash
from gristmill.llm.common import table
from gristmill.plans.lineage import remove, scratch, shared_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language; all stay where no document has a label to learn from."""
    return language.keep_known(docs)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that repeat a window of an earlier document, and documents left without lines."""
    return line_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group, that of the smallest id."""
    return simhash.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's budget of words, in epochs."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", known_language), ("line_dedup", unrepeated_lines), ("near_dedup", one_of_near_copies),
    ("decontaminate", without_benchmark), ("mix", mixed),
]
# The language stage learns a model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, in order."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{base}/{name}"
        with scratch(spark):  # what a stage wrote for itself goes with its end
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
