"""Scoring texts as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from gristmill.functions import text as tx
from gristmill.operators.classifier import Scorer, score_texts
from gristmill.operators.clean import filter_texts


def read_texts(
    spark: SparkSession, path: str, id_col: str = "id", text_col: str = "text", fmt: str = "parquet",
    max_files: int = 1000, **options,
) -> DataFrame:
    """Stream of (id, text) from the files of a folder."""
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField(text_col, T.StringType())])
    return spark.readStream.schema(schema).format(fmt).options(**options) \
        .option("maxFilesPerTrigger", max_files).load(path) \
        .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def clean_and_score(
    texts: DataFrame, scorer: Scorer, terms=tx.BOILERPLATE_TERMS, min_text_len: int = 1,
    lowercase_text: bool = True,
) -> DataFrame:
    """The stateless part of cleaning, then scoring. The same code serves batch and stream."""
    kept = filter_texts(texts, terms, min_text_len)
    if lowercase_text:
        kept = kept.withColumn("text", F.lower("text"))
    return score_texts(kept, scorer)


def score_stream(
    texts: DataFrame, scorer: Scorer, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append scored texts to a parquet folder; files and checkpoint give exactly-once output."""
    writer = clean_and_score(texts, scorer).writeStream.format("parquet").outputMode("append") \
        .option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
