"""The tables the registered queries start from, as DataFrames and as SQL fragments.

All of them cover their source tables whole. `reviews` adds to the labelled documents the
blanks, boilerplate and repeated values that raw review forms contain; `vectors` adds to
the embeddings exact and close copies; `noisy` labels them with known errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gristmill.plans.lineage import spread


TURNS = 1 << 24  # more than any conversation has


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, id and text, dealt out for work on every token."""
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"))


def corpus(spark: SparkSession, sf_dir: str, per_token: bool = False) -> DataFrame:
    """Labelled documents: id, text, label; dealt out where work on every token follows."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    if per_token:
        documents = spread(documents)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col("quality").alias("label"))


CORPUS = """corpus AS (
  SELECT d.doc_id AS id, d.text AS text, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide reviews (id, negative, positive) with the defects of a raw form."""
    i, text, good = F.col("id"), F.col("text"), F.col("label") == 1
    negative = (
        F.when(~good & (i % 9 == 3), "Great stay")
        .when(~good, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(i % 4 == 0, "No Negative").when(i % 4 == 1, " NOTHING ").when(i % 4 == 2, ""))
    positive = (
        F.when(good & (i % 9 == 0), "Great Stay").when(good & (i % 9 == 1), "great stay ")
        .when(good & (i % 9 == 2), "The Location").when(good, text).when(i % 2 == 0, "No Positive"))
    return corpus(spark, sf_dir).select("id", negative.alias("negative"), positive.alias("positive"))


REVIEWS = CORPUS + """,
reviews AS (
  SELECT id,
    CASE WHEN label = 0 AND id % 9 = 3 THEN 'Great stay'
         WHEN label = 0 THEN concat('  ', text, ' ')
         WHEN id % 4 = 0 THEN 'No Negative'
         WHEN id % 4 = 1 THEN ' NOTHING '
         WHEN id % 4 = 2 THEN '' END AS negative,
    CASE WHEN label = 1 AND id % 9 = 0 THEN 'Great Stay'
         WHEN label = 1 AND id % 9 = 1 THEN 'great stay '
         WHEN label = 1 AND id % 9 = 2 THEN 'The Location'
         WHEN label = 1 THEN text
         WHEN id % 2 = 0 THEN 'No Positive' END AS positive
  FROM corpus)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, plus exact copies of some and slightly moved copies of others."""
    base = table(spark, sf_dir, "embeddings").select((F.col("vec_id") * 3).alias("id"), "embedding")
    exact = base.filter(F.col("id") % 30 == 0).select((F.col("id") + 1).alias("id"), "embedding")
    moved = base.filter(F.col("id") % 30 == 3).select(
        (F.col("id") + 2).alias("id"),
        F.transform("embedding", lambda x, i: F.when(i == 0, x + F.lit(0.3).cast("float")).otherwise(x)
                    .cast("float")).alias("embedding"))
    return base.unionByName(exact).unionByName(moved)


VECTORS = """vectors AS (
  SELECT 3 * vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings
  UNION ALL
  SELECT 3 * vec_id + 1, CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL
  SELECT 3 * vec_id + 2, CAST(list_concat(
      [CAST(embedding[1] + CAST(0.3 AS FLOAT) AS FLOAT)], embedding[2:]) AS DOUBLE[])
  FROM embeddings WHERE vec_id % 10 = 1)"""


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with a label that follows the first component, wrong for every 17th id."""
    side = (F.element_at("embedding", 1) > 0).cast("int")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding",
        F.when(F.col("vec_id") % 17 == 0, 1 - side).otherwise(side).alias("label"))


NOISY = """noisy AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding,
    CASE WHEN vec_id % 17 = 0 THEN 1 - CAST(embedding[1] > 0 AS INTEGER)
         ELSE CAST(embedding[1] > 0 AS INTEGER) END AS label
  FROM embeddings)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score by formula: ties, and exact 0.5 values."""
    return corpus(spark, sf_dir).select(
        "id", "label", ((F.col("id") * 37 % 101).cast("double") / 100.0).alias("p_pos"))


SCORED = CORPUS + """,
scored AS (
  SELECT id, label, CAST(id * 37 % 101 AS DOUBLE) / 100.0 AS p_pos FROM corpus)"""


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as texts: id, role, text."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * TURNS + F.col("turn")).alias("id"), "role", "text")


CONVERSATIONS = f"""turns AS (
  SELECT conv_id * {TURNS} + turn AS id, role, text FROM conversations)"""

# Token weights of a linear scorer. Multiples of 1/8 add up exactly in any order.
WORD_WEIGHTS = {
    "the": 0.125, "of": -0.25, "and": 0.125, "to": 0.25, "in": -0.125, "a": 0.5, "is": -0.5,
    "that": 0.375, "it": -0.375, "for": 0.75, "on": -0.625, "was": -0.75, "with": 0.625,
    "de": 0.125, "la": -0.125, "der": 0.25, "die": -0.25, "und": 0.375, "que": -0.375,
    "he": 0.875, "she": -0.875, "by": -1.0, "not": -1.25,
}
INTERCEPT = 0.25

WEIGHTS = "weights(token, weight) AS (VALUES " + ", ".join(
    f"('{t}', CAST({w} AS DOUBLE))" for t, w in WORD_WEIGHTS.items()) + ")"

TOKEN_LIST = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"


def word_scores(source: str, key: str = "id", result: str = "word_scored") -> str:
    """SQL fragment: p_pos of every row of ``source`` under the word weights."""
    return f"""{result}_tokens AS (
  SELECT {key}, unnest({TOKEN_LIST}) AS token FROM {source}),
{result} AS (
  SELECT s.*, 1.0 / (1.0 + exp(-({INTERCEPT} + coalesce(t.total, 0.0)))) AS p_pos
  FROM {source} s LEFT JOIN (
    SELECT {key}, sum(weight) AS total FROM {result}_tokens JOIN weights USING (token)
    GROUP BY {key}) t USING ({key}))"""
