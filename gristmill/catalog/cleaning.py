"""Cleaning queries."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.functions import text as tx
from gristmill.operators import clean

# SQL text of the white-space characters and of the boilerplate test.
SPACES = "concat(" + ", ".join(f"chr({ord(c)})" for c in tx.WHITE_SPACE) + ")"
_TERMS = "(?i)(" + "|".join(tx.BOILERPLATE_TERMS) + ")"

LONG = inputs.REVIEWS + f""",
long AS (
  SELECT id * 2 AS id, trim(negative, {SPACES}) AS text, 0 AS label FROM reviews
  UNION ALL
  SELECT id * 2 + 1, trim(positive, {SPACES}), 1 FROM reviews),
fates AS (
  SELECT id, lower(text) AS text, label,
    CASE WHEN text IS NULL THEN 'null'
         WHEN regexp_full_match(text, '{_TERMS}') THEN 'term'
         WHEN length(text) < 1 THEN 'too short' END AS reason
  FROM long),
cleaned AS (
  SELECT min(id) AS id, text, label FROM fates WHERE reason IS NULL GROUP BY text, label)"""


def _long(spark, sf_dir):
    return clean.to_long(inputs.reviews(spark, sf_dir))


def review_summary(spark, sf_dir):
    """Rows, ids and characters per class after cleaning."""
    return clean.clean_reviews(inputs.reviews(spark, sf_dir)).groupBy("label").agg(
        F.count("*").alias("rows"), F.sum("id").alias("id_sum"),
        F.sum(F.length("text")).alias("chars"))


def exact_dedup(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.lit(0).alias("label"))
    return clean.exact_dedup(documents).select("id", F.length("text").alias("chars"))


def casefold_dedup(spark, sf_dir):
    """Copies in any case go; the kept text is spelled as it was."""
    kept = clean.clean_corpus(_long(spark, sf_dir), lowercase_text=False, casefold_dedup=True)
    return kept.select("id", "text", "label")


QUERIES = {
    "clean_reviews": lambda spark, sf: clean.clean_reviews(inputs.reviews(spark, sf)),
    "clean_review_summary": review_summary,
    "clean_audit": lambda spark, sf: clean.clean_audit(_long(spark, sf)),
    "conflicting_texts": lambda spark, sf: clean.conflicting_texts(
        clean.clean_corpus(_long(spark, sf))),
    "exact_dedup": exact_dedup,
    "casefold_dedup": casefold_dedup,
}

SQL = {
    "clean_reviews": f"WITH {LONG} SELECT id, text, label FROM cleaned",
    "clean_review_summary": f"""WITH {LONG}
SELECT label, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum,
  CAST(sum(length(text)) AS BIGINT) AS chars
FROM cleaned GROUP BY label""",
    "clean_audit": f"""WITH {LONG}
SELECT label, reason AS fate, count(*) AS rows FROM fates WHERE reason IS NOT NULL GROUP BY label, reason
UNION ALL SELECT label, 'kept', count(*) FROM cleaned GROUP BY label
UNION ALL SELECT f.label, 'duplicate', f.n - c.n
FROM (SELECT label, count(*) AS n FROM fates WHERE reason IS NULL GROUP BY label) f
JOIN (SELECT label, count(*) AS n FROM cleaned GROUP BY label) c ON f.label = c.label""",
    "conflicting_texts": f"""WITH {LONG}
SELECT text, count(*) FILTER (WHERE label = 0) AS negative_rows,
  count(*) FILTER (WHERE label = 1) AS positive_rows, min(id) AS first_id
FROM cleaned GROUP BY text HAVING count(DISTINCT label) > 1""",
    "exact_dedup": """SELECT min(doc_id) AS id, CAST(length(text) AS INTEGER) AS chars FROM documents GROUP BY text""",
    "casefold_dedup": f"""WITH {LONG},
kept AS (
  SELECT min(id) AS id FROM fates WHERE reason IS NULL GROUP BY text, label)
SELECT l.id, l.text, l.label FROM long l JOIN kept k ON l.id = k.id""",
}
