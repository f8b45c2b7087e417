"""Profiling queries."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.operators import clean, profile
from gristmill.catalog.cleaning import LONG


def _stripped(spark, sf):
    from gristmill.functions import text as tx
    return clean.to_long(inputs.reviews(spark, sf)).withColumn("text", tx.strip(F.col("text")))


def _percent(df):
    return df.withColumn("percentage", F.round("percentage", 6))


def _top(source: str, by: str | None) -> str:
    group = f"{by}, " if by else ""
    share = f"(SELECT {group}count(*) AS total FROM {source}" + (f" GROUP BY {by})" if by else ")")
    on = f"USING ({by})" if by else "ON true"
    part = f"PARTITION BY {by} " if by else ""
    return f"""counted AS (
  SELECT {group}text, count(*) AS rows, min(id) AS first_id FROM {source}
  WHERE text IS NOT NULL GROUP BY {group}text),
ranked AS (
  SELECT *, row_number() OVER ({part}ORDER BY rows DESC, first_id) AS place FROM counted)
SELECT {group}first_id, text, rows, round(rows * 100.0 / total, 6) AS percentage
FROM ranked JOIN {share} t {on} WHERE place <= 20"""


def _histogram(source: str, by: str) -> str:
    return f"""lengths AS (
  SELECT {by}, length(text) AS chars,
    min(length(text)) OVER (PARTITION BY {by}) AS low, max(length(text)) OVER (PARTITION BY {by}) AS high
  FROM {source})
SELECT {by}, CASE WHEN high = low THEN 0
    ELSE least(CAST(floor((chars - low) / ((high - low) / CAST(10.0 AS DOUBLE))) AS INTEGER), 9) END AS bin,
  count(*) AS rows, CAST(min(chars) AS INTEGER) AS shortest, CAST(max(chars) AS INTEGER) AS longest
FROM lengths GROUP BY 1, 2"""


def _ends(spark, sf):
    return profile.head_and_tail(inputs.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "lang", "source", "n_chars"))


QUERIES = {
    "dup_top20_by_label": lambda spark, sf: _percent(
        profile.top_texts(_stripped(spark, sf), by="label")),
    "dup_top20_all": lambda spark, sf: _percent(profile.top_texts(_stripped(spark, sf))),
    "dup_top20_documents": lambda spark, sf: _percent(profile.top_texts(
        inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))),
    "dup_top20_by_role": lambda spark, sf: _percent(
        profile.top_texts(inputs.conversations(spark, sf), by="role")),
    "length_histogram": lambda spark, sf: profile.length_histogram(inputs.corpus(spark, sf)),
    "length_histogram_by_role": lambda spark, sf: profile.length_histogram(
        inputs.conversations(spark, sf), by="role"),
    "label_distribution": lambda spark, sf: _percent(
        profile.class_counts(inputs.corpus(spark, sf))),
    "null_profile": lambda spark, sf: profile.column_profile(inputs.reviews(spark, sf)),
    "head_tail": _ends,
}

SQL = {
    "dup_top20_by_label": f"WITH {LONG}, {_top('long', 'label')}",
    "dup_top20_all": f"WITH {LONG}, {_top('long', None)}",
    "dup_top20_documents": "WITH docs AS (SELECT doc_id AS id, text FROM documents), " + _top("docs", None),
    "dup_top20_by_role": f"WITH {inputs.CONVERSATIONS}, {_top('turns', 'role')}",
    "length_histogram": f"WITH {inputs.CORPUS}, {_histogram('corpus', 'label')}",
    "length_histogram_by_role": f"WITH {inputs.CONVERSATIONS}, {_histogram('turns', 'role')}",
    "label_distribution": f"""WITH {inputs.CORPUS}
SELECT label, count(*) AS rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM corpus GROUP BY label""",
    "null_profile": f"""WITH {inputs.REVIEWS}
SELECT 'id' AS "column", 'bigint' AS "type", count(*) AS rows, count(*) - count(id) AS nulls FROM reviews
UNION ALL SELECT 'negative', 'string', count(*), count(*) - count(negative) FROM reviews
UNION ALL SELECT 'positive', 'string', count(*), count(*) - count(positive) FROM reviews""",
    "head_tail": """SELECT * FROM (SELECT doc_id AS id, lang, source, n_chars, 'head' AS part
  FROM documents ORDER BY doc_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT doc_id, lang, source, n_chars, 'tail'
  FROM documents ORDER BY doc_id DESC LIMIT 10)""",
}
