"""Metric queries over a scored table."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.operators import metrics, sampling

_PRED = inputs.SCORED + """,
pred AS (SELECT *, CAST(p_pos >= 0.5 AS INTEGER) AS pred FROM scored),
counts AS (
  SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
  FROM pred),
rates AS (
  SELECT tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 0.0) AS "Precision",
    coalesce(tp / nullif(tp + fn, 0), 0.0) AS "Recall",
    coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS "F1",
    coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / nullif(sqrt(CAST(tp + fp AS DOUBLE)
      * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0.0) AS "MCC"
  FROM counts),
auc AS (
  SELECT sum(CASE WHEN a.p_pos > b.p_pos THEN 1.0 WHEN a.p_pos = b.p_pos THEN 0.5 ELSE 0.0 END)
    / count(*) AS "AUROC"
  FROM scored a JOIN scored b ON a.label = 1 AND b.label = 0)"""

_RATES = ("Precision", "Recall", "F1", "MCC")


def _round(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


QUERIES = {
    "confusion_metrics": lambda spark, sf: _round(
        metrics.confusion_metrics(inputs.scored(spark, sf)), *_RATES),
    "auroc_exact": lambda spark, sf: _round(metrics.auroc(inputs.scored(spark, sf)), "AUROC"),
    "evaluate_scored": lambda spark, sf: _round(
        metrics.evaluate(inputs.scored(spark, sf)), "AUROC", *_RATES),
    "log_loss": lambda spark, sf: _round(metrics.log_loss(inputs.scored(spark, sf)), "log_loss"),
    "hard_examples": lambda spark, sf: metrics.hard_examples(inputs.scored(spark, sf)),
    "first_n_per_label": lambda spark, sf: sampling.first_per_class(
        inputs.corpus(spark, sf)).select("id", "label"),
}

SQL = {
    "confusion_metrics": f"""WITH {_PRED}
SELECT tp, fp, fn, tn, round("Precision", 6) AS "Precision", round("Recall", 6) AS "Recall",
  round("F1", 6) AS "F1", round("MCC", 6) AS "MCC" FROM rates""",
    "auroc_exact": f"""WITH {_PRED} SELECT round("AUROC", 6) AS "AUROC" FROM auc""",
    "evaluate_scored": f"""WITH {_PRED}
SELECT round("Precision", 6) AS "Precision", round("Recall", 6) AS "Recall", round("F1", 6) AS "F1",
  (SELECT round("AUROC", 6) FROM auc) AS "AUROC", round("MCC", 6) AS "MCC" FROM rates""",
    "log_loss": f"""WITH {inputs.SCORED}
SELECT round(avg(-ln(CASE WHEN label = 1 THEN p ELSE 1.0 - p END)), 6) AS log_loss
FROM (SELECT label, greatest(least(p_pos, CAST(1.0 AS DOUBLE) - CAST(1e-15 AS DOUBLE)), CAST(1e-15 AS DOUBLE)) AS p
      FROM scored)""",
    "hard_examples": f"""WITH {_PRED},
kinds AS (
  SELECT id, label, p_pos, pred, 'false positive' AS kind, -p_pos AS key FROM pred WHERE label = 0 AND pred = 1
  UNION ALL SELECT id, label, p_pos, pred, 'false negative', p_pos FROM pred WHERE label = 1 AND pred = 0
  UNION ALL SELECT id, label, p_pos, pred, 'uncertain', round(abs(p_pos - 0.5), 9) FROM pred),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY kind ORDER BY key, id) AS INTEGER) AS rank FROM kinds)
SELECT id, label, p_pos, pred, kind, rank FROM ranked WHERE rank <= 10""",
    "first_n_per_label": f"""WITH {inputs.CORPUS}
SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY id) AS place FROM corpus)
WHERE place <= 3""",
}
