"""Attribution queries over the labelled documents with the word weights."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.operators import attribution


def _weights(spark):
    return spark.createDataFrame(list(inputs.WORD_WEIGHTS.items()), "token string, weight double")


def _found(spark, sf, **settings):
    return attribution.attribute_tokens(
        inputs.corpus(spark, sf, per_token=True), _weights(spark), inputs.INTERCEPT, **settings)


def _rows(found):
    return found.select("id", "true_label", "pred_label", F.round("p_pos", 6).alias("p_pos"),
                        F.round("p_target", 6).alias("p_target"), "pos", "token",
                        F.round("attr", 6).alias("attr"))


def attribution_totals(spark, sf):
    totals = attribution.attribution_totals(_found(spark, sf))
    return totals.select("id", "tokens", (F.round("attr_sum", 6) + 0.0).alias("attr_sum"),
                         F.round("attr_norm", 6).alias("attr_norm"))


def token_effects(spark, sf):
    effects = attribution.token_effects(_found(spark, sf))
    return effects.select("token", "places", (F.round("mean_attr", 6) + 0.0).alias("mean_attr"))


def attribution_samples(spark, sf):
    """All tokens of the first three texts of each class, probability at six decimals."""
    found = attribution.explain_samples(inputs.corpus(spark, sf, per_token=True), _weights(spark), inputs.INTERCEPT)
    return found.select("id", "true_label", "pred_label", F.format_string("%.6f", "p_target").alias("pred_proba"),
                        "pos", "token", F.round("attr", 6).alias("attr"))


QUERIES = {
    "token_attributions": lambda spark, sf: _rows(_found(spark, sf)),
    "token_attributions_positive": lambda spark, sf: _rows(_found(spark, sf, target=1)),
    # As beside a weight table too large to broadcast.
    "token_attributions_large": lambda spark, sf: _rows(_found(spark, sf, broadcast_rows=0)),
    "attribution_totals": attribution_totals,
    "token_effects": token_effects,
    "attribution_samples": attribution_samples,
}


def _attributed(target: str = "CASE WHEN p_pos > 0.5 THEN 1 ELSE 0 END") -> str:
    return f"""{inputs.CORPUS}, {inputs.WEIGHTS}, {inputs.word_scores('corpus')},
aimed AS (SELECT *, {target} AS pred_label FROM word_scored),
placed AS (
  SELECT id, label AS true_label, pred_label, p_pos,
    CASE WHEN pred_label = 1 THEN p_pos ELSE 1.0 - p_pos END AS p_target,
    unnest(range(len({inputs.TOKEN_LIST}))) AS pos, unnest({inputs.TOKEN_LIST}) AS token FROM aimed),
lengths AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM placed JOIN weights USING (token) GROUP BY id),
attributed AS (
  SELECT p.id, true_label, pred_label, p_pos, p_target, CAST(pos AS INTEGER) AS pos, p.token,
    CASE WHEN pred_label = 1 THEN 1.0 ELSE -1.0 END * weight / (norm + CAST(1e-12 AS DOUBLE)) AS attr
  FROM placed p JOIN weights w ON p.token = w.token JOIN lengths l ON p.id = l.id)"""


_COLUMNS = """SELECT id, true_label, pred_label, round(p_pos, 6) AS p_pos, round(p_target, 6) AS p_target, pos, token,
  round(attr, 6) AS attr FROM attributed"""

SQL = {
    "token_attributions": f"WITH {_attributed()} {_COLUMNS}",
    "token_attributions_positive": f"WITH {_attributed('1')} {_COLUMNS}",
    "token_attributions_large": f"WITH {_attributed()} {_COLUMNS}",
    "attribution_totals": f"""WITH {_attributed()}
SELECT id, count(*) AS tokens, round(sum(attr), 6) + 0.0 AS attr_sum, round(sqrt(sum(attr * attr)), 6) AS attr_norm
FROM attributed GROUP BY id""",
    "token_effects": f"""WITH {_attributed()}
SELECT token, count(*) AS places, round(avg(CASE WHEN pred_label = 1 THEN attr ELSE -attr END), 6) + 0.0 AS mean_attr
FROM attributed GROUP BY token""",
    "attribution_samples": f"""WITH {_attributed()},
chosen AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY label ORDER BY id) AS place FROM corpus)
  WHERE place <= 3)
SELECT p.id, p.true_label, p.pred_label, printf('%.6f', p.p_target) AS pred_proba, CAST(p.pos AS INTEGER) AS pos,
  p.token, round(coalesce(a.attr, 0.0), 6) AS attr
FROM placed p JOIN chosen c ON p.id = c.id LEFT JOIN attributed a ON a.id = p.id AND a.pos = p.pos""",
}
