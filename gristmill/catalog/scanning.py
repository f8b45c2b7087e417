"""Scan queries over the labelled documents with the word-weight scorer."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.catalog.modelling import SCORER
from gristmill.operators import scan
from gristmill.plans.lineage import settle

MIN_ROWS = 20


def _scored(spark, sf):
    return settle(SCORER(inputs.corpus(spark, sf, per_token=True)))


def _six(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


QUERIES = {
    "slice_scan": lambda spark, sf: _six(
        scan.slice_scan(_scored(spark, sf), MIN_ROWS), "value", "overall", "drop"),
    "confidence_scan": lambda spark, sf: _six(
        scan.confidence_scan(_scored(spark, sf), sure=0.7, min_rows=MIN_ROWS), "rate", "overall", "lift"),
    "perturbation_scan": lambda spark, sf: _six(
        scan.perturbation_scan(inputs.corpus(spark, sf, per_token=True), SCORER), "mean_shift", "rate"),
    "swap_scan": lambda spark, sf: _six(
        scan.swap_scan(inputs.corpus(spark, sf, per_token=True), SCORER), "mean_shift", "rate"),
    "scan_findings": lambda spark, sf: _six(
        scan.scan(inputs.corpus(spark, sf, per_token=True), SCORER, MIN_ROWS), "value", "reference"),
}

_SCORED = f"{inputs.CORPUS}, {inputs.WEIGHTS}, {inputs.word_scores('corpus')}"
_WORDS = f"""words AS (
  SELECT id, label, p_pos, CAST(p_pos >= 0.5 AS INTEGER) AS pred,
    unnest(list_distinct({inputs.TOKEN_LIST})) AS token FROM word_scored)"""
_COUNTS = """count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn"""


def _metrics_sql(source: str, keys: str) -> str:
    parts = {
        "accuracy": "(tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)",
        "Precision": "coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0)",
        "Recall": "coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0)",
        "F1": "coalesce(2.0 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0)",
    }
    return " UNION ALL ".join(f"SELECT {keys}'{m}' AS metric, {e} AS value FROM {source}" for m, e in parts.items())


def _slices(min_drop: float = 0.1) -> str:
    return f"""per_token AS (SELECT token, count(*) AS rows, {_COUNTS} FROM words GROUP BY token HAVING count(*) >= {MIN_ROWS}),
per_all AS (SELECT {_COUNTS} FROM (SELECT label, CAST(p_pos >= 0.5 AS INTEGER) AS pred FROM word_scored)),
slices AS ({_metrics_sql('per_token', 'token, rows, ')}),
overalls AS ({_metrics_sql('per_all', '')}),
weak AS (
  SELECT token, rows, metric, s.value, o.value AS overall, (o.value - s.value) / nullif(o.value, 0) AS drop
  FROM slices s JOIN overalls o USING (metric)
  WHERE (o.value - s.value) / nullif(o.value, 0) >= {min_drop})"""


def _trust(sure: float, unsure: float = 0.05, min_lift: float = 0.1) -> str:
    over = f"CAST(pred <> label AND greatest(p_pos, 1.0 - p_pos) >= {sure} AS INTEGER)"
    under = f"CAST(round(abs(p_pos - 0.5), 9) <= {unsure} AS INTEGER)"
    return f"""trust_token AS (
  SELECT token, count(*) AS rows, sum({over}) AS over, sum({under}) AS under FROM words
  GROUP BY token HAVING count(*) >= {MIN_ROWS}),
trust_all AS (
  SELECT count(*) AS n, sum({over}) AS over, sum({under}) AS under
  FROM (SELECT *, CAST(p_pos >= 0.5 AS INTEGER) AS pred FROM word_scored)),
trust_long AS (
  SELECT token, rows, 'overconfident' AS kind, t.over / CAST(rows AS DOUBLE) AS rate, a.over / CAST(n AS DOUBLE) AS overall
  FROM trust_token t, trust_all a
  UNION ALL
  SELECT token, rows, 'underconfident', t.under / CAST(rows AS DOUBLE), a.under / CAST(n AS DOUBLE)
  FROM trust_token t, trust_all a),
trust AS (
  SELECT token, rows, kind, rate, overall, (rate - overall) / nullif(overall, 0) AS lift FROM trust_long
  WHERE (rate - overall) / nullif(overall, 0) >= {min_lift})"""


_PLACE = ("(CAST('0x' || substr(md5(concat('0:', CAST(id AS VARCHAR))), 1, 8) AS BIGINT) "
          "% greatest(length(text) - 1, 1) + 1)")
_TRANSFORMS = {
    "upper case": "upper(text)",
    "lower case": "lower(text)",
    "title case": "array_to_string(list_transform(string_split(text, ' '), "
                  "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')",
    "no punctuation": r"regexp_replace(text, '\p{P}+', '', 'g')",
    "typo": f"""CASE WHEN length(text) < 2 THEN text ELSE
      concat(substr(text, 1, {_PLACE} - 1), substr(text, {_PLACE} + 1, 1), substr(text, {_PLACE}, 1),
             substr(text, {_PLACE} + 2)) END""",
}


def _exchanged(pairs: dict[str, str]) -> str:
    table = ("map([" + ", ".join(f"'{k}'" for k in pairs) + "], ["
             + ", ".join(f"'{v}'" for v in pairs.values()) + "])")
    return (r"array_to_string(list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), "
            f"lambda w: coalesce({table}[lower(w)], w)), '')")


_SWAPS = {group: _exchanged(pairs) for group, pairs in scan.WORD_SWAPS.items()}


def _stability(transforms: dict[str, str], name: str) -> str:
    variants = " UNION ALL ".join(
        f"SELECT id || ':{t}' AS variant, '{t}' AS transform, p_pos AS p_base, text AS base_text, {e} AS text "
        f"FROM word_scored" for t, e in transforms.items())
    return f"""{name}_all AS ({variants}),
{name}_changed AS (SELECT variant, transform, p_base, text FROM {name}_all WHERE text <> base_text),
{inputs.word_scores(name + '_changed', 'variant', name + '_tried')},
{name} AS (
  SELECT transform, count(*) AS tested, count(*) FILTER (WHERE (p_pos >= 0.5) <> (p_base >= 0.5)) AS changed,
    avg(abs(p_pos - p_base)) AS mean_shift,
    count(*) FILTER (WHERE (p_pos >= 0.5) <> (p_base >= 0.5)) / CAST(count(*) AS DOUBLE) AS rate
  FROM {name}_tried GROUP BY transform)"""


_STABLE = """SELECT transform, tested, changed, round(mean_shift, 6) AS mean_shift, round(rate, 6) AS rate,
  rate > 0.05 AS flagged FROM """

SQL = {
    "slice_scan": f"""WITH {_SCORED}, {_WORDS}, {_slices()}
SELECT token, rows, metric, round(value, 6) AS value, round(overall, 6) AS overall, round(drop, 6) AS drop FROM weak""",
    "confidence_scan": f"""WITH {_SCORED}, {_WORDS}, {_trust(0.7)}
SELECT token, rows, kind, round(rate, 6) AS rate, round(overall, 6) AS overall, round(lift, 6) AS lift FROM trust""",
    "perturbation_scan": f"WITH {_SCORED}, {_stability(_TRANSFORMS, 'moved')} {_STABLE} moved",
    "swap_scan": f"WITH {_SCORED}, {_stability(_SWAPS, 'swapped')} {_STABLE} swapped",
    "scan_findings": f"""WITH {_SCORED}, {_WORDS}, {_slices()}, {_trust(0.9)}, {_stability(_TRANSFORMS, 'moved')},
{_stability(_SWAPS, 'swapped')}
SELECT 'slice' AS scan, token AS subject, metric AS measure, rows, round(value, 6) AS value,
  round(overall, 6) AS reference FROM weak
UNION ALL SELECT 'confidence', token, kind, rows, round(rate, 6), round(overall, 6) FROM trust
UNION ALL SELECT 'perturbation', transform, 'changed', tested, round(rate, 6), 0.05 FROM moved WHERE rate > 0.05
UNION ALL SELECT 'word swap', transform, 'changed', tested, round(rate, 6), 0.05 FROM swapped WHERE rate > 0.05""",
}
