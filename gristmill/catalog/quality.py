"""Label-issue and repair queries over noisy vectors, and the quality pass over documents."""

from pyspark.sql import functions as F

from gristmill.catalog import inputs
from gristmill.catalog.neighbouring import embed_sql, pairs_sql
from gristmill.operators import issues, label_model, repair
from gristmill.operators.sampling import assign_folds
from gristmill.plans.lineage import settle
from gristmill.plans.quality import quality_pass

DOC_OUTLIER_SCORE = 0.3


def probs_sql(source: str, result: str = "probs") -> str:
    """SQL fragment: out-of-fold softmax over minus four squared distances to class centroids."""
    return f"""{result}_rows AS (
  SELECT id, label, embedding, ntile(5) OVER (PARTITION BY label ORDER BY id) AS fold FROM {source}),
{result}_flat AS (
  SELECT id, label, fold, unnest(range(64)) AS dim, unnest(embedding) AS v FROM {result}_rows),
{result}_means AS (
  SELECT f.fold, t.label, t.dim, avg(t.v) AS mean FROM (SELECT DISTINCT fold FROM {result}_rows) f
  JOIN {result}_flat t ON t.fold <> f.fold GROUP BY f.fold, t.label, t.dim),
{result}_dist AS (
  SELECT x.id, x.fold, exp(-4.0 * sum((x.v - m.mean) * (x.v - m.mean)) FILTER (WHERE m.label = 0)) AS w0,
    exp(-4.0 * sum((x.v - m.mean) * (x.v - m.mean)) FILTER (WHERE m.label = 1)) AS w1
  FROM {result}_flat x JOIN {result}_means m ON x.fold = m.fold AND x.dim = m.dim GROUP BY x.id, x.fold),
{result} AS (SELECT id, CAST(fold AS INTEGER) AS fold, w0 / (w0 + w1) AS p0, w1 / (w0 + w1) AS p1
  FROM {result}_dist)"""


def label_sql(source: str, result: str = "labelled") -> str:
    """SQL fragment: confident-learning flags over ``probs``."""
    return f"""{result}_bars AS (
  SELECT avg(p0) FILTER (WHERE label = 0) - 1e-6 AS t0, avg(p1) FILTER (WHERE label = 1) - 1e-6 AS t1
  FROM {source} JOIN probs USING (id)),
{result}_judged AS (
  SELECT c.id, c.label, p0, p1, CASE WHEN label = 0 THEN p0 ELSE p1 END AS label_score,
    CASE WHEN p1 > p0 THEN 1 ELSE 0 END AS predicted_label,
    CASE WHEN p0 >= t0 AND (p1 < t1 OR p0 >= p1) THEN 0 WHEN p1 >= t1 THEN 1 END AS confident
  FROM {source} c JOIN probs p ON c.id = p.id, {result}_bars),
{result} AS (
  SELECT id, coalesce(confident <> label, false) AND predicted_label <> label AS is_label_issue, label_score, label AS given_label,
    predicted_label FROM {result}_judged)"""


def _rows(spark, sf):
    noisy = inputs.noisy(spark, sf)
    return settle(assign_folds(noisy))


def _found(spark, sf, rule="confident"):
    rows = _rows(spark, sf)
    return rows, settle(issues.label_issues(rows, settle(label_model.centroid_probabilities(rows)), rule=rule))


def _label_rows(found):
    return found.select("id", "is_label_issue", F.round("label_score", 6).alias("label_score"),
                        "given_label", "predicted_label")


def oof_centroid_probs(spark, sf):
    return label_model.centroid_probabilities(_rows(spark, sf)).select(
        "id", "fold", F.round(F.col("p")[0], 6).alias("p0"), F.round(F.col("p")[1], 6).alias("p1"))


def prob_table_check(spark, sf):
    rows = _rows(spark, sf)
    return label_model.check_probabilities(rows, label_model.centroid_probabilities(rows))


def label_issues_unbalanced(spark, sf):
    """Classes of about 85 and 15 %, with probabilities by formula: the confident class is often the less probable one."""
    return _label_rows(issues.label_issues(*_unbalanced(spark, sf)))


def label_issues_unbalanced_noise_rate(spark, sf):
    return _label_rows(issues.label_issues(*_unbalanced(spark, sf), rule="noise_rate"))


def _unbalanced(spark, sf):
    rows = inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id")) \
        .withColumn("label", (F.col("id") * 7 % 20 < 3).cast("int")) \
        .withColumn("p1", (F.col("id") * 37 % 101).cast("double") / 101.0 * F.when(F.col("label") == 1, 0.75).otherwise(0.5))
    rows = settle(rows)
    return rows.select("id", "label"), rows.select("id", F.array(1.0 - F.col("p1"), F.col("p1")).alias("p"))


def relabel(spark, sf):
    rows, found = _found(spark, sf)
    return repair.fix_labels(rows.select("id", "label"), found)


def relabel_limited(spark, sf):
    """Only the ten worst flagged rows, and only those scored below 0.4."""
    rows, found = _found(spark, sf)
    return repair.fix_labels(rows.select("id", "label"),
                             repair.select_label_fixes(found, 0.4, 10))


def worst_label_issues(spark, sf):
    return _label_rows(issues.worst(_found(spark, sf)[1], "is_label_issue", "label_score"))


def mildest_label_issues(spark, sf):
    return _label_rows(issues.mildest(_found(spark, sf)[1], "is_label_issue", "label_score"))


def _pass(spark, sf, **settings):
    return quality_pass(inputs.corpus(spark, sf, per_token=True), prober=label_model.centroid_probabilities,
                        outlier_score=DOC_OUTLIER_SCORE, **settings)


def quality_pass_rows(spark, sf):
    return _pass(spark, sf).corpus.select("id", "label")


def quality_pass_two_rounds(spark, sf):
    return _pass(spark, sf, iterations=2, keep="first").corpus.select("id", "label")


def issue_log(spark, sf):
    log = _pass(spark, sf).log
    none = F.lit(-1)
    return log.select("iteration", "kind", "id", "label_name", F.round("score", 6).alias("score"),
                      F.coalesce("given_label", none).alias("given_label"),
                      F.coalesce("predicted_label", none).alias("predicted_label"), "text")


def quality_report(spark, sf):
    none = F.lit(-1.0)
    return _pass(spark, sf).report.select(
        "issue", "rows", "flagged", F.round("share", 6).alias("share"),
        F.coalesce(F.round("min_score", 6), none).alias("min_score"),
        F.coalesce(F.round("mean_score", 6), none).alias("mean_score"))


QUERIES = {
    "oof_centroid_probs": oof_centroid_probs,
    "prob_table_check": prob_table_check,
    "label_issues": lambda spark, sf: _label_rows(_found(spark, sf)[1]),
    "label_issues_noise_rate": lambda spark, sf: _label_rows(_found(spark, sf, "noise_rate")[1]),
    "label_issues_unbalanced": label_issues_unbalanced,
    "label_issues_unbalanced_noise_rate": label_issues_unbalanced_noise_rate,
    "worst_label_issues": worst_label_issues,
    "mildest_label_issues": mildest_label_issues,
    "relabel": relabel,
    "relabel_limited": relabel_limited,
    "quality_pass": quality_pass_rows,
    "quality_steps": lambda spark, sf: _pass(spark, sf).steps,
    "quality_pass_two_rounds": quality_pass_two_rounds,
    "issue_log": issue_log,
    "quality_report": quality_report,
}

_UNBALANCED = f"""noisy AS (
  SELECT vec_id AS id, CAST(vec_id * 7 % 20 < 3 AS INTEGER) AS label FROM embeddings),
probs AS (
  SELECT id, 1.0 - p1 AS p0, p1 FROM (
    SELECT id, CAST(id * 37 % 101 AS DOUBLE) / CAST(101 AS DOUBLE)
      * CASE WHEN label = 1 THEN CAST(0.75 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS p1 FROM noisy)), {label_sql('noisy')}"""
_NOISY = f"{inputs.NOISY}, {probs_sql('noisy')}, {label_sql('noisy')}"
_LABEL_COLUMNS = "id, is_label_issue, round(label_score, 6) AS label_score, given_label, predicted_label"


def _round_sql(n: int, source: str, result: str, keep: str = "none") -> str:
    """SQL fragment: one round of the pass over ``source`` (id, text, label, embedding)."""
    drop = ("SELECT id FROM near_issues WHERE is_near_duplicate_issue" if keep == "none" else
            "SELECT id FROM near_pairs, near_cutoff WHERE d <= cutoff AND other < id")
    round_ = f"""{pairs_sql(source)}, {probs_sql(source)}, {label_sql(source)},
flagged_out AS (SELECT id, outlier_score, outlier_score < {DOC_OUTLIER_SCORE} AS is_outlier_issue FROM near_outliers),
dropped AS ({drop}),
{result} AS (
  SELECT c.id, c.text, c.embedding, CASE WHEN l.is_label_issue THEN l.predicted_label ELSE c.label END AS label
  FROM {source} c JOIN labelled l ON c.id = l.id
  WHERE c.id NOT IN (SELECT id FROM dropped)
    AND c.id NOT IN (SELECT id FROM flagged_out WHERE is_outlier_issue))"""
    if n > 1:
        for name in ("near_pairs", "near_cutoff", "near_issues", "near_sets", "near_means", "near_outliers", "near",
                     "probs_rows", "probs_flat", "probs_means", "probs_dist", "probs",
                     "labelled_bars", "labelled_judged", "labelled", "flagged_out", "dropped"):
            round_ = _rename(round_, name, f"{name}_{n}")
    return round_


def _rename(sql: str, old: str, new: str) -> str:
    import re
    return re.sub(rf"\b{old}\b", new, sql)


_START = f"""{inputs.CORPUS}, {embed_sql('corpus')},
start AS (SELECT c.id, c.text, c.label, h.embedding FROM corpus c JOIN hashed h ON c.id = h.id)"""


def _noise_rate_sql(source: str) -> str:
    return f"""WITH {source},
joint AS (
  SELECT label, count(*) AS n, count(confident) AS sure,
    count(*) FILTER (WHERE confident <> label) AS off FROM labelled_judged GROUP BY label),
ranked AS (
  SELECT id, label, row_number() OVER (PARTITION BY label
    ORDER BY CASE WHEN label = 0 THEN p0 - p1 ELSE p1 - p0 END, id) AS place FROM labelled_judged)
SELECT l.id, r.place <= round_even(CAST(j.off * j.n AS DOUBLE) / j.sure, 0)
    AND l.predicted_label <> l.given_label AS is_label_issue,
  round(l.label_score, 6) AS label_score, l.given_label, l.predicted_label
FROM labelled l JOIN ranked r ON l.id = r.id JOIN joint j ON r.label = j.label"""


_ROUND = f"{_START}, {_round_sql(1, 'start', 'done')}"

SQL = {
    "oof_centroid_probs": f"""WITH {inputs.NOISY}, {probs_sql('noisy')}
SELECT id, fold, round(p0, 6) AS p0, round(p1, 6) AS p1 FROM probs""",
    "prob_table_check": f"""WITH {inputs.NOISY}, {probs_sql('noisy')}
SELECT count(n.id) AS corpus_rows, count(p.id) AS scored_rows, count(*) FILTER (WHERE p.id IS NULL) AS unscored,
  count(*) FILTER (WHERE n.id IS NULL) AS unknown, CAST(min(len([p0, p1])) AS INTEGER) AS min_size,
  CAST(max(len([p0, p1])) AS INTEGER) AS max_size,
  count(n.id) = count(p.id) AND count(*) FILTER (WHERE p.id IS NULL OR n.id IS NULL) = 0
    AND min(len([p0, p1])) = 2 AND max(len([p0, p1])) = 2 AS valid
FROM noisy n FULL JOIN probs p ON n.id = p.id""",
    "label_issues": f"WITH {_NOISY} SELECT {_LABEL_COLUMNS} FROM labelled",
    "label_issues_unbalanced": f"WITH {_UNBALANCED} SELECT {_LABEL_COLUMNS} FROM labelled",
    "label_issues_noise_rate": _noise_rate_sql(_NOISY),
    "label_issues_unbalanced_noise_rate": _noise_rate_sql(_UNBALANCED),
    "worst_label_issues": f"""WITH {_NOISY}
SELECT {_LABEL_COLUMNS} FROM (SELECT * FROM labelled WHERE is_label_issue ORDER BY label_score, id LIMIT 10)""",
    "mildest_label_issues": f"""WITH {_NOISY}
SELECT {_LABEL_COLUMNS} FROM (
  SELECT * FROM labelled WHERE is_label_issue ORDER BY label_score DESC, id DESC LIMIT 10)""",
    "relabel": f"""WITH {_NOISY}
SELECT id, CASE WHEN is_label_issue THEN predicted_label ELSE given_label END AS label FROM labelled""",
    "relabel_limited": f"""WITH {_NOISY},
fixes AS (
  SELECT * FROM labelled WHERE is_label_issue AND label_score < 0.4 ORDER BY label_score, id LIMIT 10)
SELECT l.id, coalesce(f.predicted_label, l.given_label) AS label
FROM labelled l LEFT JOIN fixes f ON l.id = f.id""",
    "quality_pass": f"WITH {_ROUND} SELECT id, label FROM done",
    "quality_pass_two_rounds": f"""WITH {_START}, {_round_sql(1, 'start', 'once', 'first')},
{_round_sql(2, 'once', 'twice', 'first')} SELECT id, label FROM twice""",
    "quality_steps": f"""WITH {_ROUND},
kept AS (
  SELECT s.id, s.label, l.is_label_issue, l.predicted_label,
    s.id NOT IN (SELECT id FROM dropped) AS stays, s.id IN (SELECT id FROM done) AS ends
  FROM start s JOIN labelled l ON s.id = l.id)
SELECT 1 AS iteration, 'near duplicates' AS step, count(*) AS rows_in, count(*) FILTER (WHERE stays) AS rows_out,
  CAST(0 AS BIGINT) AS relabelled FROM kept
UNION ALL SELECT 1, 'labels', count(*) FILTER (WHERE stays), count(*) FILTER (WHERE stays),
  count(*) FILTER (WHERE stays AND is_label_issue AND predicted_label <> label) FROM kept
UNION ALL SELECT 1, 'outliers', count(*) FILTER (WHERE stays), count(*) FILTER (WHERE ends), 0 FROM kept""",
    "issue_log": f"""WITH {_ROUND},
logged AS (
  SELECT 'near_duplicate' AS kind, id, near_duplicate_score AS score, -1 AS given_label, -1 AS predicted_label
  FROM near_issues WHERE is_near_duplicate_issue
  UNION ALL SELECT 'outlier', id, outlier_score, -1, -1 FROM flagged_out WHERE is_outlier_issue
  UNION ALL SELECT * FROM (SELECT 'label', id, label_score, given_label, predicted_label
    FROM labelled WHERE is_label_issue ORDER BY label_score, id LIMIT 10))
SELECT 1 AS iteration, kind, g.id, CASE WHEN label = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label_name,
  round(score, 6) AS score, given_label, predicted_label, text
FROM logged g JOIN start s ON g.id = s.id""",
    "quality_report": f"""WITH {_ROUND},
facts AS (
  SELECT 'near_duplicate' AS issue, is_near_duplicate_issue AS flag, near_duplicate_score AS score FROM near_issues
  UNION ALL SELECT 'label', is_label_issue, label_score FROM labelled
  UNION ALL SELECT 'outlier', is_outlier_issue, outlier_score FROM flagged_out)
SELECT issue, count(*) AS rows, count(*) FILTER (WHERE flag) AS flagged,
  round(count(*) FILTER (WHERE flag) / CAST(count(*) AS DOUBLE), 6) AS share,
  round(min(score), 6) AS min_score, round(avg(score), 6) AS mean_score FROM facts GROUP BY issue
UNION ALL SELECT 'missing text', count(*), count(*) - count(text),
  round((count(*) - count(text)) / CAST(count(*) AS DOUBLE), 6), -1.0, -1.0 FROM start
UNION ALL SELECT 'class ' || label, CAST(sum(count(*)) OVER () AS BIGINT), count(*),
  round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6), -1.0, -1.0 FROM start GROUP BY label""",
}
