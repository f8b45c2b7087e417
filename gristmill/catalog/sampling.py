"""Sampling, splitting and fold queries over the labelled documents."""

from gristmill.catalog import inputs
from gristmill.operators import sampling

_ORDER = "md5(concat('0:', CAST(id AS VARCHAR))), id"


def _quota(size: str, source: str, result: str, by: str = "label") -> str:
    """Largest-remainder shares of ``size`` rows over the class sizes n of ``source``."""
    return f"""{result}_share AS (
  SELECT {by}, n, {size} AS size, {size} * n // sum(n) OVER () AS base,
    {size} * n % sum(n) OVER () AS remainder FROM {source}),
{result} AS (
  SELECT {by}, n, CAST(base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, {by})
      <= size - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota
  FROM {result}_share)"""


def _split(label: str, test: str, valid: str) -> str:
    return f"""{inputs.CORPUS},
rows AS (
  SELECT id, label, {label} AS stratum, row_number() OVER (PARTITION BY {label} ORDER BY {_ORDER}) AS place
  FROM corpus),
total AS (SELECT count(*) AS n FROM corpus),
sizes AS (SELECT stratum, count(*) AS n FROM rows GROUP BY stratum),
want AS (SELECT n, CAST({test} AS BIGINT) AS test FROM total),
want2 AS (SELECT n, test, CAST({valid} AS BIGINT) AS valid FROM want),
{_quota('(SELECT test FROM want)', 'sizes', 'test_of', 'stratum')},
rest AS (SELECT stratum, n - quota AS n FROM test_of),
{_quota('(SELECT valid FROM want2)', 'rest', 'valid_of', 'stratum')}
SELECT r.id, r.label, CASE WHEN place <= t.quota THEN 'test'
    WHEN place <= t.quota + v.quota THEN 'valid' ELSE 'train' END AS split
FROM rows r JOIN test_of t ON r.stratum = t.stratum JOIN valid_of v ON r.stratum = v.stratum"""


_TEST = "ceil(CAST(0.3 AS DOUBLE) * n)"
_VALID = "ceil(CAST(0.1 AS DOUBLE) / (CAST(0.6 AS DOUBLE) + CAST(0.1 AS DOUBLE)) * (n - test))"


def _half(spark, sf):
    """Half of the labelled documents, as the size of a sample."""
    return inputs.table(spark, sf, "labels").count() // 2


QUERIES = {
    "stratified_sample": lambda spark, sf: sampling.stratified_sample(
        inputs.corpus(spark, sf), _half(spark, sf)).select("id", "label"),
    "simple_sample": lambda spark, sf: sampling.simple_sample(
        inputs.corpus(spark, sf), _half(spark, sf)).select("id", "label"),
    "split_corpus": lambda spark, sf: sampling.split_corpus(
        inputs.corpus(spark, sf)).select("id", "label", "split"),
    "split_unstratified": lambda spark, sf: sampling.split_corpus(
        inputs.corpus(spark, sf), stratify=False).select("id", "label", "split"),
    "split_by_counts": lambda spark, sf: sampling.split_by_counts(
        inputs.corpus(spark, sf)).select("id", "label", "split"),
    "kfold_assign": lambda spark, sf: sampling.assign_folds(
        inputs.corpus(spark, sf)).select("id", "label", "fold"),
}

_HALF = "(SELECT count(*) // 2 FROM labels)"

SQL = {
    "stratified_sample": f"""WITH {inputs.CORPUS},
sizes AS (SELECT label, count(*) AS n FROM corpus GROUP BY label),
{_quota(_HALF, 'sizes', 'picked')},
rows AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {_ORDER}) AS place FROM corpus)
SELECT r.id, r.label FROM rows r JOIN picked p ON r.label = p.label WHERE place <= quota""",
    "simple_sample": f"""WITH {inputs.CORPUS}
SELECT id, label FROM corpus ORDER BY {_ORDER} LIMIT {_HALF}""",
    "split_corpus": "WITH " + _split("label", _TEST, _VALID),
    "split_unstratified": "WITH " + _split("0", _TEST, _VALID),
    "split_by_counts": "WITH " + _split(
        "label", "trunc(CAST(0.3 AS DOUBLE) * n)", "n - test - trunc(CAST(0.6 AS DOUBLE) * n)"),
    "kfold_assign": f"""WITH {inputs.CORPUS}
SELECT id, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY id) AS INTEGER) AS fold FROM corpus""",
}
