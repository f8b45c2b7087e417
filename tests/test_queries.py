"""Every registered query against its SQL, on whole tables."""

import pytest

import oracle
from gristmill import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.duck(sf)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    difference = oracle.compare(QUERIES[name](spark, sf), con, SQL[name])
    assert difference is None, difference


def test_out_of_fold_logistic_probabilities(spark, sf):
    rows = QUERIES["oof_logreg_probs"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert all(abs(r.p0 + r.p1 - 1.0) < 1e-9 and 0.0 <= r.p1 <= 1.0 for r in rows)
    assert {r.fold for r in rows} == {1, 2, 3, 4, 5}


def test_entry(spark):
    import __spark_entry__ as contract
    assert contract.entry(spark).columns == ["label", "rows", "id_sum", "chars"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
