"""Registered queries against their SQL, and on the small fixtures that SQL is run over too."""

import duckdb
import pytest

import oracle
import shared
from gristmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf, name):
    assert oracle.compare(queries.QUERIES[name](spark, sf), oracle.duck(sf), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(queries.SQL))
@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_matches_sql_on_odd_rows(spark, tmp_path, name, rows):
    seen = set()
    distinct = [r for r in shared.ODD if r[0] is not None and not (r[0] in seen or seen.add(r[0]))]
    table = shared.docs(spark, distinct if rows == "odd" else [])
    table.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma"), (2, "x"), (3, None), (4, "..."), (4, "漢字 ok")]
    spark.createDataFrame(items if rows == "odd" else [], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert oracle.compare(queries.QUERIES[name](spark, str(tmp_path)), con, queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_takes_odd_and_empty_tables(spark, tmp_path, name):
    for kind, rows in (("odd", shared.ODD), ("empty", [])):
        base = f"{tmp_path}/{kind}"
        shared.docs(spark, rows).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([(1, "alpha beta gamma delta")] if rows else [], "item_id long, text string") \
            .write.parquet(f"{base}/benchmark.parquet")
        spark.createDataFrame([(2, 1), (4, 0), (4, None), (None, 1), (5, 1)] if rows else [], "doc_id long, toxic int") \
            .write.parquet(f"{base}/labels.parquet")
        out = queries.QUERIES[name](spark, base)
        assert out.count() == len(rows)
        ids = sorted((r.doc_id for r in out.collect()), key=lambda x: (x is None, x or 0))
        assert ids == sorted((r[0] for r in rows), key=lambda x: (x is None, x or 0))
