"""What the jobs refuse, and what they promise about ids and folders."""

import glob

import pytest
from pyspark.sql import functions as F

from gristmill.operators import clean, issues, neighbours, sampling
from gristmill.plans import lineage, workflow
from gristmill.sources import reviews as source


@pytest.mark.parametrize("bad", [
    {"sample_size": 0}, {"train_frac": 1.5, "valid_frac": -0.5, "test_frac": 0.0}, {"train_frac": 0.5}, {"cv_folds": 1},
    {"regularization_c": 0.0}, {"reg_params": ()}, {"iterations": 0}, {"keep_near_duplicates": "all"}, {"label_rule": "x"},
    {"label_issue_threshold": 1.5}, {"max_label_fixes": -1}, {"near_duplicate_share": -0.1}, {"outlier_score": 2.0},
    {"target": 3}, {"min_text_len": -1},
])
def test_settings_out_of_bounds(bad):
    with pytest.raises(ValueError):
        workflow.Settings(**bad)


def test_default_run_uses_every_row():
    assert workflow.Settings().sample_size is None


def test_fractions_and_null_labels_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id long, label int")
    with pytest.raises(ValueError, match="missing in 1 rows"):
        sampling.stratified_sample(df, 2)
    full = df.filter("label IS NOT NULL")
    for fractions in ((1.5, -0.5, 0.0), (0.5, 0.2, 0.2), (0.0, 0.0, 1.0)):
        with pytest.raises(ValueError):
            sampling.split_corpus(full, *fractions)
    with pytest.raises(ValueError):
        sampling.split_by_counts(full, 0.8, 0.8)


@pytest.mark.parametrize("order", [("id", "neg", "pos"), ("pos", "more", "neg", "id")])
@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_columns_are_found_by_name(spark, tmp_path, order, fmt):
    rows = [(7, "bad, really", "good", "x"), (8, None, "fine", "y")]
    df = spark.createDataFrame(rows, "id long, neg string, pos string, more string").select(*order)
    df.write.format(fmt).options(header=True).save(f"{tmp_path}/in")
    found = source.load_reviews(spark, f"{tmp_path}/in", fmt, "id", "neg", "pos").collect()
    assert sorted((r.id, r.negative, r.positive) for r in found) == [(7, "bad, really", "good"), (8, None, "fine")]


def test_tables_without_id_get_one_from_content(spark, tmp_path):
    rows = [("bad", "good")] * 3 + [(None, "x"), ("y", None), (None, None)] + [(str(i), "p") for i in range(50)]
    for parts in (1, 7):
        spark.createDataFrame(rows, "n string, p string").repartition(parts).write.parquet(f"{tmp_path}/{parts}")
    tables = [sorted((r.id, r.negative or "", r.positive or "") for r in source.load_reviews(
        spark, f"{tmp_path}/{parts}", id_col=None, negative_col="n", positive_col="p").collect()) for parts in (1, 7)]
    assert tables[0] == tables[1]
    assert [r[0] for r in tables[0]] == list(range(len(rows)))


@pytest.mark.parametrize("ids", [[1, None], [1, 1], [1, 7 * 10**18]])
def test_ids_that_would_lose_rows_are_refused(spark, tmp_path, ids):
    spark.createDataFrame([(i, "a", "b") for i in ids], "id long, n string, p string").write.parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="review ids"):
        source.load_reviews(spark, f"{tmp_path}/in", negative_col="n", positive_col="p")


def test_missing_columns_are_named(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, n string").write.parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="no column"):
        source.load_reviews(spark, f"{tmp_path}/in", negative_col="n", positive_col="p")


def test_scratch_leaves_no_folder(spark):
    base = lineage.shared_dir(spark)
    before = set(glob.glob(f"{base}/gristmill-*"))
    with lineage.scratch(spark):
        assert lineage.settle(spark.range(5)).count() == 5
        assert set(glob.glob(f"{base}/gristmill-*")) != before
    assert set(glob.glob(f"{base}/gristmill-*")) == before


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.shared_dir(Session())


def test_small_side_measures_bytes(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("v"))
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(lineage.small_side(df)) or "LocalRelation" in plan(lineage.small_side(df))
    assert lineage.small_side(df, max_bytes=100) is df
    assert lineage.small_side(df, max_rows=5) is df


def test_sets_of_thirty_copies_are_whole(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100 + i, [float(i + 1), 50.0]) for i in range(5)]
    index = neighbours.build_index(spark.createDataFrame(rows, "id long, embedding array<double>"))
    near = neighbours.knn(index, 10)
    found = issues.near_duplicate_sets(issues.near_duplicate_issues(near, 0.0), neighbours.within(index, 0.0))
    sets = {r.id: (r.near_duplicate_set, r.near_duplicate_set_size) for r in found.collect()}
    assert all(sets[i] == (0, 30) for i in range(30))
    assert all(sets[100 + i] == (100 + i, 1) for i in range(5))


def test_better_pruning_means_fewer_visits(spark, monkeypatch):
    """Clustered vectors in cell order visit fewer blocks, and move fewer bytes, than the same in hash order."""
    import numpy as np
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8))
    vectors = [(i, (centres[i % 40] + 0.01 * rng.normal(size=8)).tolist()) for i in range(4000)]
    index = neighbours.build_index(spark.createDataFrame(vectors, "id long, embedding array<double>"), cell_rows=64, block_rows=64)
    rows = index.groups.select("grp", "vec", "cell", "block", F.lit(0.01).alias("reach"))

    def visits():
        return neighbours._visits(index, rows, neighbours._wanted_cells, include_home=True).count()
    ordered = visits()
    monkeypatch.setattr(neighbours, "_by_cell", lambda df: df.repartition(4, "grp"))
    assert ordered < 0.5 * visits()


def test_casefold_keeps_the_first_spelling(spark):
    df = spark.createDataFrame([(3, "Hello", 1), (1, "HELLO", 1), (2, "hello", 0), (4, None, 1), (5, None, 1)], "id long, text string, label int")
    assert sorted(r.id for r in clean.exact_dedup(df, casefold=True).collect()) == [1, 2, 4]
