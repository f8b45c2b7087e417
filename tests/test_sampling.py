from collections import Counter

import pytest
from pyspark.sql import functions as F

from gristmill.operators import ordering, sampling


def table(spark, n, positives=None):
    positives = n // 4 if positives is None else positives
    return spark.range(1, n + 1).select(
        "id", (F.col("id") <= positives).cast("int").alias("label"),
        F.concat(F.lit("t"), F.col("id")).alias("text"))


@pytest.mark.parametrize("n, sizes", [(10, (5, 2, 3)), (399, (239, 40, 120)), (1000, (599, 101, 300)),
                                      (50_000, (29_999, 5_001, 15_000))])
def test_split_sizes(n, sizes):
    assert sampling.split_sizes(n, 0.6, 0.1, 0.3) == sizes


def test_fractions_are_checked():
    with pytest.raises(ValueError):
        sampling.split_sizes(10, 0.5, 0.1, 0.3)
    with pytest.raises(ValueError):
        sampling.split_sizes(10, 0.0, 0.0, 1.0)


def test_largest_remainder():
    assert sampling.largest_remainder(3, {0: 5, 1: 5}) == {0: 2, 1: 1}
    assert sampling.largest_remainder(7, {0: 1, 1: 99}) == {0: 0, 1: 7}
    assert sampling.largest_remainder(0, {}) == {}


@pytest.mark.parametrize("stratify", [True, False])
def test_split_is_complete_disjoint_and_proportional(spark, stratify):
    df = table(spark, 1000)
    rows = sampling.split_corpus(df, stratify=stratify).collect()
    assert sorted(r.id for r in rows) == list(range(1, 1001))
    assert Counter(r.split for r in rows) == {"train": 599, "valid": 101, "test": 300}
    if stratify:
        shares = Counter((r.split, r.label) for r in rows)
        assert shares[("test", 1)] == 75 and abs(shares[("valid", 1)] - 25.25) < 1


def test_split_does_not_depend_on_partitioning(spark):
    df = table(spark, 500)
    one = {r.id: r.split for r in sampling.split_corpus(df.coalesce(1)).collect()}
    many = {r.id: r.split for r in sampling.split_corpus(df.repartition(13)).collect()}
    assert one == many


def test_split_by_counts_truncates(spark):
    rows = sampling.split_by_counts(table(spark, 10)).collect()
    assert Counter(r.split for r in rows) == {"train": 6, "valid": 1, "test": 3}


def test_samples_have_exact_size(spark):
    df = table(spark, 97, positives=30)
    rows = sampling.stratified_sample(df, 50).collect()
    assert len(rows) == 50 and len({r.id for r in rows}) == 50
    assert Counter(r.label for r in rows) == {0: 35, 1: 15}
    assert sampling.simple_sample(df, 97).count() == 97
    assert sampling.simple_sample(df, 13, seed=5).count() == 13
    with pytest.raises(ValueError):
        sampling.stratified_sample(df, 98)


def test_seed_changes_the_sample(spark):
    df = table(spark, 200)
    a, b = ({r.id for r in sampling.simple_sample(df, 50, seed).collect()} for seed in (0, 1))
    assert a != b


@pytest.mark.parametrize("buckets", [None, 16])
def test_folds_are_even_runs_of_ids(spark, monkeypatch, buckets):
    monkeypatch.setattr(ordering, "BUCKETS", buckets)
    rows = sampling.assign_folds(table(spark, 103, positives=23), folds=4).collect()
    for label in (0, 1):
        ordered = [r.fold for r in sorted(rows, key=lambda r: r.id) if r.label == label]
        sizes = Counter(ordered)
        assert ordered == sorted(ordered) and max(sizes.values()) - min(sizes.values()) <= 1
    with pytest.raises(ValueError):
        sampling.assign_folds(table(spark, 10), folds=1)


def test_full_rows_are_not_shuffled(spark):
    plan = sampling.split_corpus(table(spark, 100))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], [float(i % 7) for i in range(101)]])
@pytest.mark.parametrize("buckets", [None, 16])
def test_exact_median(spark, monkeypatch, values, buckets):
    import statistics
    monkeypatch.setattr(ordering, "BUCKETS", buckets)
    df = spark.createDataFrame([(v,) for v in values], "d double")
    assert ordering.exact_median(df, "d").first()["median"] == statistics.median(values)


@pytest.mark.parametrize("rank", [1, 250, 400])
def test_ranks_inside_a_hot_value(spark, monkeypatch, rank):
    """A value held by most rows is ranked by id, in buckets of ids."""
    monkeypatch.setattr(ordering, "BUCKETS", 16)
    df = spark.range(400).select(
        "id", F.lit(0).alias("s"), F.when(F.col("id") % 10 < 8, 0.5).otherwise(F.col("id") / 400.0).alias("v"))
    wanted = spark.createDataFrame([(0, 0, rank)], "s int, cut int, rank long")
    key = ordering.keys_at_tied_ranks(df, wanted, "s", "v").first()["key"]
    expected = sorted((r.v, r.id) for r in df.collect())[rank - 1]
    assert (key["v"], key["id"]) == expected
