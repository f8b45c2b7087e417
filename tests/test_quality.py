import pytest
from pyspark.sql import functions as F

from gristmill.operators import issues, label_model, repair, sampling
from gristmill.operators.vectors import hashed_embeddings, model_embeddings
from gristmill.plans.quality import quality_pass


def corpus(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, label int")


def probabilities(spark, rows):
    return spark.createDataFrame([(i, 1, [1.0 - p, p]) for i, p in rows], "id long, fold int, p array<double>")


def label_table(spark, *fixes):
    return spark.createDataFrame([(i, True, s, g, p) for i, s, g, p in fixes],
                                 "id long, is_label_issue boolean, label_score double, given_label int, predicted_label int")


def flags(spark, name, score, ids):
    return spark.createDataFrame([(i, True, 0.1) for i in ids], f"id long, {name} boolean, {score} double")


def test_a_dropped_row_does_not_shift_later_repairs(spark):
    df = corpus(spark, [(i, f"t{i}", 0) for i in range(1, 8)])
    left = repair.drop_near_duplicates(
        df, flags(spark, "is_near_duplicate_issue", "near_duplicate_score", [1]))
    fixed = repair.fix_labels(left, label_table(spark, (5, 0.1, 0, 1), (1, 0.1, 0, 1)))
    final = repair.drop_outliers(fixed, flags(spark, "is_outlier_issue", "outlier_score", [6]))
    assert {r.id: r.label for r in final.collect()} == {2: 0, 3: 0, 4: 0, 5: 1, 7: 0}


def test_fix_limits(spark):
    found = label_table(spark, (1, 0.05, 0, 1), (2, 0.2, 0, 1), (3, 0.4, 0, 1))
    def ids(**limits):
        return {r.id for r in repair.select_label_fixes(found, **limits).collect()}
    assert ids() == {1, 2, 3}
    assert ids(label_issue_threshold=0.3) == {1, 2}
    assert ids(max_label_fixes=1) == {1}


def test_confident_learning(spark):
    df = corpus(spark, [(1, "a", 0), (2, "b", 0), (3, "c", 0), (4, "d", 1), (5, "e", 1), (6, "f", 1)])
    p = probabilities(spark, [(1, 0.1), (2, 0.2), (3, 0.9), (4, 0.8), (5, 0.9), (6, 0.45)])
    rows = {r.id: r for r in issues.label_issues(df, p).collect()}
    assert {i for i, r in rows.items() if r.is_label_issue} == {3}
    assert rows[3].predicted_label == 1 and rows[3].label_score == pytest.approx(0.1)
    assert not rows[6].is_label_issue


def test_noise_rate_with_tied_margins(spark):
    """Half the rows of a class share one probability; the lowest ids go first."""
    df = corpus(spark, [(i, "x", int(i >= 50)) for i in range(100)])
    p = probabilities(spark, [(i, 0.9 if i < 25 else 0.1) if i < 50 else (i, 0.8) for i in range(100)])
    flagged = {r.id for r in issues.label_issues(df, p, rule="noise_rate").filter("is_label_issue").collect()}
    assert flagged == set(range(25))


def test_probability_check(spark):
    df = corpus(spark, [(1, "a", 0), (2, "b", 1)])
    label_model.require_probabilities(df, probabilities(spark, [(1, 0.5), (2, 0.5)]))
    for bad in ([(1, 0.5)], [(1, 0.5), (3, 0.5)]):
        with pytest.raises(ValueError):
            label_model.require_probabilities(df, probabilities(spark, bad))


def test_logistic_matches_the_penalised_optimum(spark):
    """The gradient of mean loss + |w|^2 / (2 C n) vanishes at the fitted weights."""
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4))
    y = (x[:, 0] + 0.5 * rng.normal(size=120) > 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, y))],
                               "id long, embedding array<double>, label int")
    rows = sampling.assign_folds(df, folds=3)
    c = 0.5
    got = {r.id: r for r in label_model.logistic_probabilities(rows, c).collect()}
    fold_of = np.array([got[i].fold for i in range(120)])
    for fold in (1, 2, 3):
        train, own = fold_of != fold, fold_of == fold
        w, b = np.zeros(4), 0.0
        for _ in range(4000):
            p = 1 / (1 + np.exp(-(x[train] @ w + b)))
            w -= 0.5 * (x[train].T @ (p - y[train]) / train.sum() + w / (c * train.sum()))
            b -= 0.5 * (p - y[train]).mean()
        want = 1 / (1 + np.exp(-(x[own] @ w + b)))
        assert np.allclose([got[i].p[1] for i in np.flatnonzero(own)], want, atol=1e-3)


def test_texts_without_tokens_get_a_zero_vector(spark):
    df = corpus(spark, [(1, "...", 0), (2, "one two", 0)])
    got = {r.id: r.embedding for r in hashed_embeddings(df, 8).collect()}
    assert got[1] == [0.0] * 8 and sum(v * v for v in got[2]) == pytest.approx(1.0)


def test_outside_embedder(spark):
    def make():
        import numpy as np
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], dtype=float)
    df = corpus(spark, [(1, "abca", 0), (2, "xyz", 0)])
    got = {r.id: r.embedding for r in model_embeddings(df, make, 2).collect()}
    assert got == {1: [4.0, 2.0], 2: [3.0, 0.0]}


def test_two_rounds_feed_forward(spark):
    rows = [(i, f"good stay room {i} view {i * 7}", 1) for i in range(20)]
    rows += [(100 + i, f"bad noise dirty {i} smell {i * 3}", 0) for i in range(20)]
    rows += [(200, "good stay room 1 view 7", 1), (201, "good stay room 1 view 7", 1)]
    result = quality_pass(corpus(spark, rows), iterations=2, keep="first", folds=3, outlier_score=0.01)
    ids = {r.id for r in result.corpus.collect()}
    assert 1 in ids and not {200, 201} & ids
    steps = {(r.iteration, r.step): r for r in result.steps.collect()}
    assert steps[(1, "near duplicates")].rows_in == 42
    assert steps[(2, "near duplicates")].rows_in == steps[(1, "outliers")].rows_out
    assert steps[(2, "outliers")].rows_out == len(ids)
    logged = result.log.filter("iteration = 1 and kind = 'near_duplicate'").select("id").collect()
    assert {1, 200, 201} <= {r.id for r in logged}
    with pytest.raises(ValueError):
        quality_pass(corpus(spark, rows), iterations=0)


def test_report_counts_missing_texts(spark):
    df = corpus(spark, [(1, None, 0), (2, "b", 1), (3, "c", 1)])
    near = flags(spark, "is_near_duplicate_issue", "near_duplicate_score", [2])
    report = {r.issue: r for r in issues.quality_report(
        df, near, label_table(spark, (2, 0.3, 1, 0)), flags(spark, "is_outlier_issue", "outlier_score", [3])).collect()}
    assert report["missing text"].flagged == 1 and report["class 1"].share == pytest.approx(2 / 3)
    assert report["label"].min_score == pytest.approx(0.3)
