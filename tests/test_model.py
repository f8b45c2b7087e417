import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gristmill.catalog import modelling
from gristmill.functions import scores, text as tx
from gristmill.operators import attribution, classifier, scan
from gristmill.plans import lineage, workflow
from gristmill.plans.joins import frequent_join, frequent_keys
from gristmill.sources import reviews as source, sinks
from gristmill.sources.stages import (
    MissingStage, check_stage, commit_stage, content_state, manifest, read_stage, write_stage,
)
from gristmill.streaming import scoring


def corpus(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, label int")


@pytest.fixture(scope="module")
def reviews(spark):
    good = ["lovely room and great view", "great breakfast lovely staff", "clean room great bed",
            "friendly people great place", "lovely view of the park", "great value clean bath"]
    bad = ["dirty room and awful smell", "awful bed noisy street", "rude people dirty bath",
           "noisy room broken shower", "awful breakfast dirty plates", "broken lift rude manager"]
    rows = [(i, f"{bad[i % 6]} {['today', 'again', 'sadly', 'alas', 'night'][i % 5]} {i}",
             f" {good[i % 6]} {['thanks', 'indeed', 'surely', 'wow', 'yes'][i % 5]} {i} ") for i in range(60)]
    rows += [(60, "No Negative", "none"), (61, None, "great breakfast lovely staff thanks 6")]
    return spark.createDataFrame(rows, "id long, Negative_Review string, Positive_Review string")


@pytest.fixture(scope="module")
def run(spark, reviews, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    reviews.write.mode("overwrite").option("header", True).csv(f"{base}/input")
    loaded = source.load_reviews(spark, f"{base}/input", fmt="csv", header=True)
    settings = workflow.Settings(sample_size=80, keep_near_duplicates="first", cv_folds=3,
                                 reg_params=(0.01, 0.1), scan_min_rows=3)
    facts = workflow.run_all(loaded, base, settings).first()
    return base, facts


def test_run_learns_and_writes_every_stage(spark, run):
    base, facts = run
    assert facts.AUROC > 0.9 and facts.MCC > 0.5
    names = ("raw_preview", "neg_preview", "pos_preview", "clean", "quality_fixed", "quality_log", "quality_log_text",
             "splits", "tokenized", "model", "trials", "scored", "metrics", "hard_examples", "findings", "explain")
    assert all(os.path.exists(f"{base}/{n}") for n in names)
    part = [f for f in os.listdir(f"{base}/metrics") if f.endswith(".json")][0]
    assert set(json.load(open(f"{base}/metrics/{part}"))) == {"Precision", "Recall", "F1", "AUROC", "MCC"}
    splits = read_stage(spark, base, "splits")
    plan = splits.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_attribution_files(spark, run):
    base, _ = run
    samples = spark.read.options(**sinks.TSV).csv(f"{base}/explain/samples")
    assert samples.columns == ["sample", "true_label", "pred_label", "pred_proba", "text"]
    rows = samples.collect()
    assert len(rows) == 6 and all(len(r.pred_proba.split(".")[1]) == 6 for r in rows)
    tokens = spark.read.options(**sinks.TSV).csv(f"{base}/explain/tokens")
    assert set(tokens.columns) == {"sample", "pos", "token", "attr"}
    assert {str(r.sample) for r in tokens.select("sample").distinct().collect()} == {r.sample for r in rows}


def test_issue_log_text(spark, run):
    lines = [r.value for r in spark.read.text(f"{run[0]}/quality_log_text").collect()]
    assert any(line.startswith("## Iteration 1") for line in lines)


def test_inference_and_reload(spark, run):
    texts = spark.createDataFrame([(1, "great lovely clean"), (2, "awful dirty rude")], "id long, text string")
    got = {r.id: r for r in workflow.run_inference(spark, run[0], texts).collect()}
    assert (got[1].label_name, got[2].label_name) == ("positive", "negative")
    assert got[1].p_pos > 0.5 > got[2].p_pos


def test_stream_equals_batch(spark, run, tmp_path):
    texts = spark.createDataFrame(
        [(1, " Great lovely "), (2, "NONE"), (3, "awful dirty"), (4, "  "), (5, None)], "id long, text string")
    texts.repartition(3).write.parquet(f"{tmp_path}/in")
    scorer = classifier.model_scorer(classifier.load_model(f"{run[0]}/model"))

    def pump():
        stream = scoring.read_texts(spark, f"{tmp_path}/in")
        scoring.score_stream(stream, scorer, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        return sorted((r.id, r.text, r.p_pos) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    batch = sorted((r.id, r.text, r.p_pos) for r in scoring.clean_and_score(texts, scorer).collect())
    assert pump() == batch and [r[0] for r in batch] == [1, 3]
    assert pump() == batch
    spark.createDataFrame([(9, "great")], "id long, text string").write.mode("append").parquet(f"{tmp_path}/in")
    assert [r[0] for r in pump()] == [1, 3, 9]


@pytest.mark.parametrize("files", [1, 3])
def test_stream_query_reads_a_file_or_a_folder(spark, tmp_path, files):
    rows = spark.createDataFrame([(1, "the room"), (2, "none"), (3, "a view")], "doc_id long, text string")
    rows.repartition(files).write.parquet(f"{tmp_path}/written")
    if files == 1:
        part = [f for f in os.listdir(tmp_path / "written") if f.startswith("part-")][0]
        os.link(tmp_path / "written" / part, tmp_path / "documents.parquet")
    else:
        rows.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.id for r in modelling.stream_score(spark, str(tmp_path)).collect()) == [1, 3]


def test_missing_stage_is_named(spark, tmp_path):
    with pytest.raises(MissingStage, match="clean"):
        workflow.run_quality(spark, str(tmp_path))


def test_half_written_stage_is_refused(spark, tmp_path):
    base = str(tmp_path)
    write_stage(spark.range(4), base, "x")
    broken = spark.range(8).withColumn("id", F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")))
    with pytest.raises(Exception, match="killed"):
        write_stage(broken, base, "x")
    spark.range(3).write.mode("overwrite").parquet(f"{base}/x")  # files of a write that never committed
    with pytest.raises(MissingStage, match="not finished"):
        read_stage(spark, base, "x")
    commit_stage(spark, base, "x")
    assert manifest(spark, base, "x").rows == 3 and read_stage(spark, base, "x").count() == 3


def test_lost_files_are_noticed(spark, tmp_path):
    base = str(tmp_path)
    write_stage(spark.range(0, 40, 1, 4), base, "x")
    spark.range(5).write.mode("overwrite").parquet(f"{base}/x")
    with pytest.raises(MissingStage, match="5 rows, 40 were written"):
        check_stage(spark, base, "x")
    lineage.remove(spark, f"{base}/x")
    with pytest.raises(MissingStage, match="gone"):
        read_stage(spark, base, "x").count()


def test_content_state_goes_by_rows_not_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id long, `a.b` string")
    assert content_state(df) == content_state(df.orderBy(F.desc("id")).repartition(3).select("`a.b`", "id"))
    assert len({content_state(d) for d in (df, df.distinct(), df.limit(0), df.withColumn("id", F.col("id") + 1),
                                           df.withColumnRenamed("id", "n"))}) == 5


def test_killed_run_goes_on(spark, reviews, tmp_path, monkeypatch):
    base, called = str(tmp_path), []
    settings = workflow.Settings(sample_size=80, keep_near_duplicates="first", cv_folds=3, reg_params=(0.1,), scan_min_rows=3)
    loaded = reviews.toDF("id", "negative", "positive")
    names = [step.name for step in workflow.STEPS]
    for name in names:
        def note(*args, _name=name, _step=getattr(workflow, f"run_{name}"), **settings):
            called.append(_name)
            return _step(*args, **settings)
        monkeypatch.setattr(workflow, f"run_{name}", note)
    saved = classifier.save_model
    monkeypatch.setattr(classifier, "save_model", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        workflow.run_all(loaded, base, settings, resume=True)
    monkeypatch.setattr(classifier, "save_model", saved)
    assert called == names[:5]
    del called[:]
    first = workflow.run_all(loaded, base, settings, resume=True).first()
    assert called == names[4:]
    del called[:]
    assert workflow.run_all(loaded, base, settings, resume=True).first() == first and called == []
    # Another setting runs again what reads it and all that follows; so does a stage written by someone else.
    workflow.run_all(loaded, base, replace(settings, hard_examples=2), resume=True)
    assert called == names[5:]
    del called[:]
    commit_stage(spark, base, "findings")
    workflow.run_all(loaded, base, replace(settings, hard_examples=2), resume=True)
    assert called == names[6:]
    assert not workflow.step_done(spark, base, "clean", "another state")


def test_stages_overwrite(spark, tmp_path):
    for n in (3, 2):
        assert write_stage(spark.range(n), str(tmp_path), "x").count() == n


def test_small_side_only_broadcasts_small_tables(spark):
    def plan(limit):
        side = lineage.small_side(spark.range(100), limit)
        return spark.range(1000).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(100) and "strategy=broadcast" not in plan(99)


def test_shared_folder_is_the_named_one(spark):
    assert lineage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_scorers_agree(spark):
    df = corpus(spark, [(1, "A b, b c", 1), (2, "zzz", 0), (3, "", 0)])
    weights = {"a": 0.5, "b": -1.25}
    table = spark.createDataFrame(list(weights.items()), "token string, weight double")
    one = {r.id: r.p_pos for r in classifier.word_scorer(weights, 0.25)(df).collect()}
    two = {r.id: r.p_pos for r in classifier.score_by_table(df, table, 0.25).collect()}
    assert one == pytest.approx(two)
    with pytest.raises(ValueError):
        classifier.word_scorer({str(i): 1.0 for i in range(300)})


def test_outside_scorer(spark):
    def make():
        import numpy as np
        return lambda texts: np.array([len(t) / 10.0 for t in texts])
    got = classifier.outside_scorer(make)(corpus(spark, [(1, "abc", 1), (2, "abcde", 0)])).collect()
    assert {r.id: r.p_pos for r in got} == {1: 0.3, 2: 0.5}


@pytest.mark.parametrize("keep_unknown", [False, True])
def test_frequent_tokens_join_apart_from_the_rest(spark, keep_unknown):
    # A third of all places is one token with a weight, a third one without; the rest is long-tailed.
    rows = [(i, f"the of {'w%d' % (i % 7)} {'rare%d' % i} the of", i % 2) for i in range(600)] + [(600, None, 0), (601, "", 1)]
    df = corpus(spark, rows)
    weights = spark.createDataFrame(
        [("the", 0.25), ("unseen", 3.0)] + [(f"w{i}", float(i - 3)) for i in range(7)] + [(f"rare{i}", i / 600) for i in range(0, 600, 2)],
        "token string, weight double")
    small, large = (sorted(map(tuple, attribution.attribute_tokens(
        df, weights, 0.1, keep_unknown=keep_unknown, broadcast_rows=n).collect())) for n in (300_000, 0))
    assert len(small) == len(large) and all(a[:3] == b[:3] and a[5:7] == b[5:7] and a[3:] == pytest.approx(b[3:]) for a, b in zip(small, large))
    near, far = ({r.id: r.p_pos for r in classifier.score_by_table(df, weights, 0.1, broadcast_rows=n).collect()} for n in (300_000, 0))
    assert near == pytest.approx(far)


def test_frequent_keys_are_all_that_are_frequent(spark):
    places = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("token"))
    found = {r.token for r in frequent_keys(places, "token", 0.01).collect()}
    assert "hot" in found and None not in found and len(found) <= 100
    table = spark.createDataFrame([("hot", 1.0), ("t1", 2.0), ("t1000", 3.0)], "token string, weight double")
    for how in ("inner", "left"):
        plain = places.join(table, "token", how)
        assert sorted(map(str, frequent_join(places, table, "token", how, 0.01).collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError, match="how"):
        frequent_join(places, table, "token", "outer")


def test_attributions(spark):
    df = corpus(spark, [(1, "good bad good", 1), (2, "nothing known", 0)])
    weights = spark.createDataFrame([("good", 0.5), ("bad", -1.0)], "token string, weight double")
    rows = attribution.attribute_tokens(df, weights, 0.125).collect()
    assert {r.id for r in rows} == {1}
    assert [r.token for r in sorted(rows, key=lambda r: r.pos)] == ["good", "bad", "good"]
    assert sum(r.attr ** 2 for r in rows) == pytest.approx(1.0)
    negative = attribution.attribute_tokens(df, weights, 0.125, target=0).collect()
    assert {(r.pos, round(r.attr, 9)) for r in negative} == {(r.pos, round(-r.attr, 9)) for r in rows}
    assert rows[0].p_pos + negative[0].p_target == pytest.approx(1.0)
    every = attribution.attribute_tokens(df, weights, keep_unknown=True).filter("id = 2").collect()
    assert [r.attr for r in every] == [0.0, 0.0]


def test_hashed_features_have_no_token_weights(spark):
    df = corpus(spark, [(i, "good day" if i % 2 else "bad day", i % 2) for i in range(20)])
    trained = classifier.train_classifier(df, df, reg_params=(0.1, 0.01), vocabulary=False, size=64, select_by="MCC")
    assert [r.place for r in trained.trials.orderBy("place").collect()] == [0, 1]
    with pytest.raises(ValueError):
        classifier.token_weights(trained.model)


def test_models_go_to_tasks_from_a_session_with_tags(spark):
    df = corpus(spark, [(i, "good day" if i % 2 else "bad day", i % 2) for i in range(20)])
    spark.addTag("nightly")
    try:
        trained = classifier.train_classifier(df, df, reg_params=(0.1,))
        scored = classifier.model_scorer(trained.model)(df).repartition(2).collect()
    finally:
        spark.clearTags()
    assert all((r.p_pos > 0.5) == bool(r.label) for r in scored)


def test_word_swaps_keep_everything_else(spark):
    df = corpus(spark, [(1, "He said: \"her,  dog\" – ok", 0)])
    got = df.select(scan.swap_transforms()["gender"].alias("t")).first().t
    assert got == "she said: \"his,  dog\" – ok"


def test_perturbations(spark):
    df = corpus(spark, [(1, "it's The End", 0), (2, "a", 1), (3, "", 1)])
    transforms = scan.text_transforms()
    got = {n: [r.t for r in df.orderBy("id").select(c.alias("t")).collect()] for n, c in transforms.items()}
    assert got["upper case"][0] == "IT'S THE END" and got["title case"][0] == "It's The End"
    assert got["no punctuation"][0] == "its The End"
    assert sorted(got["typo"][0]) == sorted("it's The End") and got["typo"][1:] == ["a", ""]
    found = scan.perturbation_scan(df, classifier.word_scorer({"a": 1.0})).collect()
    assert {r.transform: r.tested for r in found}["lower case"] == 1


def test_small_expressions(spark):
    row = spark.sql("select array(1, 2, 3) a, array(1) b, 0.2D z0, 1.2D z1, array(0.5D, 0.5D) p").select(
        tx.without_ends(F.col("a")).alias("a"), tx.without_ends(F.col("b")).alias("b"),
        scores.p_positive(F.col("z0"), F.col("z1")).alias("p"), scores.arg_max(F.col("p")).alias("k"),
        scores.target_class(F.col("p"), 1).alias("t"), scores.fixed_decimals(F.col("z1"), 4).alias("f")).first()
    assert (row.a, row.b, row.k, row.t, row.f) == ([2], [], 0, 1, "1.2000")
    assert row.p == pytest.approx(1 / (1 + 2.718281828459045 ** -1.0))


def test_tokens_are_counted_without_a_shuffle(spark):
    df = corpus(spark, [(1, "b a b. c", 0), (2, "", 0), (3, None, 0), (4, "x", 0), (5, "Y y", 0)])
    counted = df.select("id", F.explode(tx.token_counts(F.col("text"))).alias("t")).select("id", "t.*")
    assert sorted(map(tuple, counted.collect())) == [(1, "a", 1), (1, "b", 2), (1, "c", 1), (4, "x", 1), (5, "y", 2)]
    # Beside a large table only tokens meet weights and sums meet rows: no text is put in order by its tokens first.
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.5), ("y", -1.0)], "token string, weight double")
    scored = classifier.score_by_table(df, weights, broadcast_rows=0)
    assert "hashpartitioning(id, token" not in scored._jdf.queryExecution().executedPlan().toString().replace("#", "").replace("L,", ",") \
        .translate({ord(c): None for c in "0123456789"})
    assert {r.id: round(r.p_pos, 6) for r in scored.collect()} == {1: 0.880797, 2: 0.5, 3: 0.5, 4: 0.5, 5: 0.119203}


def test_texts_survive_the_sample_table(spark, tmp_path):
    text = 'a\tb\\n "quoted"\r\nline\\'
    df = corpus(spark, [(1, text, 1)])
    weights = spark.createDataFrame([("a", 1.0)], "token string, weight double")
    sinks.write_attributions(attribution.explain_samples(df, weights), df, f"{tmp_path}/x")
    rows = spark.read.options(**sinks.TSV).csv(f"{tmp_path}/x/samples").collect()
    assert [r.text for r in rows] == ['a\\tb\\\\n "quoted"\\r\\nline\\\\']


def test_issue_log_lines(spark):
    log = spark.createDataFrame(
        [(1, "label", 1, 0, "NEGATIVE", 0.1, 0, 1, "x"), (1, "outlier", 2, 1, "POSITIVE", 0.25, None, None, "y")],
        "iteration int, kind string, id long, label int, label_name string, score double, given_label int, "
        "predicted_label int, text string")
    steps = spark.createDataFrame(
        [(1, "near duplicates", 9, 9, 0), (1, "labels", 9, 9, 1), (1, "outliers", 9, 8, 0)],
        "iteration int, step string, rows_in long, rows_out long, relabelled long")
    lines = [r.value for r in sinks.issue_log_lines(log, steps).orderBy(*sinks.LINE_ORDER).collect()]
    assert lines == [
        "## Iteration 1", "", "near duplicates: 9 rows -> 9 rows, 0 relabelled",
        "", "labels: 9 rows -> 9 rows, 1 relabelled", "y_true 0, y_pred 1, text: x",
        "", "outliers: 9 rows -> 8 rows, 0 relabelled",
        "", "### outlier (score 0.2500)", "label: POSITIVE (1)", "text: y"]


def test_many_regressions_in_shared_passes(spark):
    import numpy as np
    from gristmill.operators import newton

    rng = np.random.default_rng(7)
    x, fold = rng.normal(size=(400, 5)), rng.integers(1, 4, 400)
    y = (x @ rng.normal(size=5) + 0.5 + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(int(f), int(v), [float(u) for u in r]) for f, v, r in zip(fold, y, x)],
                               "fold int, label int, embedding array<double>").repartition(5)
    rows = newton.packed_rows(df)
    folds, penalties = [1, 2, 3, 1, newton.EVERY_FOLD], [0.01, 0.01, 0.01, 1.0, 0.1]
    fits = newton.fit(rows, folds, penalties, 6)
    assert (fits.gradients < 1e-8).all() and fits.passes < 12
    ones = np.hstack([x, np.ones((400, 1))])
    for w, f, c in zip(fits.weights, folds, penalties):
        mine = fold != f
        p = 1 / (1 + np.exp(-ones[mine] @ w))
        slope = ones[mine].T @ (p - y[mine]) / mine.sum() + c * np.append(w[:-1], 0.0)
        assert np.abs(slope).max() < 1e-7
    # A model without rows, and rows of one class only, end without harm.
    alone = newton.fit(newton.packed_rows(df.filter("fold = 1")), [1, 2], [0.1, 0.1], 6)
    assert np.isfinite(alone.weights).all() and (alone.weights[0] == 0).all()
    same = newton.fit(newton.packed_rows(df.filter("label = 1")), [newton.EVERY_FOLD], [0.1], 6)
    assert np.isfinite(same.weights).all() and same.weights[0, -1] > 5
