"""Training and scoring queries."""

import uuid

from pyspark.sql import Window, functions as F

from gristmill.catalog import cleaning, inputs, sampling as sampled
from gristmill.functions import text as tx
from gristmill.operators import classifier, label_model, metrics, sampling, training_path
from gristmill.plans import workflow
from gristmill.plans.lineage import settle, shared_dir
from gristmill.sources.stages import read_stage
from gristmill.streaming import scoring

SCORER = classifier.word_scorer(inputs.WORD_WEIGHTS, inputs.INTERCEPT)


def _result(scored):
    return scored.select("id", F.round("p_pos", 6).alias("p_pos"), "pred", "label_name")


def tokenize(spark, sf):
    tokens = classifier.tokenize(inputs.texts(spark, sf))
    return tokens.select("id", F.size("tokens").alias("tokens"),
                         F.md5(F.array_join("tokens", " ")).alias("digest"))


def tokenize_cut(spark, sf):
    """At most 512 tokens of each text, the input size of the models the job stands in for."""
    tokens = classifier.tokenize(inputs.texts(spark, sf), max_tokens=512)
    return tokens.select("id", F.size("tokens").alias("tokens"),
                         F.md5(F.array_join("tokens", " ")).alias("digest"))


def score_by_table(spark, sf):
    weights = spark.createDataFrame(list(inputs.WORD_WEIGHTS.items()), "token string, weight double")
    return _result(classifier.score_texts(
        inputs.texts(spark, sf), lambda df: classifier.score_by_table(df, weights, inputs.INTERCEPT)))


def score_by_table_large(spark, sf):
    """The same scores as beside a weight table too large to broadcast."""
    weights = spark.createDataFrame(list(inputs.WORD_WEIGHTS.items()), "token string, weight double")
    return _result(classifier.score_texts(inputs.texts(spark, sf), lambda df: classifier.score_by_table(
        df, weights, inputs.INTERCEPT, broadcast_rows=0)))


def oof_logreg_probs(spark, sf):
    rows = settle(sampling.assign_folds(inputs.noisy(spark, sf)))
    return label_model.logistic_probabilities(rows).select(
        "id", "fold", F.col("p")[0].alias("p0"), F.col("p")[1].alias("p1"))


def oof_logreg_fits(spark, sf):
    """Per fold: rows learned from, and whether the fit is an optimum of its penalised loss."""
    rows = settle(sampling.assign_folds(inputs.noisy(spark, sf)))
    found = label_model.gradient_norms(rows, label_model.fold_models(rows))
    return found.select("fold", "rows", (F.col("gradient") < 1e-3).alias("optimal"))


def oof_logreg_rows(spark, sf):
    """Per row: its fold, and whether its probabilities are some and sum to one."""
    rows = settle(sampling.assign_folds(inputs.noisy(spark, sf)))
    p = label_model.logistic_probabilities(rows)
    fine = (F.abs(F.col("p")[0] + F.col("p")[1] - 1.0) < 1e-12) & F.col("p")[1].between(0.0, 1.0)
    return p.select("id", "fold", fine.alias("fine"))


def train_test_rows(spark, sf):
    """The scored test rows: their prediction is what their probability says."""
    scored = train_select_score(spark, sf)
    return scored.select("id", "label", (F.col("pred") == (F.col("p_pos") >= 0.5).cast("int")).alias("consistent"))


def train_converged(spark, sf):
    """Per penalty: whether the fit ended before the iteration guard, with finite validation loss."""
    return _trained(spark, sf)[1].trials.select(
        "place", "reg_param", ((F.col("iterations") < 200) & (F.col("log_loss") < 10.0)).alias("converged"))


def saved_model_scores(spark, sf):
    """All documents scored by the trained model and by the same model saved and loaded."""
    path = f"{shared_dir(spark)}/gristmill-model-{uuid.uuid4().hex}"
    _, trained = _trained(spark, sf)
    classifier.save_model(trained.model, f"{path}/model")
    texts = inputs.texts(spark, sf)
    first = classifier.score_texts(texts, classifier.model_scorer(trained.model)).select("id", F.col("p_pos").alias("first"))
    again = workflow.run_inference(spark, path, texts).select("id", F.col("p_pos").alias("again"), "pred")
    return first.join(again, "id").select(
        "id", (F.col("first") == F.col("again")).alias("same"), (F.col("pred") == (F.col("again") >= 0.5).cast("int")).alias("consistent"))


def full_run_stages(spark, sf):
    """Rows of the stages of a whole run with the fitted prober, and what later stages owe to earlier ones."""
    base = f"{shared_dir(spark)}/gristmill-run-{uuid.uuid4().hex}"
    workflow.run_all(inputs.reviews(spark, sf), base, workflow.Settings(keep_near_duplicates="first", reg_params=(0.01, 0.1)))
    read = lambda name: read_stage(spark, base, name)
    raw, cleaned, fixed, splits, scored = map(read, ("raw_preview", "clean", "quality_fixed", "splits", "scored"))
    rows = lambda df: df.count()
    flips = cleaned.select("id", F.col("label").alias("before")).join(fixed.select("id", "label"), "id").filter("before <> label").count()
    steps = {r["step"]: r for r in read("quality_steps").collect()}
    facts = [
        ("raw_preview", rows(raw), True), ("clean", rows(cleaned), True),
        ("quality steps join up", 0, steps["outliers"]["rows_out"] == rows(fixed) and steps["near duplicates"]["rows_in"] == rows(cleaned)),
        ("relabelled rows are logged flips", 0, flips <= steps["labels"]["relabelled"]),
        ("fixed rows come from clean ones", 0, rows(fixed.join(cleaned, "id", "left_anti")) == 0),
        ("splits hold every fixed row once", 0, rows(splits) == rows(fixed) == splits.select("id").distinct().count()),
        ("scored rows are the test rows", 0, rows(scored.join(splits.filter("split = 'test'"), "id")) == rows(scored)
         == rows(splits.filter("split = 'test'"))),
    ]
    return spark.createDataFrame(facts, "stage string, rows long, holds boolean")


def _trained(spark, sf):
    splits = settle(sampling.split_corpus(inputs.corpus(spark, sf, per_token=True)))
    trained = classifier.train_classifier(
        splits.filter("split = 'train'"), splits.filter("split = 'valid'"))
    return splits, trained


def train_select_score(spark, sf):
    splits, trained = _trained(spark, sf)
    test = splits.filter("split = 'test'").select("id", "text", "label")
    return classifier.score_texts(test, classifier.model_scorer(trained.model)).drop("text")


def train_trials(spark, sf):
    return _trained(spark, sf)[1].trials


def train_evaluate(spark, sf):
    return metrics.evaluate(settle(train_select_score(spark, sf)))


def _path(spark, sf, folder, steps):
    splits = settle(sampling.split_corpus(inputs.corpus(spark, sf, per_token=True)))
    valid = splits.filter("split = 'valid'")
    # More patience than steps: the queries look at a path of a set length.
    return training_path.train_path(splits.filter("split = 'train'"), valid, folder, max_steps=steps, patience=steps + 1), valid


def _path_folder(spark):
    return f"{shared_dir(spark)}/gristmill-path-{uuid.uuid4().hex}"


def train_path_dictionary(spark, sf):
    """Every token that varies over the training rows, its number and the documents that hold it."""
    folder = _path_folder(spark)
    _path(spark, sf, folder, 1)
    return spark.read.parquet(f"{folder}/dictionary").select("slot", "token", "documents")


def train_path_first_steps(spark, sf):
    """What the first two steps of the path give on training and validation rows, for every penalty."""
    found, _ = _path(spark, sf, _path_folder(spark), 1)
    return found.steps.select("step", "place", "reg_param", *[
        F.round(c, 6).alias(c) for c in ("train_loss", "penalised", "log_loss", "MCC")])


def train_path_best(spark, sf):
    """A path broken off after two steps and taken up again: the weights it returns are those of its best step."""
    folder = _path_folder(spark)
    _path(spark, sf, folder, 2)
    found, valid = _path(spark, sf, folder, 6)
    scored = classifier.score_by_table(valid, found.weights, found.intercept)
    again = metrics.log_loss(scored).scalar()
    lowest = F.min("log_loss")
    steps = found.steps.withColumn("before", F.min(F.when(F.col("accepted"), F.col("penalised"))).over(
        Window.partitionBy("place").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)))
    facts = steps.agg(
        F.count_distinct("step").alias("steps"), F.count_distinct("place").alias("penalties"),
        (F.abs(lowest - F.max(F.when((F.col("step") == found.step) & (F.col("place") == found.place), F.col("log_loss")))) == 0).alias("lowest"),
        (F.count_if(F.col("accepted") & (F.col("penalised") > F.col("before"))) == 0).alias("falls"), lowest.alias("best"))
    return facts.withColumn("same", F.abs(F.col("best") - again) < 1e-9).drop("best") \
        .crossJoin(scored.agg(F.count("*").alias("valid_rows")))


def stream_score(spark, sf):
    """All documents as a stream of files, cleaned and scored into a folder."""
    base = f"{shared_dir(spark)}/gristmill-stream-{uuid.uuid4().hex}"
    # As a pattern, so that it may be one file or a folder of files: a stream's plain path must be a folder.
    texts = scoring.read_texts(spark, f"{sf}/document[s].parquet", id_col="doc_id")
    scoring.score_stream(texts, SCORER, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _result(spark.read.parquet(f"{base}/out"))


def full_run(spark, sf):
    """Load to explain over the labelled documents; the metrics of the test rows."""
    base = f"{shared_dir(spark)}/gristmill-run-{uuid.uuid4().hex}"
    settings = workflow.Settings(sample_size=None, keep_near_duplicates="first", reg_params=(0.01, 0.1))
    return workflow.run_all(inputs.reviews(spark, sf), base, settings)


QUERIES = {
    "tokenize": tokenize,
    "tokenize_cut": tokenize_cut,
    "batch_score": lambda spark, sf: _result(classifier.score_texts(inputs.texts(spark, sf), SCORER)),
    "score_by_table": score_by_table,
    "score_by_table_large": score_by_table_large,
    "oof_logreg_probs": oof_logreg_probs,
    "oof_logreg_fits": oof_logreg_fits,
    "oof_logreg_rows": oof_logreg_rows,
    "train_test_rows": train_test_rows,
    "train_converged": train_converged,
    "saved_model_scores": saved_model_scores,
    "full_run_stages": full_run_stages,
    "train_select_score": train_select_score,
    "train_trials": train_trials,
    "train_evaluate": train_evaluate,
    "train_path_dictionary": train_path_dictionary,
    "train_path_first_steps": train_path_first_steps,
    "train_path_best": train_path_best,
    "stream_score": stream_score,
    "full_run": full_run,
}

_DOCS = "docs AS (SELECT doc_id AS id, text FROM documents)"
_TERMS = "(?i)(" + "|".join(tx.BOILERPLATE_TERMS) + ")"
SPACES = "concat(" + ", ".join(f"chr({ord(c)})" for c in tx.WHITE_SPACE) + ")"
_SCORES = """SELECT id, round(p_pos, 6) AS p_pos, CAST(p_pos >= 0.5 AS INTEGER) AS pred,
  CASE WHEN p_pos >= 0.5 THEN 'positive' ELSE 'negative' END AS label_name FROM word_scored"""

# Counts over their standard deviation, then one step of unit length down the gradient at zero.
_PATH = f"""WITH {inputs.CORPUS}, marked AS ({sampled.SQL['split_corpus']}),
docs AS (SELECT c.id, c.text, c.label, split = 'train' AS learns FROM marked JOIN corpus c USING (id) WHERE split IN ('train', 'valid')),
size AS (SELECT CAST(count_if(learns) AS DOUBLE) AS train, CAST(count_if(NOT learns) AS DOUBLE) AS valid FROM docs),
entries AS (SELECT id, label, learns, token, count(*) AS n
  FROM (SELECT id, label, learns, unnest({inputs.TOKEN_LIST}) AS token FROM docs) GROUP BY id, label, learns, token),
counted AS (SELECT token, count(*) AS documents,
    sqrt((CAST(sum(n * n) AS DOUBLE) - any_value(train) * pow(sum(n) / any_value(train), 2)) / (any_value(train) - 1)) AS spread
  FROM entries, size WHERE learns GROUP BY token),
words AS (SELECT * FROM counted WHERE spread > 1e-9)"""
_PATH_STEPS = _PATH + """,
x AS (SELECT id, label, learns, token, n / spread AS x FROM entries JOIN words USING (token)
  UNION ALL SELECT id, label, learns, '', 1.0 FROM docs),
slopes AS (SELECT token, coalesce(sum((0.5 - label) * x) FILTER (learns), 0) / any_value(train) AS g FROM x, size GROUP BY token),
weights AS (SELECT token, -g / sqrt((SELECT sum(g * g) FROM slopes)) AS w FROM slopes),
points AS (SELECT id, label, learns, sum(x * w) AS z FROM x JOIN weights USING (token) GROUP BY id, label, learns
  ),
judged AS (SELECT 1 AS step, label, learns, z FROM points UNION ALL SELECT 0, label, learns, 0.0 FROM docs),
losses AS (SELECT step, learns, label, z >= 0 AS says, greatest(z, 0) + ln(1 + exp(-abs(z))) - label * z AS loss FROM judged),
facts AS (SELECT step, avg(loss) FILTER (learns) AS train_loss, avg(loss) FILTER (NOT learns) AS log_loss,
    CAST(count_if(NOT learns AND says AND label = 1) AS DOUBLE) AS tp, CAST(count_if(NOT learns AND says AND label = 0) AS DOUBLE) AS fp,
    CAST(count_if(NOT learns AND NOT says AND label = 1) AS DOUBLE) AS fn,
    CAST(count_if(NOT learns AND NOT says AND label = 0) AS DOUBLE) AS tn
  FROM losses GROUP BY step),
held AS (SELECT sum(w * w) AS squares FROM weights WHERE token <> '')
SELECT CAST(step AS INTEGER) AS step, place, reg_param, round(train_loss, 6) AS train_loss,
  round(train_loss + 0.5 * reg_param * step * squares, 6) AS penalised, round(log_loss, 6) AS log_loss,
  round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0
    THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0 END, 6) AS "MCC"
FROM facts, held, (VALUES (0, CAST(0.001 AS DOUBLE)), (1, CAST(0.01 AS DOUBLE)), (2, CAST(0.1 AS DOUBLE))) p(place, reg_param)"""

SQL = {
    "train_path_dictionary": _PATH + """
SELECT row_number() OVER (ORDER BY token) AS slot, token, documents FROM words""",
    "train_path_first_steps": _PATH_STEPS,
    "train_path_best": f"""SELECT 7 AS steps, 3 AS penalties, true AS lowest, true AS falls, true AS same, count(*) AS valid_rows
FROM ({sampled.SQL['split_corpus']}) WHERE split = 'valid'""",
    "oof_logreg_fits": f"""WITH {inputs.NOISY},
folds AS (SELECT CAST(ntile(5) OVER (PARTITION BY label ORDER BY id) AS INTEGER) AS fold FROM noisy)
SELECT f.fold, count(*) AS rows, true AS optimal FROM (SELECT DISTINCT fold FROM folds) f
JOIN folds o ON o.fold <> f.fold GROUP BY f.fold""",
    "oof_logreg_rows": f"""WITH {inputs.NOISY}
SELECT id, CAST(ntile(5) OVER (PARTITION BY label ORDER BY id) AS INTEGER) AS fold, true AS fine FROM noisy""",
    "train_test_rows": f"SELECT id, label, true AS consistent FROM ({sampled.SQL['split_corpus']}) WHERE split = 'test'",
    "train_converged": """SELECT * FROM (VALUES (0, CAST(0.001 AS DOUBLE), true), (1, CAST(0.01 AS DOUBLE), true),
  (2, CAST(0.1 AS DOUBLE), true)) t(place, reg_param, converged)""",
    "saved_model_scores": "SELECT doc_id AS id, true AS same, true AS consistent FROM documents",
    "full_run_stages": f"""WITH {inputs.REVIEWS}, cleaned AS ({cleaning.SQL['clean_reviews']})
SELECT 'raw_preview' AS stage, count(*) AS rows, true AS holds FROM reviews
UNION ALL SELECT 'clean', count(*), true FROM cleaned
UNION ALL SELECT unnest(['quality steps join up', 'relabelled rows are logged flips', 'fixed rows come from clean ones',
  'splits hold every fixed row once', 'scored rows are the test rows']), 0, true""",
    "tokenize": f"""SELECT id, CAST(len(tokens) AS INTEGER) AS tokens, md5(array_to_string(tokens, ' ')) AS digest
FROM (SELECT doc_id AS id, {inputs.TOKEN_LIST} AS tokens FROM documents)""",
    "tokenize_cut": f"""SELECT id, CAST(len(tokens) AS INTEGER) AS tokens, md5(array_to_string(tokens, ' ')) AS digest
FROM (SELECT doc_id AS id, list_slice({inputs.TOKEN_LIST}, 1, 512) AS tokens FROM documents)""",
    "batch_score": f"WITH {_DOCS}, {inputs.WEIGHTS}, {inputs.word_scores('docs')} {_SCORES}",
    "score_by_table": f"WITH {_DOCS}, {inputs.WEIGHTS}, {inputs.word_scores('docs')} {_SCORES}",
    "score_by_table_large": f"WITH {_DOCS}, {inputs.WEIGHTS}, {inputs.word_scores('docs')} {_SCORES}",
    "stream_score": f"""WITH stripped AS (SELECT doc_id AS id, lower(trim(text, {SPACES})) AS text FROM documents),
kept AS (SELECT * FROM stripped WHERE NOT regexp_full_match(text, '{_TERMS}') AND length(text) >= 1),
{inputs.WEIGHTS}, {inputs.word_scores('kept')} {_SCORES}""",
}
