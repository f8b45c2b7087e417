"""A linear text classifier: tokenise, train, choose, score.

With a weight for every token, fits and weights are tables; with a bounded number of features they are MLlib's.

A scorer, here and in the scans, is a function that adds ``p_pos`` to a table with a
``text`` column and keeps its other columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gristmill.functions import text as tx
from gristmill.functions.scores import predicted, sigmoid
from gristmill.operators import metrics, optimum
from gristmill.plans.joins import frequent_join
from gristmill.plans.lineage import exists, remove, settle, small_side, without_summary

Scorer = Callable[[DataFrame], DataFrame]
MAP_WORDS = 200


def tokenize(corpus: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Add ``tokens``. Whole texts by default; a limit is for models that need one."""
    tokens = tx.tokens(F.col("text"))
    return corpus.withColumn("tokens", tokens if max_tokens is None else tx.cut(tokens, max_tokens))


HASHED_SIZE = 1 << 18


def feature_stages(vocabulary: bool = True, size: int | None = None, min_documents: float = 1.0) -> list:
    """MLlib's stages for a bounded number of features: the ``size`` most frequent tokens, or all tokens hashed into ``size``.

    Hashing needs no pass to fit and no list of tokens in the driver. A weight for every token, which is the default of
    ``train_classifier``, needs neither.
    """
    counts = (
        CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=size, minDF=min_documents)
        if vocabulary else HashingTF(inputCol="tokens", outputCol="counts", numFeatures=size or HASHED_SIZE))
    return [
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=tx.TOKEN_BREAK, toLowercase=True),
        counts,
        IDF(inputCol="counts", outputCol="features"),
    ]


@dataclass(frozen=True)
class TableModel:
    """A weight per occurrence of each token, as a table (token, weight) of any size, and the intercept."""

    weights: DataFrame
    intercept: float


@dataclass(frozen=True)
class Trained:
    model: TableModel | PipelineModel
    trials: DataFrame    # grid position, regularisation, MCC and log loss on the validation rows, iterations


def train_classifier(
    train: DataFrame,
    valid: DataFrame,
    reg_params: tuple[float, ...] = (0.001, 0.01, 0.1),
    max_iter: int = 200,
    select_by: str = "log_loss",
    parallel_fits: int = 4,
    **features,
) -> Trained:
    """Fit one model per penalty and keep the best on the validation rows.

    ``select_by`` is ``log_loss`` or ``MCC``; ties go to the earlier penalty. ``max_iter`` only guards against a fit that
    doesn't end. By default every token gets a weight, and all fits share each pass over the rows; nothing as long as the vocabulary is in the driver. With
    ``size`` or ``vocabulary=False`` there is a bounded number of features, and fits run in MLlib side by side.
    """
    if select_by not in ("log_loss", "MCC"):
        raise ValueError(f"cannot select by '{select_by}'")
    spark = train.sparkSession
    if features.get("vocabulary", True) and features.get("size") is None:
        fits = optimum.fit(train, reg_params, max_iter, min_documents=features.get("min_documents", 1.0))
        judged = optimum.scored(valid, fits)
        trials = [_trial(place, reg, judged.select("label", F.col("p")[place].alias("p_pos")), fits.iterations[place])
                  for place, reg in enumerate(reg_params)]
        best = _best(trials, select_by)
        model = TableModel(fits.weights.select("token", F.col("w")[best].alias("weight")), fits.intercepts[best])
    else:
        model, trials = _train_bounded(train, valid, reg_params, max_iter, select_by, parallel_fits, features)
    return Trained(model, spark.createDataFrame(
        trials, "place int, reg_param double, MCC double, log_loss double, iterations int"))


def _trial(place: int, reg: float, scored: DataFrame, iterations: int) -> tuple:
    facts = metrics.confusion_metrics(scored).select("MCC").withColumn("log_loss", metrics.log_loss(scored).scalar()).first()
    return place, float(reg), facts["MCC"], facts["log_loss"], iterations


def _best(trials: list[tuple], select_by: str) -> int:
    return min(trials, key=lambda t: (t[3] if select_by == "log_loss" else -t[2], t[0]))[0]


def _train_bounded(train, valid, reg_params, max_iter, select_by, parallel_fits, features) -> tuple[PipelineModel, list[tuple]]:
    """Texts are tokenised once, features are fitted once. Fits end at MLlib's tolerance."""
    tokenizer, *learned = feature_stages(**features)

    def tokenised(split):
        return settle(tokenizer.transform(split).select("id", F.col("label").cast("double").alias("label"), "tokens"))

    train_tokens, valid_tokens = tokenised(train), tokenised(valid)
    fitted = Pipeline(stages=learned).fit(train_tokens)

    def vectorised(split):
        return fitted.transform(split).select("id", "label", "features").persist(StorageLevel.MEMORY_AND_DISK)

    train_rows, valid_rows = vectorised(train_tokens), vectorised(valid_tokens)

    def fit(trial):
        place, reg = trial
        found = LogisticRegression(regParam=reg, elasticNetParam=0.0, maxIter=max_iter,
                                   family="binomial").fit(train_rows)
        model = without_summary(train.sparkSession, found)
        scored = model.transform(valid_rows).select(
            F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("p_pos"))
        return model, _trial(place, reg, scored, found.summary.totalIterations)

    try:
        with ThreadPool(min(parallel_fits, len(reg_params))) as pool:
            models, trials = zip(*pool.map(fit, enumerate(reg_params)))
    finally:
        train_rows.unpersist()
        valid_rows.unpersist()
    return PipelineModel(stages=[tokenizer, *fitted.stages, models[_best(trials, select_by)]]), list(trials)


def model_scorer(model: TableModel | PipelineModel) -> Scorer:
    """Row by row: no shuffle, and it works on streams."""
    if isinstance(model, TableModel):
        return _table_scorer(model)

    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).select(
            *df.columns, vector_to_array("probability")[1].alias("p_pos"))
    return score


def _table_scorer(model: TableModel) -> Scorer:
    """Tasks get a sorted hash of each token and its weight, 16 bytes a token and no strings.

    Hashes of the model's tokens all differ: another seed is taken where two don't.
    """
    spark, seed = model.weights.sparkSession, 0
    while True:
        table = model.weights.select(F.xxhash64(F.lit(seed), "token").alias("key"), "weight").toArrow()
        keys, weights = (table.column(c).to_numpy() for c in ("key", "weight"))
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
        if (keys[1:] != keys[:-1]).all():
            break
        seed += 1
    sent, intercept = spark.sparkContext.broadcast((keys, weights)), model.intercept

    def score(found: pa.Array) -> pa.Array:
        known, weights = sent.value
        row = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        key = found.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        place = np.searchsorted(known, key)
        met = place < len(known)
        met[met] = known[place[met]] == key[met]
        logit = intercept + np.bincount(row[met], weights[place[met]], len(found))
        with np.errstate(over="ignore"):
            return pa.array(1.0 / (1.0 + np.exp(-logit)))

    p_pos = F.arrow_udf(score, "double")
    return lambda df: df.withColumn("p_pos", p_pos(F.transform(tx.tokens(F.col("text")), lambda t: F.xxhash64(F.lit(seed), t))))


def outside_scorer(make_predict, batch_size: int = 64) -> Scorer:
    """Any loaded text model as a scorer. ``make_predict`` runs once per Python worker and
    returns a function from an array of texts to an array of positive-class probabilities."""
    predict = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size)
    return lambda df: df.withColumn("p_pos", predict("text"))


def word_scorer(weights: dict[str, float], intercept: float = 0.0) -> Scorer:
    """Linear scorer over a short word list, as one expression per row."""
    if len(weights) > MAP_WORDS:
        raise ValueError(f"more than {MAP_WORDS} words; use score_by_table")

    def score(df: DataFrame) -> DataFrame:
        table = F.create_map(*[F.lit(x) for item in weights.items() for x in item])
        logit = F.aggregate(
            tx.tokens(F.col("text")), F.lit(0.0),
            lambda acc, t: acc + F.coalesce(F.try_element_at(table, t), F.lit(0.0)))
        return df.withColumn("p_pos", sigmoid(logit + F.lit(float(intercept))))
    return score


def score_by_table(
    df: DataFrame, weights: DataFrame, intercept: float = 0.0, key: str = "id", broadcast_rows: int = 300_000,
) -> DataFrame:
    """Linear scoring with a weight table (token, weight) of any size.

    Beside a table measured to be small, weights are summed per text before the one shuffle. Beside a
    larger one tokens are counted inside each row; the frequent ones meet their weights by broadcast, the rest by shuffle.
    """
    table = weights.select("token", "weight")
    side = small_side(table, broadcast_rows)
    if side is not table:
        placed = df.select(key, F.explode(tx.tokens(F.col("text"))).alias("token"))
        totals = placed.join(side, "token").groupBy(key).agg(F.sum("weight").alias("total"))
    else:
        counted = df.select(key, F.explode(tx.token_counts(F.col("text"))).alias("found")).select(key, "found.token", "found.n")
        totals = frequent_join(counted, table, "token").groupBy(key).agg(F.sum(F.col("n") * F.col("weight")).alias("total"))
    return df.join(totals, key, "left").withColumn(
        "p_pos", sigmoid(F.coalesce("total", F.lit(0.0)) + F.lit(float(intercept)))).drop("total")


def score_texts(df: DataFrame, scorer: Scorer) -> DataFrame:
    """Add p_pos, pred and the label name."""
    return scorer(df).withColumn("pred", predicted(F.col("p_pos"))).withColumn(
        "label_name", F.lower(tx.label_name(F.col("pred"))))


def token_weights(model: TableModel | PipelineModel) -> tuple[DataFrame, float]:
    """(token, weight) of a model with a weight per token, and the intercept."""
    if isinstance(model, TableModel):
        return model.weights, model.intercept
    _, counts, idf, regression = model.stages
    if not hasattr(counts, "vocabulary"):
        raise ValueError("hashed features share weights between tokens; train with vocabulary=True")
    spread = idf.idf.toArray() * regression.coefficients.toArray()
    rows = [(token, float(w)) for token, w in zip(counts.vocabulary, spread)]
    table = SparkSession.active().createDataFrame(rows, "token string, weight double")
    return table, float(regression.intercept)


def save_model(model: TableModel | PipelineModel, path: str) -> None:
    if not isinstance(model, TableModel):
        model.write().overwrite().save(path)
        return
    spark = model.weights.sparkSession
    remove(spark, path)
    model.weights.write.parquet(f"{path}/weights")
    # Written last: a model without it doesn't count.
    spark.createDataFrame([(model.intercept,)], "intercept double").coalesce(1).write.parquet(f"{path}/intercept")


def load_model(path: str) -> TableModel | PipelineModel:
    spark = SparkSession.active()
    if not exists(spark, f"{path}/intercept/_SUCCESS"):
        return PipelineModel.load(path)
    return TableModel(spark.read.schema("token string, weight double").parquet(f"{path}/weights"),
                      spark.read.parquet(f"{path}/intercept").first().intercept)
