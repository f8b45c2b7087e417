"""Out-of-fold class probabilities from embeddings.

Input: id, embedding, label and fold. Output: id, fold, p (one probability per class).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from gristmill.functions.scores import dot, sigmoid, squared_distance
from gristmill.operators import newton

MODELS = "fold int, weights array<double>, bias double, penalty double"


def fold_models(df: DataFrame, regularization_c: float = 0.1, max_iter: int = 50, tol: float = 1e-8) -> DataFrame:
    """fold, weights, bias, penalty: a logistic regression per fold, fitted on the other folds.

    A penalty of 1 / (C n) on the mean loss equals the usual C on the summed loss. All
    folds are fitted together: each pass over the rows serves every model.
    """
    rows = newton.packed_rows(df)
    # One row per fold.
    facts = {r.fold: r for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.max(F.octet_length("vec")).alias("size")).collect()}
    if not facts:
        return df.sparkSession.createDataFrame([], MODELS)
    folds, total = sorted(facts), sum(r.n for r in facts.values())
    penalties = [1.0 / (regularization_c * max(1, total - facts[f].n)) for f in folds]
    fits = newton.fit(rows, folds, penalties, max(r.size for r in facts.values()) // 8, max_iter, tol)
    models = [(f, [float(v) for v in w[:-1]], float(w[-1]), c) for f, w, c in zip(folds, fits.weights, penalties)]
    return df.sparkSession.createDataFrame(models, MODELS)


def gradient_norms(df: DataFrame, models: DataFrame) -> DataFrame:
    """fold, rows (of the other folds) and the length of the penalised mean loss's gradient at the fitted weights."""
    x = F.col("embedding").cast("array<double>")
    trained = df.select("label", x.alias("x"), F.col("fold").alias("own")) \
        .join(F.broadcast(models), F.col("own") != F.col("fold"))
    miss = sigmoid(dot(F.col("x"), F.col("weights")) + F.col("bias")) - F.col("label")
    pulls = trained.select("fold", "weights", "penalty", miss.alias("miss"), F.transform("x", lambda v: v * miss).alias("pull"))
    sums = pulls.groupBy("fold").agg(
        F.count("*").alias("rows"), F.avg("miss").alias("bias_slope"), F.first("weights").alias("weights"),
        F.first("penalty").alias("penalty"), vector_to_array(Summarizer.mean(array_to_vector("pull"))).alias("slope"))
    steps = F.zip_with("slope", "weights", lambda g, w: g + F.col("penalty") * w)
    squares = F.aggregate(steps, F.lit(0.0), lambda total, v: total + v * v) + F.col("bias_slope") * F.col("bias_slope")
    return sums.select("fold", "rows", F.sqrt(squares).alias("gradient"))


def logistic_probabilities(df: DataFrame, regularization_c: float = 0.1, max_iter: int = 50) -> DataFrame:
    """All rows scored in one pass, each by the logistic regression that hasn't seen its fold."""
    weights = fold_models(df, regularization_c, max_iter)
    p = sigmoid(dot(F.col("embedding"), F.col("weights")) + F.col("bias"))
    return df.join(F.broadcast(weights), "fold").select("id", "fold", p.alias("p1")) \
        .select("id", "fold", F.array(1.0 - F.col("p1"), F.col("p1")).alias("p"))


def centroid_probabilities(df: DataFrame, sharpness: float = 4.0, classes: int = 2) -> DataFrame:
    """Softmax over minus ``sharpness`` times the squared distance to the class centroids of
    the other folds. Needs a single pass to train, so it also serves as a quick first look.
    """
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    # One row per fold and class.
    sums = df.groupBy("fold", "label").agg(
        vector_to_array(Summarizer.sum(vector)).alias("total"), F.count("*").alias("n")).collect()
    folds = sorted({r["fold"] for r in sums})
    rows = []
    for fold in folds:
        means = []
        for c in range(classes):
            other = [r for r in sums if r["label"] == c and r["fold"] != fold]
            if not other:
                raise ValueError(f"class {c} occurs in fold {fold} only")
            n = sum(r["n"] for r in other)
            means.append([sum(x) / n for x in zip(*(r["total"] for r in other))])
        rows.append((fold, means))
    centroids = df.sparkSession.createDataFrame(rows, "fold int, means array<array<double>>")
    weight = [
        F.exp(-sharpness * squared_distance(F.col("embedding"), F.col("means")[c])).alias(f"w{c}")
        for c in range(classes)
    ]
    scored = df.join(F.broadcast(centroids), "fold").select("id", "fold", *weight)
    total = sum((F.col(f"w{c}") for c in range(1, classes)), F.col("w0"))
    return scored.select("id", "fold", F.array(*[F.col(f"w{c}") / total for c in range(classes)]).alias("p"))


def check_probabilities(corpus: DataFrame, probabilities: DataFrame, classes: int = 2) -> DataFrame:
    """One row of facts: rows on both sides, keys without a partner, entries per row."""
    size = F.size("p")
    both = corpus.select("id", F.lit(1).alias("in_corpus")).join(
        probabilities.select("id", size.alias("size"), F.lit(1).alias("scored")), "id", "full")
    return both.agg(
        F.count("in_corpus").alias("corpus_rows"), F.count("scored").alias("scored_rows"),
        F.count_if(F.col("scored").isNull()).alias("unscored"),
        F.count_if(F.col("in_corpus").isNull()).alias("unknown"),
        F.min("size").alias("min_size"), F.max("size").alias("max_size"),
    ).withColumn("valid", (F.col("unscored") == 0) & (F.col("unknown") == 0)
                 & (F.col("corpus_rows") == F.col("scored_rows"))
                 & (F.col("min_size") == classes) & (F.col("max_size") == classes))


def require_probabilities(corpus: DataFrame, probabilities: DataFrame, classes: int = 2) -> None:
    facts = check_probabilities(corpus, probabilities, classes).first()
    if not facts["valid"]:
        raise ValueError(f"probabilities do not fit the corpus: {facts.asDict()}")
