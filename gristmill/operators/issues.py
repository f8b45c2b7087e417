"""Issue tables: near duplicates, label errors, outliers. A lower score is a higher risk."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from gristmill.functions.scores import arg_max
from gristmill.operators.ordering import exact_median, keys_at_tied_ranks

# Share of the median nearest distance below which two rows are near duplicates.
NEAR_DUPLICATE_SHARE = 0.13
# A row whose neighbours are 2.7 times as far as usual scores exp(-2.7).
OUTLIER_SCORE = math.exp(-2.7)
TOLERANCE = 1e-6


def near_duplicate_cutoff(neighbours: DataFrame, share: float = NEAR_DUPLICATE_SHARE) -> float:
    """``share`` of the median distance to the nearest neighbour. A median of zero leaves
    only rows at distance zero."""
    nearest = neighbours.filter(F.size("neighbours") > 0).select(F.col("neighbours")[0]["d"].alias("d"))
    median = exact_median(nearest, "d").first()["median"]
    return share * (median or 0.0)


def near_duplicate_issues(neighbours: DataFrame, cutoff: float) -> DataFrame:
    """Flags from (id, neighbours), with the nearest copies of the neighbour list to show.

    ``near_duplicate_sets`` adds the whole set of a row, however many copies it has.
    """
    nearest = F.try_element_at("neighbours", F.lit(1))["d"]
    close = F.filter("neighbours", lambda x: x["d"] <= cutoff)
    return neighbours.select(
        "id",
        (F.size(close) > 0).alias("is_near_duplicate_issue"),
        F.coalesce(1.0 - F.exp(-nearest), F.lit(1.0)).alias("near_duplicate_score"),
        F.transform(close, lambda x: x["id"]).alias("nearest_duplicates"),
        nearest.alias("distance_to_nearest_neighbor"),
    )


def near_duplicate_sets(found: DataFrame, around: DataFrame) -> DataFrame:
    """Add each row's whole set within the cutoff, by its lowest id and its size, itself included.

    ``around`` counts every row within the radius (``neighbours.within``), so a set isn't cut
    at the length of a neighbour list, and copies are never listed pair by pair.
    """
    counted = around.select("id", F.coalesce("others", F.lit(0)).alias("others"), "first_other")
    return found.join(counted, "id", "left").select(
        *found.columns, F.least("id", "first_other").alias("near_duplicate_set"),
        (F.coalesce("others", F.lit(0)) + 1).alias("near_duplicate_set_size"))


def outlier_issues(neighbours: DataFrame, threshold: float = OUTLIER_SCORE) -> DataFrame:
    """exp(-mean distance to the neighbours / its median), flagged below ``threshold``."""
    # Distances have six digits, so whole millionths add up the same in any order.
    total = F.aggregate(
        "neighbours", F.lit(0).cast("long"),
        lambda acc, x: acc + F.round(x["d"] * 1e6).cast("long"))
    mean = total / (F.size("neighbours") * F.lit(1e6))
    means = neighbours.filter(F.size("neighbours") > 0).select("id", mean.alias("mean_distance"))
    median = exact_median(means, "mean_distance").first()["median"]
    ratio = F.col("mean_distance") / F.lit(median) if median else F.when(
        F.col("mean_distance") > 0, F.lit(float("inf"))).otherwise(F.lit(1.0))
    score = F.coalesce(F.exp(-ratio), F.lit(1.0))
    scored = neighbours.select("id", F.when(F.size("neighbours") > 0, mean).alias("mean_distance"))
    return scored.select("id", (score < threshold).alias("is_outlier_issue"),
                         score.alias("outlier_score"), "mean_distance")


def _class_thresholds(scored: DataFrame, classes: int) -> Column:
    """The mean self-confidence of each class, one number per class."""
    means = scored.agg(*[
        F.avg(F.when(F.col("label") == c, F.col("p")[c])).alias(f"c{c}") for c in range(classes)]).first()
    # A class whose rows all have one probability must still reach its own mean.
    return F.array(*[F.lit(None if m is None else m - TOLERANCE).cast("double") for m in means])


def _confident_class(p: Column, thresholds: Column) -> Column:
    """The most probable class among those at or above their threshold, null if none."""
    kept = F.zip_with(p, thresholds, lambda x, t: F.when(x >= t, x).otherwise(F.lit(-1.0)))
    return F.when(F.array_max(kept) >= 0, arg_max(kept))


def label_issues(
    corpus: DataFrame, probabilities: DataFrame, classes: int = 2, rule: str = "confident"
) -> DataFrame:
    """Likely label errors by confident learning (Northcutt, Jiang and Chuang, 2021).

    ``confident``: a row is flagged when its confident class differs from its label.
    ``noise_rate``: for every pair of classes, as many rows as the calibrated counts of
    confident disagreement say, the widest margins first. Under either rule a row whose
    label is the most probable class is no error: with unequal classes the confident
    class can be the less probable one.
    """
    scored = corpus.select("id", "label").join(probabilities.select("id", "p"), "id")
    thresholds = _class_thresholds(scored, classes)
    judged = scored.select(
        "id", "label", "p", _confident_class(F.col("p"), thresholds).alias("confident"))
    if rule == "confident":
        flag = F.coalesce(F.col("confident") != F.col("label"), F.lit(False))
    elif rule == "noise_rate":
        return _noise_rate_issues(judged, classes)
    else:
        raise ValueError(f"unknown rule '{rule}'")
    return judged.select(*_label_columns(flag))


def _label_columns(flag: Column) -> list[Column]:
    return [
        F.col("id"), (flag & (arg_max(F.col("p")) != F.col("label"))).alias("is_label_issue"), F.col("p")[F.col("label")].alias("label_score"),
        F.col("label").alias("given_label"), arg_max(F.col("p")).alias("predicted_label"),
    ]


def _noise_rate_issues(judged: DataFrame, classes: int) -> DataFrame:
    spark = judged.sparkSession
    # classes x classes counts.
    joint = {(r["label"], r["confident"]): r["n"] for r in judged.groupBy("label", "confident")
             .agg(F.count("*").alias("n")).collect()}
    wanted = []
    for given in range(classes):
        rows = sum(n for (label, _), n in joint.items() if label == given)
        sure = sum(joint.get((given, c), 0) for c in range(classes))
        for other in range(classes):
            if other != given and sure:
                prune = round(joint.get((given, other), 0) * rows / sure)
                if prune:
                    wanted.append((f"{given}>{other}", 0, prune))
    flagged = None
    if wanted:
        pairs = judged.select(
            "id", F.explode(F.array(*[F.lit(c) for c in range(classes)])).alias("other"), "label", "p",
        ).filter("other <> label").select(
            F.concat_ws(">", "label", "other").alias("pair"), "id",
            (F.col("p")[F.col("label")] - F.col("p")[F.col("other")]).alias("margin"))
        cuts = keys_at_tied_ranks(pairs,
                                  spark.createDataFrame(wanted, "pair string, cut int, rank long"),
                                  "pair", "margin").select("pair", "key")
        flagged = pairs.join(F.broadcast(cuts), "pair") \
            .filter(F.struct("margin", "id") <= F.col("key")).select("id").distinct() \
            .withColumn("flagged", F.lit(True))
    if flagged is None:
        return judged.select(*_label_columns(F.lit(False)))
    return judged.join(flagged, "id", "left").select(
        *_label_columns(F.coalesce("flagged", F.lit(False))))


def quality_report(
    corpus: DataFrame, near_duplicates: DataFrame, labels: DataFrame, outliers: DataFrame
) -> DataFrame:
    """One row per issue type: rows, flagged, share, least and mean score; then missing texts
    and the share of each class."""
    def line(issues: DataFrame, name: str, flag: str, score: str) -> DataFrame:
        return issues.agg(
            F.lit(name).alias("issue"), F.count("*").alias("rows"),
            F.count_if(F.col(flag)).alias("flagged"),
            F.try_divide(F.count_if(F.col(flag)).cast("double"), F.count("*")).alias("share"),
            F.min(score).alias("min_score"), F.avg(score).alias("mean_score"))

    empty = F.lit(None).cast("double")
    missing = F.count_if(F.col("text").isNull())
    per_class = corpus.groupBy("label").agg(
        F.count("*").alias("flagged"), F.count_if(F.col("text").isNull()).alias("missing"))
    total = F.sum("flagged").over(Window.partitionBy(F.lit(0)))
    classes = per_class.select(
        F.concat(F.lit("class "), F.col("label")).alias("issue"), total.alias("rows"), "flagged",
        (F.col("flagged").cast("double") / total).alias("share"),
        empty.alias("min_score"), empty.alias("mean_score"))
    nulls = corpus.agg(
        F.lit("missing text").alias("issue"), F.count("*").alias("rows"), missing.alias("flagged"),
        F.try_divide(missing.cast("double"), F.count("*")).alias("share"),
        empty.alias("min_score"), empty.alias("mean_score"))
    return (
        line(near_duplicates, "near_duplicate", "is_near_duplicate_issue", "near_duplicate_score")
        .unionByName(line(labels, "label", "is_label_issue", "label_score"))
        .unionByName(line(outliers, "outlier", "is_outlier_issue", "outlier_score"))
        .unionByName(nulls).unionByName(classes)
    )


def worst(issues: DataFrame, flag: str, score: str, n: int = 10) -> DataFrame:
    """The flagged rows at highest risk."""
    return issues.filter(F.col(flag)).orderBy(F.asc(score), F.asc("id")).limit(n)


def mildest(issues: DataFrame, flag: str, score: str, n: int = 10) -> DataFrame:
    """The flagged rows at lowest risk."""
    return issues.filter(F.col(flag)).orderBy(F.desc(score), F.desc("id")).limit(n)
