"""Exact-size samples, splits and folds.

Each one needs three reads: a count per class, the keys at the cut ranks (ids and classes
only), and one pass over the full rows that compares each row's own key with those few
cut keys. Full rows are never shuffled or sorted.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from gristmill.operators import ordering as od
from gristmill.plans.lineage import settle

MAX_CLASSES = 10_000
STRATUM = "__stratum"


def class_sizes(df: DataFrame, label: str | None) -> dict:
    """Rows per class; a single class where no label is given."""
    if label is None:
        return {0: df.count()}
    counts = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} values; it is not a class column")
    missing = sum(row["count"] for row in counts if row[label] is None)
    if missing:
        raise ValueError(f"'{label}' is missing in {missing} rows; drop or fill them first")
    return {row[label]: row["count"] for row in sorted(counts, key=lambda r: r[label])}


def largest_remainder(size: int, sizes: dict) -> dict:
    """Share ``size`` over classes in proportion; spare rows go to the largest remainders,
    on ties to the lower class."""
    total = sum(sizes.values())
    if total == 0:
        return {c: 0 for c in sizes}
    quota = {c: size * n // total for c, n in sizes.items()}
    spare = size - sum(quota.values())
    by_remainder = sorted(sizes, key=lambda c: (-(size * sizes[c] % total), c))
    for c in by_remainder[:spare]:
        quota[c] += 1
    return quota


def split_sizes(n: int, train_frac: float, valid_frac: float, test_frac: float) -> tuple[int, int, int]:
    """Train, valid and test rows: test first, then valid from the rest, both rounded up.

    Plain double arithmetic on purpose, as the rounding decides the sizes.
    """
    if not all(0.0 <= f <= 1.0 for f in (train_frac, valid_frac, test_frac)):
        raise ValueError("train, valid and test fractions must lie between 0 and 1")
    if abs(train_frac + valid_frac + test_frac - 1.0) > 1e-9:
        raise ValueError("train, valid and test fractions must sum to 1")
    if train_frac + valid_frac <= 0:
        raise ValueError("train and valid fractions are both zero")
    test = math.ceil(test_frac * n)
    rest = n - test
    valid = math.ceil(valid_frac / (train_frac + valid_frac) * rest)
    return rest - valid, valid, test


def _segment(df: DataFrame, ends: dict, label: str | None, seed: int | None, name: str, rows_in: int) -> DataFrame:
    """Add ``name``: which run of consecutive ranks a row falls into, from 0.

    ``ends`` holds, per class, the last rank of each run but the final one. Rows are in
    hash order under ``seed``, or in id order where it is None. The keys of the ``rows_in``
    rows are written once and counted, ranked and cut from there.
    """
    spark = df.sparkSession
    stratum = F.col(label) if label else F.lit(0)
    keyed = df.withColumn(STRATUM, stratum)
    if seed is not None:
        order = ["__hash", "id"]
        rows = settle(keyed.select(STRATUM, "id", od.hash_key(seed).alias("__hash"))) \
            .withColumn(od.BUCKET, od.hash_bucket(F.col("__hash"), rows_in))
        own_key = F.struct(od.hash_key(seed).alias("__hash"), F.col("id"))
    else:
        order = ["id"]
        rows = od.in_ranges(keyed.select(STRATUM, "id"), "id")
        own_key = F.struct(F.col("id"))

    type_of = dict(keyed.dtypes)[STRATUM]
    wanted = [(c, i, r) for c, ranks in ends.items() for i, r in enumerate(ranks)]
    table = spark.createDataFrame(wanted, f"{STRATUM} {type_of}, cut int, rank long")
    keys = od.keys_at_ranks(rows, table.filter("rank > 0"), STRATUM, order)
    # At most one row per class and run: a few rows, used to compare each row's own key.
    cuts = keys.groupBy(STRATUM).agg(F.map_from_entries(
        F.collect_list(F.struct("cut", "key"))).alias("keys"))
    found = cuts.toArrow()
    cuts = spark.createDataFrame(found, cuts.schema)
    runs = max(len(ranks) for ranks in ends.values())
    behind = [
        F.coalesce((own_key > F.col("keys")[F.lit(i)]).cast("int"), F.lit(1)) for i in range(runs)
    ]
    run = behind[0]
    for b in behind[1:]:
        run = run + b
    return keyed.join(F.broadcast(cuts), STRATUM, "left") \
        .withColumn(name, run).drop(STRATUM, "keys")


def simple_sample(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows without replacement."""
    return stratified_sample(df, n, seed, label=None)


def stratified_sample(df: DataFrame, n: int, seed: int = 0, label: str | None = "label") -> DataFrame:
    """Exactly ``n`` rows without replacement, class shares kept."""
    sizes = class_sizes(df, label)
    if n < 1:
        raise ValueError("a sample needs at least one row")
    if n > sum(sizes.values()):
        raise ValueError(f"cannot draw {n} rows from {sum(sizes.values())} without replacement")
    quota = largest_remainder(n, sizes)
    marked = _segment(df, {c: [q] for c, q in quota.items()}, label, seed, "__run", sum(sizes.values()))
    return marked.filter("__run = 0").drop("__run")


def _split(df: DataFrame, sizes: dict, test: int, valid: int, label: str | None, seed: int) -> DataFrame:
    test_of = largest_remainder(test, sizes)
    rest = {c: n - test_of[c] for c, n in sizes.items()}
    valid_of = largest_remainder(valid, rest)
    ends = {c: list(accumulate([test_of[c], valid_of[c]])) for c in sizes}
    marked = _segment(df, ends, label, seed, "__run", sum(sizes.values()))
    names = F.when(F.col("__run") == 0, "test").when(F.col("__run") == 1, "valid").otherwise("train")
    return marked.withColumn("split", names).drop("__run")


def split_corpus(
    df: DataFrame,
    train_frac: float = 0.6,
    valid_frac: float = 0.1,
    test_frac: float = 0.3,
    seed: int = 0,
    stratify: bool = True,
    label: str = "label",
) -> DataFrame:
    """Add ``split``: train, valid or test."""
    by = label if stratify else None
    sizes = class_sizes(df, by)
    _, valid, test = split_sizes(sum(sizes.values()), train_frac, valid_frac, test_frac)
    return _split(df, sizes, test, valid, by, seed)


def split_by_counts(
    df: DataFrame, test_share: float = 0.3, train_share: float = 0.6, seed: int = 0, label: str = "label"
) -> DataFrame:
    """As ``split_corpus``, with test and train rows truncated and the rest for validation."""
    sizes = class_sizes(df, label)
    n = sum(sizes.values())
    if not (0.0 <= test_share and 0.0 <= train_share and test_share + train_share <= 1.0):
        raise ValueError("shares must lie between 0 and 1, in sum too")
    test, train = int(test_share * n), int(train_share * n)
    return _split(df, sizes, test, n - test - train, label, seed)


def assign_folds(df: DataFrame, folds: int = 5, label: str | None = "label") -> DataFrame:
    """Add ``fold`` (from 1): consecutive, even runs of ids within each class."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    sizes = class_sizes(df, label)
    ends = {}
    for c, n in sizes.items():
        base, spare = divmod(n, folds)
        ends[c] = list(accumulate(base + (1 if i < spare else 0) for i in range(folds - 1)))
    return _segment(df, ends, label, None, "fold", sum(sizes.values())).withColumn("fold", F.col("fold") + 1)


def first_per_class(df: DataFrame, n: int = 3, label: str = "label", order: str = "id") -> DataFrame:
    """The first ``n`` rows of each class; map tasks pass on at most ``n`` each."""
    rank = F.row_number().over(Window.partitionBy(label).orderBy(order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")
