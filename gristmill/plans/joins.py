"""Joins where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gristmill.plans.lineage import small_side

# A key with more rows than this is dealt out over several tasks.
HOT_ROWS = 100_000
# A key with more than this share of the rows is joined by broadcast. At most 1 / share keys can have it.
FREQUENT = 1e-3
PART = "__part"


def hot_join(
    left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, how: str = "inner",
    deal_by: str = "id",
) -> DataFrame:
    """Join ``left`` with ``right`` (one row per key), salting just the hot keys of ``left``.

    ``counts`` has the keys and ``n``, the rows each key has on the left. A hot key's rows
    are dealt by ``deal_by`` into parts of about ``HOT_ROWS``, and its right row is repeated
    once per part. The table of hot keys is broadcast where it is measured to be small, and
    joined in the ordinary way where not.
    """
    parts = F.ceil(F.col("n") / HOT_ROWS).cast("int")
    hot = small_side(counts.filter(F.col("n") > HOT_ROWS).select(*keys, parts.alias("parts")))
    n_parts = F.coalesce("parts", F.lit(1))
    dealt = left.join(hot, keys, "left") \
        .withColumn(PART, F.pmod(F.xxhash64(deal_by), n_parts).cast("int")).drop("parts")
    repeated = right.join(hot, keys, "left") \
        .withColumn(PART, F.explode(F.sequence(F.lit(0), n_parts - 1))).drop("parts")
    return dealt.join(repeated, [*keys, PART], how).drop(PART)


def frequent_keys(df: DataFrame, key: str, share: float = FREQUENT) -> DataFrame:
    """Every key with more than ``share`` of the rows, and perhaps others; at most ``1 / share`` rows.

    One pass with a frequent-items sketch of bounded size, merged on its way; it misses no such key.
    """
    found = df.select(key).filter(F.col(key).isNotNull()).stat.freqItems([key], share)
    return found.select(F.explode(f"{key}_freqItems").alias(key)).limit(int(1 / share))


def frequent_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = FREQUENT) -> DataFrame:
    """Join ``left`` with ``right`` (one row per key, of any size) where few keys hold most of ``left``, as words do.

    Frequent keys meet their right rows by broadcast and never move. What is left is shuffled, and there no key
    has more than ``share`` of the rows. ``left`` is read three times: settle it if it is costly.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    # Bounded by 1 / share rows, whatever the tables' sizes.
    keys = F.broadcast(small_side(frequent_keys(left, key, share), int(1 / share)))
    hot = left.join(F.broadcast(right.join(keys, key, "left_semi")), key, how)
    if how == "left":
        hot = hot.join(keys, key, "left_semi")
    rest = left.join(keys, key, "left_anti").join(right, key, how)
    return hot.unionByName(rest)
