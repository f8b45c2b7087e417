"""Connected components over a table of links, by alternating large and small stars.

Every round replaces links by links to smaller neighbours; no neighbour list is ever gathered,
only a minimum per node. It ends when a round changes nothing, after a number of
rounds that grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from gristmill.plans.lineage import settle


def _settled(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written, with their number and two sums of hashes, taken while writing."""
    # A changed link passes unseen only if two sums of 64-bit hashes agree by chance.
    seen = Observation()
    sums = [F.sum(F.xxhash64(F.lit(seed), "a", "b").cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
    out = settle(links.observe(seen, F.count("*").alias("n"), *sums))
    return out, (seen.get["n"], seen.get["h1"], seen.get["h2"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node that has a link.

    ``links`` has ``a`` and ``b`` of one orderable type; loops and repeats do no harm. Roots
    are in the result too.
    """
    now, state = _settled(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b") \
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        before = state
        now, state = _settled(small)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
