"""Mix sources to target weights by words.

Sources share ``share`` times all words by weight. No target may pass ``cap`` times its source's
words; the excess is shared again, by weight, until none is above. A source's budget is
its target rounded down. Whole epochs of the source are taken first. For the rest, documents
stand in the order of a random key (a digest of seed, id and text): the key range is cut into
buckets, words are summed per bucket, buckets get their offset, and inside a bucket a
running sum gives every document the words before it. The document at the cut gives just the
words that fill the budget.

No window spans a source: a bucket holds about ``bucket_rows`` rows whatever the source, and the
rank of a source's name is found from range partitions.

Null text has no words. A null source is a source of its own, last in order. Words of all rows
count, rows with equal ids too (their texts tell them apart, and equal rows
are interchangeable). No words at all: all targets are zero. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gristmill.llm.common import with_row
from gristmill.plans.lineage import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2.0
BUCKET_ROWS = 4_096


def sized(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """row, id, check, source, size and the random key of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # With the text in it, rows that share an id, or have none, still spread over the key range.
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return with_row(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("check"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(label).alias("key")))


def ranked_sources(rows: DataFrame) -> DataFrame:
    """source, source_size and its rank by code point from 0, null last."""
    order = F.col("source").asc_nulls_last()
    sources = settle(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        .repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    # One row per range partition.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sources.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return sources.withColumn("inside", inside).join(offsets, "part").select(
        "source", "source_size", (F.col("ahead") + F.col("inside") - 1).alias("rank"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target."""
    if not weights or min(weights) <= 0 or share < 0 or cap < share:
        raise ValueError("weights must be positive and the share within the cap")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = settle(ranked_sources(rows).withColumn("weight", weight))
    limit = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, capped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > limit
        now = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
            F.count_if(above).alias("capped")).first()
        if now.capped == capped or not now.open:
            return sources.select(
                "source", "source_size", F.when(above, limit).otherwise(F.lit(level) * F.col("weight")).alias("target"))
        level, capped = (total - now.held) / now.open, now.capped


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    seed: int = 0, bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document: id, check (hash of its text), source, size, source_size, target, taken."""
    rows = settle(sized(docs, seed, id_col, text_col, source_col))
    buckets = max(1, -(-rows.count() // bucket_rows))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    placed = rows.withColumn("bucket", F.floor(place * buckets).cast("long"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("own")).select(
        "source", "bucket", F.coalesce(F.sum("own").over(ahead), F.lit(0)).alias("offset"))
    facts = targets(rows, weights, share, cap).withColumnRenamed("source", "s")
    told = sums.join(facts, F.col("source").eqNullSafe(F.col("s"))).drop("s") \
        .withColumnsRenamed({"source": "s", "bucket": "b"})
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "check", "row") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("epochs") * F.col("source_size")
    return placed.join(told, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))) \
        .withColumn("before", before).withColumn("epochs", epochs) \
        .withColumn("taken", F.col("epochs") * F.col("size")
                    + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))) \
        .select("id", "check", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The mix itself: a row per document and epoch, with ``epoch`` (from 1) and ``words``.

    ``words`` is the number of leading words to read: all of them, but for the one document at
    a source's cut. Documents of which nothing is taken are left out. Rows equal in id and text share
    the largest plan of theirs. Columns of those two names are replaced.
    """
    plan = mix(docs, id_col=id_col, text_col=text_col, **settings).filter("taken > 0") \
        .groupBy("id", "check").agg(F.max("size").alias("__size"), F.max("taken").alias("__taken")) \
        .withColumnsRenamed({"id": "__i", "check": "__c"})
    check = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rounds = F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))
    words = F.least(F.col("__size"), F.col("__taken") - (F.col("epoch") - 1) * F.col("__size"))
    return docs.join(plan, F.col(id_col).eqNullSafe(F.col("__i")) & (check == F.col("__c"))) \
        .withColumn("epoch", F.explode(rounds)).withColumn("words", words) \
        .select(*[c for c in docs.columns if c.lower() not in ("epoch", "words")], "epoch", "words")
