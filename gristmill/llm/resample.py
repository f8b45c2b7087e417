"""Importance resampling towards a target, with hashed n-grams and deduplicated lines.

A document's weight is the sum, over its features (all runs of 1 to ``ngrams`` words), of how much likelier the
feature's bucket is among the target texts than in the corpus. Most text repeats line by line (boilerplate, copies),
so the work is cut at newlines:

1. Lines are counted: equal lines fold before the shuffle, a line in a third of the documents is one row per map task.
2. Every distinct line is read once: the buckets of its features are written down as a small array.
3. The corpus counts are those buckets times the line's occurrences. For ``ngrams`` > 1 the runs that cross a newline are
   found per distinct text and added apart, times the occurrences of the text.
4. The driver gets one count per bucket (``buckets`` is a parameter), turns them into gains and sends these back; a line's
   weight is then looked up once, and documents sum the weights of their lines. Lines that very many documents share are joined in
   slices, so no task gets them all.
5. Scores are weights plus Gumbel noise made of the id; the highest are drawn without replacement. Ranks come from range
   partitions and their sizes: the driver gets a number per partition.

Words are lower-cased over A-Z. Null or empty texts have no words, weigh 0 and get a score all the same. A null id counts as the
empty name. Documents with equal ids get equal noise; ties go to the smaller id (null first), then to the smaller text hash; equal
rows are interchangeable. An empty target or corpus gives gains from the smoothing alone. Long lines are read in pieces of about a
megabyte, cut between words. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gristmill.llm.common import join_sliced, ship, with_row
from gristmill.plans.lineage import settle

ship(__name__)

NGRAMS = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
PIECE_BYTES = 1 << 20
# Distinct features whose bucket a task remembers.
REMEMBERED = 200_000
ADDERS = 8

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def word_lists(line: bytes, piece: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a line in order, a bounded list at a time."""
    start = 0
    while start < len(line):
        gap = _GAP.search(line, start + piece)
        end = gap.start() if gap else len(line)
        yield _WORD.findall(line[start:end].lower())
        start = end


class Hasher:
    """Buckets of features; forgets what it has seen when that grows too large."""

    def __init__(self, ngrams: int, buckets: int):
        self.ngrams, self.buckets, self.seen = ngrams, buckets, {}

    def bucket(self, feature: bytes) -> int:
        found = self.seen.get(feature)
        if found is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            found = self.seen[feature] = crc32(feature) % self.buckets
        return found

    def line(self, line: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every run of 1 to ``ngrams`` words."""
        n_words, parts, carried = 0, [], []
        for words in word_lists(line):
            n_words += len(words)
            parts.append(np.fromiter(map(self.bucket, words), np.uint32, len(words)))
            if self.ngrams > 1:
                joined = carried + words
                runs = [b" ".join(joined[i:i + n]) for n in range(2, self.ngrams + 1)
                        for i in range(max(0, len(carried) - n + 1), len(joined) - n + 1)]
                parts.append(np.fromiter(map(self.bucket, runs), np.uint32, len(runs)))
                carried = joined[-(self.ngrams - 1):]
        return n_words, np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def crossing(self, text: bytes) -> np.ndarray:
        """Buckets of the runs that begin in one line and end in a later one."""
        found, before = [], []  # before: the last words so far, each with its line
        for number, line in enumerate(text.split(b"\n")):
            for words in word_lists(line):
                now = before + [(w, number) for w in words]
                for i in range(len(before)):
                    for n in range(max(2, len(before) - i + 1), self.ngrams + 1):
                        if i + n <= len(now) and now[i][1] != now[i + n - 1][1]:
                            found.append(self.bucket(b" ".join(w for w, _ in now[i:i + n])))
                # Runs that begin in this piece lie inside its line.
                before = now[-(self.ngrams - 1):]
        return np.array(found, np.uint32)


def features(texts: DataFrame, ngrams: int, buckets: int, across: bool = False) -> DataFrame:
    """``key``, ``n``, n_words, n_features and packed buckets of each row's ``text`` (bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ngrams, buckets)
        for batch in batches:
            words, packed = [], []
            for text in batch.column("text"):
                n, found = (0, hasher.crossing(text.as_py())) if across else hasher.line(text.as_py())
                words.append(n)
                packed.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), pa.array(words, pa.int64()),
                 pa.array([len(p) for p in packed], pa.int64()), pa.array([p.tobytes() for p in packed], pa.binary())],
                ["key", "n", "n_words", "n_features", "buckets"])

    return texts.mapInArrow(
        run, "key struct<one: long, two: long>, n long, n_words long, n_features long, buckets binary")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch and where each row's begin."""
    parts = [np.frombuffer(v.as_buffer(), np.uint32) if v.as_buffer().size else np.zeros(0, np.uint32) for v in column]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32),
            np.array([0, *accumulate(map(len, parts))], np.int64))


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs, ``n`` times per row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            values, starts = _lists(batch.column("buckets"))
            np.add.at(total, values, np.repeat(batch.column("n").to_numpy(), np.diff(starts)))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("counts"):
                total += np.frombuffer(packed.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    # One packed row per task, added up in a few tasks: the driver gets a row from each of these.
    rows = found.select("n", "buckets").mapInArrow(count, "counts binary").repartition(ADDERS).mapInArrow(add, "counts binary")
    return sum((np.frombuffer(r.counts, np.int64) for r in rows.collect()), np.zeros(buckets, np.int64))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log of the smoothed ratio of a bucket's shares, rounded down."""
    s_all, t_all, width = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + width) / ((s + 1) * (t_all + width))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """key, n_words, n_features and weight of each row."""
    sent = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, starts = _lists(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(sent.value[values])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_words"), batch.column("n_features"),
                 pa.array(sums[starts[1:]] - sums[starts[:-1]], pa.int64())],
                ["key", "n_words", "n_features", "weight"])

    return found.select("key", "n_words", "n_features", "buckets").mapInArrow(
        run, "key struct<one: long, two: long>, n_words long, n_features long, weight long")


def digest(text: Column) -> Column:
    """128 bits of a text, as two independent numbers."""
    return F.struct(F.xxhash64(text).alias("one"), F.xxhash64(F.lit("second"), text).alias("two"))


def counted(texts: DataFrame) -> DataFrame:
    """key, n and text (bytes) of every distinct ``text``; copies fold before the shuffle."""
    return texts.groupBy("text").agg(F.count("*").alias("n")).select(
        digest(F.col("text")).alias("key"), "n", F.col("text").cast("binary").alias("text"))


def _lines(docs: DataFrame, text: Column) -> DataFrame:
    return docs.select(F.explode(F.split(text, "\n", -1)).alias("text"))


def noise(label: Column) -> Column:
    """Gumbel noise in thousandths, from a digest of ``label``."""
    h = F.conv(F.substring(F.sha2(label.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with rank: 1, 2, 3… for the drawn rows, null for the rest."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), "check", "row"]
    able = scored.filter(F.col("n_words") >= least_words)
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number stands for (range partition, place in it).
    spread = settle(able.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("number", F.monotonically_increasing_id()))
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(spread.groupBy(part.alias("part")).count().collect())  # a row per partition
    draw = sum(r["count"] for r in sizes) * percent // 100
    ahead = dict(zip((r["part"] for r in sizes), accumulate((r["count"] for r in sizes), initial=0)))
    rank = place + 1
    if ahead:
        rank = rank + F.element_at(F.create_map(*[F.lit(v) for kv in ahead.items() for v in kv]), part)
    rank = rank.cast("long")
    return spread.withColumn("rank", F.when(rank <= draw, rank)).drop("number").unionByName(
        scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: id, n_words, n_features, weight, score, rank (null if not drawn)."""
    if ngrams < 1 or not 0 < buckets < 1 << 32 or not 0 <= percent <= 100:
        raise ValueError("runs need a word, buckets a 32-bit number, and the percentage lies between 0 and 100")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = settle(features(counted(_lines(docs, text)), ngrams, buckets))
    corpus = bucket_counts(lines, buckets)
    aim = bucket_counts(features(counted(_lines(target, text)), ngrams, buckets), buckets)
    if ngrams > 1:
        whole = settle(features(counted(docs.select(text.alias("text"))), ngrams, buckets, across=True))
        corpus = corpus + bucket_counts(whole, buckets)
        aim = aim + bucket_counts(features(counted(target.select(text.alias("text"))), ngrams, buckets, True), buckets)
    gain = gains(corpus, aim)
    told = settle(weighed(lines, gain))

    named = with_row(docs.select(F.col(id_col).alias("id"), text.alias("text")))
    places = settle(named.withColumn("line", F.explode(F.split("text", "\n", -1))).select(
        "row", "id", F.xxhash64("text").alias("check"),
        *([digest(F.col("text")).alias("text_key")] if ngrams > 1 else []), digest(F.col("line")).alias("key")))
    sums = ["n_words", "n_features", "weight"]
    kept = ["row", "id", "check", *(["text_key"] if ngrams > 1 else [])]
    summed = join_sliced(places, told, ["key"], "row").groupBy(*kept).agg(*[F.sum(c).alias(c) for c in sums])
    if ngrams > 1:
        more = weighed(whole, gain).select(
            F.col("key").alias("text_key"), F.col("n_features").alias("f"), F.col("weight").alias("w"))
        summed = join_sliced(settle(summed), more, ["text_key"], "row").select(
            "row", "id", "check", "n_words", (F.col("n_features") + F.col("f")).alias("n_features"),
            (F.col("weight") + F.col("w")).alias("weight"))
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    scored = settle(summed.withColumn("score", F.col("weight") + noise(label)))
    return ranked(scored, percent, least_words).select("id", "n_words", "n_features", "weight", "score", "rank")
