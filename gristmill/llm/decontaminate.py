"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ``window`` words (a shorter item is one window). A window is
contained in a document when all its shingles are, in their order, so a single shingle, the rarest
one, is a sufficient prefix for the join. The steps:

1. A scan of the documents marks words inside shingles that the benchmark may hold (a bitmap of
   fixed size over shingle hashes; a false mark costs work only) and keeps the marked runs
   that are at least as long as the shortest window.
2. The shingles of those runs, over all documents, are counted: the rarity order.
3. Windows with a shingle that no run has are out. Each other window is joined on its rarest
   shingle only, with the words around the place.
4. The window must fit into the run at the shingle's offset (length and position), and its
   words must be exactly those of the document there.

The texts themselves are never shuffled. A passage in a third of all documents gives as many rows
as it has places; the join splits such keys.

Words are lower-cased over A-Z. Null or wordless documents and items have no words and no hits.
Documents are told apart by row, so equal ids do no harm. Items with equal ids count as one; a null
item id counts as the empty name. Extra columns are ignored by ``hits`` and returned by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gristmill.llm.common import ascii_lower, dealt, ship, with_row
from gristmill.llm.wordscan import Words, ascii_word_bytes, byte_values, chunks
from gristmill.plans.lineage import settle

ship(__name__)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
SLOTS = 1 << 22  # bits of the map that every task gets: half a megabyte


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """item, words: every window of every item."""
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                         words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("all")).filter("size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i + 1, window))).alias("words"))


def _slots(scan: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    at, hashes = scan.shingles(size)
    return at, ((hashes + np.uint64(size)) % np.uint64(SLOTS)).astype(np.int64)


def benchmark_slots(windows: DataFrame) -> tuple[np.ndarray, int]:
    """The bitmap (three entries: shingles of one, two, three words) and the shortest window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(ascii_word_bytes())
        for batch in batches:
            for text in batch.column("text").to_pylist():
                scan = Words([text], values)
                n = len(scan.starts)
                size = min(SHINGLE, n)
                slots = _slots(scan, size)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), size, np.int32)), pa.array(slots.astype(np.int32)),
                     pa.array(np.full(len(slots), n, np.int32))], ["size", "slot", "n"])

    source = windows.select(F.array_join("words", " ").cast("binary").alias("text"))
    found = source.mapInArrow(run, "size int, slot int, n int") \
        .groupBy("size", "slot").agg(F.min("n").alias("n"))
    table = found.toArrow()  # at most SHINGLE * SLOTS rows, whatever the benchmark
    marks = np.zeros((SHINGLE + 1, SLOTS), bool)
    marks[table.column("size").to_numpy(), table.column("slot").to_numpy()] = True
    shortest = int(table.column("n").to_numpy().min()) if table.num_rows else 0
    return np.packbits(marks, axis=1), shortest


def scan_documents(docs: DataFrame, bits: np.ndarray, shortest: int, id_col: str, text_col: str) -> DataFrame:
    """row, id, check, n_words and runs (start, words) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    sizes = [k for k in range(1, SHINGLE + 1) if bits[k].any()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(ascii_word_bytes())
        marks = {k: np.unpackbits(shared.value[k]).view(bool) for k in sizes}
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.string())]))
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            counts, runs = [], []
            for first, last in chunks(texts):
                scan = Words(texts[first:last], values)
                n = len(scan.starts)
                own = [[] for _ in range(last - first)]
                before = np.searchsorted(scan.text, np.arange(last - first + 1))
                edges = np.zeros(n + 1, np.int32)
                for k in sizes:
                    at, slots = _slots(scan, k)
                    at = at[marks[k][slots]]
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + k, -1)
                inside = np.concatenate([[False], np.cumsum(edges[:n]) > 0, [False]])
                for i in np.unique(scan.text[inside[1:-1]]).tolist():
                    low, high = int(before[i]), int(before[i + 1])
                    part = np.concatenate([[False], inside[1 + low:1 + high], [False]])
                    turns = np.flatnonzero(part[1:] != part[:-1])
                    for s, e in zip(turns[::2].tolist(), turns[1::2].tolist()):
                        if e - s >= shortest:
                            line = b" ".join(scan.words(low + s, low + e)).lower()
                            own[i].append({"start": s, "words": line.decode()})
                counts += np.diff(before).tolist()
                runs += own
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("check"),
                 pa.array(counts, pa.int64()), pa.array(runs, kind)], ["row", "id", "check", "n_words", "runs"])

    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("check"),
                         text.cast("binary").alias("text"))
    rows = with_row(dealt(source))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"row long, id {kind}, check long, n_words long, runs array<struct<start:int,words:string>>")


def _shingles(words: str, size: Column, extra: list[Column]) -> Column:
    """Structs of position, shingle and whatever ``extra`` makes of the position."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - size),
        lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(words, i + 1, size), " ").alias("shingle"),
                           *[make(i) for make in extra]))


def occurrences(scanned: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """row, start, length, window: every place where a window stands in a document."""
    distinct = windows.select(F.array_join("words", " ").alias("window"), "words").distinct()
    size = F.least(F.lit(SHINGLE), F.size("words"))
    grams = settle(distinct.withColumn("g", F.explode(_shingles("words", size, []))).select(
        "window", F.size("words").alias("length"), "g.pos", "g.shingle"))
    runs = scanned.select("row", F.explode("runs").alias("r")).select(
        "row", "r.start", F.split("r.words", " ").alias("run"))

    def context(i: Column) -> Column:
        left = F.least(i, F.lit(window - 1))
        return F.struct(left.alias("left"), F.slice("run", i - left + 1, left + window).alias("words")).alias("around")

    sizes = F.explode(F.array(*map(F.lit, range(1, SHINGLE + 1)))).alias("size")
    sized = runs.select("*", sizes).filter(F.size("run") >= F.col("size"))
    used = grams.select(F.least(F.lit(SHINGLE), "length").alias("size")).distinct()  # three rows at most
    sized = sized.join(F.broadcast(used), "size")
    counts = sized.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.size("run") - F.col("size")),
        lambda i: F.array_join(F.slice("run", i + 1, F.col("size")), " "))).alias("shingle")) \
        .groupBy("shingle").agg(F.count("*").alias("n"))
    known = grams.join(counts, "shingle", "left")
    prefix = known.groupBy("window", "length").agg(
        F.min(F.struct("n", "shingle", "pos")).alias("rarest"), F.count_if(F.col("n").isNull()).alias("absent")) \
        .filter("absent = 0").select("window", "length", "rarest.shingle", F.col("rarest.pos").alias("offset"))
    places = sized.select("row", "start", F.explode(_shingles("run", F.col("size"), [context])).alias("g")) \
        .select("row", "g.shingle", (F.col("start") + F.col("g.pos")).alias("at"), "g.around")
    fits = F.col("around.left") >= F.col("offset")
    there = F.array_join(F.slice("around.words", F.col("around.left") - F.col("offset") + 1, F.col("length")), " ")
    return places.join(prefix, "shingle").filter(fits).filter(there == F.col("window")) \
        .select("row", (F.col("at") - F.col("offset")).alias("start"), "length", "window").distinct()


def hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per document: row, id, check, n_words, n_hit, n_items, items (sorted names)."""
    if window < 1:
        raise ValueError("a window needs a word")
    windows = settle(item_windows(items, window, item_col, item_text_col))
    bits, shortest = benchmark_slots(windows)
    scanned = settle(scan_documents(docs, bits, shortest, id_col, text_col))
    found = settle(occurrences(scanned, windows, window))
    span = F.sequence("start", F.col("start") + F.col("length") - 1)
    covered = found.select("row", "start", "length").distinct().groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(span)))).cast("long").alias("n_hit"))
    owners = windows.select(F.array_join("words", " ").alias("window"), "item").distinct()
    named = found.select("row", "window").distinct().join(owners, "window") \
        .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return scanned.drop("runs").join(covered, "row", "left").join(named, "row", "left").select(
        "row", "id", "check", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = hits(docs, items, id_col=id_col, text_col=text_col, **settings).filter("n_hit > 0") \
        .select(F.col("id").alias("__i"), F.col("check").alias("__c")).distinct()
    check = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__i")) & (check == F.col("__c")), "left_anti")
