"""Repeated byte strings by merging Burrows-Wheeler transforms.

A byte goes when a string of ``length`` bytes that covers it also starts somewhere else, in the same document or
another. The work is cut so that equal strings always meet:

1. *Anchors.* Of the k-grams of every window of ``length`` bytes the one with the least hash is its anchor. Windows next to each
   other with one anchor form a stretch; equal windows lie in stretches with equal anchors. A first
   scan counts anchors; an anchor seen once ends there.
2. *Folding.* A second scan lists the stretches whose anchors repeat. Equal stretches fold into one, with a
   weight; of weight two or more, all their windows are repeated. Only where one anchor has different
   stretches are bytes needed, and sent, once for each.
3. *Transforms.* Stretches with the same anchor meet in one bucket of bounded size. They are written over an alphabet
   of ``LETTER``-byte letters, in all phases, and dealt into shards; each shard gets its suffix order and transform. The
   transforms are then merged without sorting suffixes again: an interleave of the shards is refined
   letter by letter, each round moving every entry by its preceding letter, and the borders between entries that
   differ so far give the common prefixes. After ``length / LETTER`` rounds, what lies between two borders
   is one repeated interval. A hash of the whole window, independent of the letters, checks it.
4. An anchor with more than ``GROUP_LIMIT`` different stretches (a line that very many documents share) is taken apart
   into single windows instead, each of which is counted by its hash.

Which anchors repeat is passed to the second scan as two bitmaps of fixed size; a false mark costs work only. Covered
ranges come back to each document by id and text hash.

Null text is the empty text. Texts shorter than ``length`` have nothing to remove. Equal rows are each other's copies. Equal
ids with different texts are different documents. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, ship
from gristmill.llm.wordscan import _BASE, _INVERSE, _powers, chunks, mixed
from gristmill.plans.lineage import settle

ship(__name__)

LENGTH = 200
LETTER = 40
ANCHOR = 64
BITS = 26
BUCKET_BYTES = 1 << 20
SHARD_BYTES = 1 << 18
GROUP_LIMIT = 2_048

_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_OTHERS = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)


class Grams:
    """Hashes of any substring of a buffer."""

    def __init__(self, buffer: np.ndarray, values: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[buffer] * _powers(_BASE, n), out=self.sums[1:])
        self.shift = _powers(_INVERSE, n)

    def every(self, size: int) -> np.ndarray:
        return mixed((self.sums[size:] - self.sums[:-size]) * self.shift[:len(self.sums) - size])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.shift[starts] + (ends - starts).astype(np.uint64))


class Stretches:
    """The stretches of a range of texts: start and end in the buffer, anchor hash, content hash, text."""

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        self.joined = b"\n".join(texts) + b"\n"
        buffer = np.frombuffer(self.joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        n, width = len(buffer), length - anchor + 1
        last = n - length + 1
        grams = Grams(buffer, _VALUES)
        if last <= 0:
            self.starts = self.ends = self.text = np.zeros(0, np.int64)
            self.anchors = self.contents = np.zeros(0, np.uint64)
            return
        hashes = grams.every(anchor)
        low = np.uint64((1 << 32) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        blocks = -(-len(keys) // width)
        padded = np.full(blocks * width, ~np.uint64(0))
        padded[:len(keys)] = keys
        square = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:last], ahead[width - 1:width - 1 + last])
        whole = np.zeros(n + 1, np.int8)  # windows inside one text
        inside = sizes > length
        whole[self.offsets[:-1][inside]] += 1
        whole[self.offsets[1:][inside] - length] -= 1
        valid = np.cumsum(whole[:last], dtype=np.int8) > 0
        fresh = valid.copy()
        fresh[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
        ended = valid.copy()
        ended[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
        self.starts = np.flatnonzero(fresh)
        self.ends = np.flatnonzero(ended) + length
        self.anchors = hashes[(least[self.starts] & low).astype(np.int64)]
        self.contents = grams.of(self.starts, self.ends)
        self.text = np.searchsorted(self.offsets, self.starts, "right") - 1


def count_anchors(source: DataFrame, length: int, anchor: int) -> DataFrame:
    """anchor, and whether its stretches differ, for every anchor that is seen twice or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in chunks(texts):
                s = Stretches(texts[first:last], length, anchor)
                order = np.argsort(s.anchors, kind="stable")
                names, contents = s.anchors[order], s.contents[order].view(np.int64)
                if not len(names):
                    continue
                heads = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[heads].view(np.int64)), pa.array(np.diff(np.append(heads, len(names)))),
                     pa.array(np.minimum.reduceat(contents, heads)), pa.array(np.maximum.reduceat(contents, heads))],
                    ["anchor", "n", "low", "high"])

    return source.select("text").mapInArrow(run, "anchor long, n long, low long, high long") \
        .groupBy("anchor").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")) \
        .filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("differ"))


def bitmap(anchors: DataFrame) -> np.ndarray:
    """``2 ** BITS`` bits; the driver gets a row for each 32 of them at most."""
    slot = F.pmod("anchor", F.lit(1 << BITS))
    words = anchors.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).cast("int").alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def marked(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    slot = anchors & np.uint64((1 << BITS) - 1)
    return (bits[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def list_stretches(source: DataFrame, repeated: np.ndarray, differing: np.ndarray, length: int, anchor: int) -> DataFrame:
    """Occurrences (id, check, start, anchor, content, windows) and, apart, the bytes of contents (``bytes``)."""
    context = source.sparkSession.sparkContext
    one, two = context.broadcast(repeated), context.broadcast(differing)
    kind = source.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "check", "start", "anchor", "content", "windows", "bytes"]
        for batch in batches:
            texts, ids, checks = batch.column("text").to_pylist(), batch.column("id"), batch.column("check")
            for first, last in chunks(texts):
                s = Stretches(texts[first:last], length, anchor)
                at = np.flatnonzero(marked(one.value, s.anchors))
                if not len(at):
                    continue
                row = pa.array(first + s.text[at])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), checks.take(row), pa.array((s.starts[at] - s.offsets[s.text[at]]).astype(np.int32)),
                     pa.array(s.anchors[at].view(np.int64)), pa.array(s.contents[at].view(np.int64)),
                     pa.array((s.ends[at] - s.starts[at] - length + 1).astype(np.int32)),
                     pa.nulls(len(at), pa.binary())], names)
                at = np.flatnonzero(marked(two.value, s.anchors))
                at = at[np.unique(s.anchors[at] ^ mixed(s.contents[at]), return_index=True)[1]] if len(at) else at
                if len(at):
                    none = pa.nulls(len(at), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(at), ids.type), none, pa.nulls(len(at), pa.int32()),
                         pa.array(s.anchors[at].view(np.int64)), pa.array(s.contents[at].view(np.int64)),
                         pa.array((s.ends[at] - s.starts[at] - length + 1).astype(np.int32)),
                         pa.array([s.joined[a:b] for a, b in zip(s.starts[at].tolist(), s.ends[at].tolist())], pa.binary())],
                        names)

    return source.mapInArrow(
        run, f"id {kind.simpleString()}, check long, start int, anchor long, content long, windows int, bytes binary")


# ---- transforms -------------------------------------------------------------------------------

def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable argsort of unsigned 32-bit keys, as two passes of a radix sort."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if len(keys) and int(keys.max()) > 0xFFFF:
        order = order[np.argsort((keys[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Text:
    """Contents written over the alphabet of letters: for every suffix its letter, the one before it, the next suffix.

    A content of n bytes has the suffixes 0..n; those with less than a letter left start with the end
    mark, letter 0. Suffix i continues at i + LETTER, so there is one chain for each phase.
    """

    def __init__(self, contents: list[bytes], letter: int):
        self.joined = b"\n".join(contents) + b"\n"
        buffer = np.frombuffer(self.joined, np.uint8)
        self.sizes = np.fromiter(map(len, contents), np.int64, len(contents)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        n = len(buffer)
        self.left = np.repeat(self.offsets[1:] - 1, self.sizes) - np.arange(n)     # bytes from here to the end
        self.before = np.arange(n) - np.repeat(self.offsets[:-1], self.sizes)
        full = self.left >= letter
        self.letters = np.zeros(n, np.uint32)
        hashes = Grams(buffer, _VALUES).every(letter) if n >= letter else np.zeros(0, np.uint64)
        at = np.flatnonzero(full)
        self.letters[at] = np.unique(hashes[at], return_inverse=True)[1].astype(np.uint32) + 1
        self.previous = np.zeros(n, np.uint32)
        back = np.flatnonzero(self.before >= letter)
        self.previous[back] = self.letters[back - letter]
        self.letter = letter


def shard_order(text: Text, low: int, high: int) -> np.ndarray:
    """The suffixes low..high in order, by doubling the number of compared letters; ties by place."""
    place = np.arange(low, high)
    rank = text.letters[low:high].astype(np.int64)
    letters = 1
    while letters < 8:
        step = letters * text.letter
        there = np.flatnonzero(text.left[low:high] >= step)
        after = np.zeros(high - low, np.int64)
        after[there] = rank[there + step] + 1
        key = rank * (int(after.max(initial=0)) + 1) + after
        rank = np.unique(key, return_inverse=True)[1]
        letters *= 2
    return place[stable_order(rank.astype(np.uint32))]


def merge(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave transforms by their first ``rounds`` letters.

    Returns, for every merged entry, the shard it comes from (a shard's entries keep their order), and whether
    it differs from the entry before it within those letters. Every round moves each entry to the suffix that
    starts one letter earlier: a stable sort by the preceding letter. Two neighbours agree if that letter agrees
    and the suffixes they came from lay between the same borders.
    """
    sizes = [len(t) for t in transforms]
    shard = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint16)
    symbols = np.concatenate(transforms)
    interval = np.zeros(len(shard), np.int32)
    border = np.zeros(len(shard), bool)
    before = np.empty(len(shard), np.uint32)
    for _ in range(rounds):
        before[np.argsort(shard, kind="stable")] = symbols
        order = stable_order(before)
        sorted_, came = before[order], interval[order]
        border = np.ones(len(order), bool)
        border[1:] = (sorted_[1:] != sorted_[:-1]) | (came[1:] != came[:-1]) | (sorted_[1:] == 0)
        shard = shard[order]
        interval = np.cumsum(border, dtype=np.int32)
    return shard, border


def repeated_windows(contents: list[bytes], weights: np.ndarray, length: int = LENGTH, letter: int = LETTER,
                     shard_bytes: int = SHARD_BYTES) -> list[list[tuple[int, int]]]:
    """For each content the ranges of window starts whose window occurs twice or more, by weight."""
    text = Text(contents, letter)
    cuts = [0]
    for end in text.offsets[1:].tolist():
        if end - cuts[-1] >= shard_bytes:
            cuts.append(end)
    if cuts[-1] < len(text.letters):
        cuts.append(len(text.letters))
    orders = [shard_order(text, a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    shard, border = merge([text.previous[o] for o in orders], length // letter)
    suffix = np.empty(len(shard), np.int64)
    suffix[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    check = np.zeros(len(shard), np.uint64)
    whole = text.left >= length
    at = np.flatnonzero(whole)
    check[at] = Grams(np.frombuffer(text.joined, np.uint8), _OTHERS).of(at, at + length)
    there = check[suffix]
    border[1:] |= there[1:] != there[:-1]
    interval = np.cumsum(border) - 1
    owner = np.repeat(np.arange(len(contents)), text.sizes)
    heavy = np.where(whole[suffix], weights[owner[suffix]], 0)
    total = np.bincount(interval, heavy)
    hit = np.zeros(len(shard) + 1, bool)
    hit[suffix] = (total[interval] > 1) & whole[suffix]
    edges = np.diff(hit.view(np.int8), prepend=np.int8(0))
    out: list[list[tuple[int, int]]] = [[] for _ in contents]
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        i = int(owner[a])
        zero = int(text.offsets[i])
        out[i].append((a - zero, b - zero))
    return out


def _merge_buckets(grouped: DataFrame, length: int, letter: int) -> DataFrame:
    """anchor, content, low, high (window starts) of repeated windows in contents of weight one."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("content", "ascending")])
        weights = np.minimum(table.column("n").to_numpy(), 2)
        found = repeated_windows(table.column("bytes").to_pylist(), weights, length, letter)
        rows = [(i, a, b) for i, ranges in enumerate(found) if weights[i] == 1 for a, b in ranges]
        at = pa.array([r[0] for r in rows], pa.int64())
        return pa.table({"anchor": table.column("anchor").take(at), "content": table.column("content").take(at),
                         "low": pa.array([r[1] for r in rows], pa.int32()), "high": pa.array([r[2] for r in rows], pa.int32())})

    return grouped.groupBy("bucket").applyInArrow(run, "anchor long, content long, low int, high int")


def _single_windows(hot: DataFrame, length: int) -> DataFrame:
    """anchor, content, at, n, window (two hashes) of every window of contents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("bytes").to_pylist()
            for first, last in chunks(contents):
                part = contents[first:last]
                buffer = np.frombuffer(b"".join(part), np.uint8)
                sizes = np.array([len(c) for c in part])
                heads = np.cumsum(sizes) - sizes
                counts = sizes - length + 1
                at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = at + np.repeat(heads, counts)
                row = pa.array(first + np.repeat(np.arange(len(part)), counts))
                one, two = (Grams(buffer, v).of(starts, starts + length) for v in (_VALUES, _OTHERS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("anchor").take(row), batch.column("content").take(row), batch.column("n").take(row),
                     pa.array(at.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    ["anchor", "content", "n", "at", "one", "two"])

    return hot.mapInArrow(run, "anchor long, content long, n long, at int, one long, two long")


def covered_ranges(source: DataFrame, length: int = LENGTH, letter: int = LETTER, anchor: int = ANCHOR,
                   group_limit: int = GROUP_LIMIT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """id, check, ranges: the byte ranges of each document that repeated strings cover."""
    anchors = settle(count_anchors(source, length, anchor))
    listed = settle(list_stretches(
        source, bitmap(anchors), bitmap(anchors.filter("differ")), length, anchor))
    contents = settle(
        listed.groupBy("anchor", "content").agg(
            F.count("check").alias("n"), F.max("windows").alias("windows"), F.max("bytes").alias("bytes"))
        .filter("n > 1 OR bytes IS NOT NULL"))
    known = contents.filter("bytes IS NOT NULL")
    groups = settle(known.groupBy("anchor").agg(F.count("*").alias("d"), F.sum(F.octet_length("bytes")).alias("size"))
                    .filter("d > 1"))
    total = groups.filter(F.col("d") <= group_limit).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    sized = known.join(groups.select("anchor", "d"), "anchor")
    merged = _merge_buckets(
        sized.filter(F.col("d") <= group_limit).select(
            F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"), "anchor", "content", "n", "bytes"),
        length, letter)
    single = settle(_single_windows(sized.filter(F.col("d") > group_limit).select("anchor", "content", "n", "bytes"), length))
    twice = single.groupBy("one", "two").agg(F.sum("n").alias("all")).filter("all > 1").select("one", "two")
    apart = single.filter("n = 1").join(twice, ["one", "two"]).select(
        "anchor", "content", F.col("at").alias("low"), (F.col("at") + 1).alias("high"))
    folded = contents.filter("n > 1").select("anchor", "content", F.lit(0).alias("low"), F.col("windows").alias("high"))
    hits = folded.unionByName(merged).unionByName(apart)
    places = listed.filter("check IS NOT NULL").select("id", "check", "start", "anchor", "content")
    span = F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") - 1 + length).alias("high"))
    return places.join(hits, ["anchor", "content"]).groupBy("id", "check") \
        .agg(F.collect_set(span).alias("ranges"))


def unite(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Touching and overlapping ranges as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, letter: int = LETTER, id_col: str = "doc_id", text_col: str = "text",
                   **settings) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    if length % letter or length < letter or not 0 < settings.get("anchor", ANCHOR) <= length:
        raise ValueError("the length must be a whole number of letters and hold an anchor")
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("check"), text.cast("binary").alias("text"))
    found = covered_ranges(dealt(source), length, letter, **settings).withColumnsRenamed({"id": "i", "check": "c"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                spans = unite([(r["low"], r["high"]) for r in ranges or ()])
                ends = [0, *(b for _, b in spans)]
                starts = [*(a for a, _ in spans), len(t)]
                kept = b"".join(t[a:b] for a, b in zip(ends, starts))
                out.append((len(t), len(t) - len(kept), len(spans), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([o[k] for o in out], pa.int64()) for k in range(3)),
                 pa.array([o[3] for o in out], pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = source.schema["id"].dataType.simpleString()
    return source.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("check") == F.col("c")), "left") \
        .select("id", "text", "ranges") \
        .mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
