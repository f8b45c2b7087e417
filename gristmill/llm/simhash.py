"""SimHash near-dedup with a vantage-point tree over Hamming distance.

A fingerprint has a bit for each of 64 hash bits: 1 where over half of a text's shingle hashes have it.
Distinct fingerprints within ``max_bits`` link, and components of links are the groups.

The tree is fitted on a bounded sample of fingerprints: a node sends a fingerprint left
when its distance to the node's vantage point is at most the sample's median, else right. Every distinct
fingerprint has one home leaf. By the triangle inequality a partner can be in another leaf
only if, at each node on the way there, the distance is within ``max_bits`` of the boundary; to those
leaves the fingerprint is sent as a visitor (of two leaves, only from the lower to the higher number, since a pair
would otherwise be found twice). A leaf's homes and visitors are packed in blocks of bounded
size and block pairs are compared exactly, again pruned by vantage points inside the task.
A task returns a spanning forest of what it found, never all pairs, and copies were folded into one
fingerprint before, so a group of thousands costs its distinct fingerprints only.

The sample decides balance, never a result. A node whose split would send nearly all to both sides stays
a leaf, of however many blocks it takes.

Null and blank texts have fingerprint zero and link like others. Texts of fewer words than a
shingle have one shingle, the whole sequence. Equal ids and equal rows are
ordinary members. A group's id is its smallest non-null id. Extra columns are ignored by
``groups`` and returned by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, join_sliced, ship, with_row
from gristmill.llm.components import components
from gristmill.plans.lineage import settle

ship(__name__)

SHINGLE, MAX_BITS, SEED = 3, 2, 42
BLOCK = 8_192          # fingerprints in a packed block
LEAF_ROWS = 16_384     # fingerprints a leaf should have
MAX_LEAVES = 1 << 16   # bound of the tree that tasks get, and by PER_LEAF of the sample it is fitted on
PER_LEAF = 16
TILE = 1 << 21         # comparisons made at once in a task
SHINGLES_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words; of the whole sequence where there are fewer."""
    words = text.lower().split()  # for bytes: A-Z only, and the six ASCII spaces
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *(ends[:-size]).tolist()]
    return [digest(line[s:e], SEED) for s, e in zip(starts, (ends[size - 1:] - 1).tolist())]


def majority_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[i:i + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8)
        total += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes | None, size: int) -> int:
    hashes = np.array(shingle_hashes(text or b"", size), np.uint64)
    if not len(hashes):
        return 0
    bits = majority_bits(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """row, id, check (hash of the text) and fp (the fingerprint as a signed number) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("check"), pa.array(found)], ["row", "id", "check", "fp"])

    check = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("check")
    source = docs.select(F.col(id_col).alias("id"), check, F.col(text_col).cast("binary").alias("text"))
    rows = with_row(dealt(source))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, check long, fp long")


# ---- the tree ---------------------------------------------------------------------------------

def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def best_vantage(points: np.ndarray) -> np.uint64:
    """Of a few points the one whose distances to the others spread most."""
    some = points[:: max(1, len(points) // 256)]
    tried = points[:: max(1, len(points) // 8)][:8]
    return max(tried, key=lambda v: float(distance(some, v).std()))


def grow(sample: np.ndarray, leaves: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, boundary, left, right); a child below zero is leaf -1 - child."""
    nodes: list = []
    count = [0]

    def build(points: np.ndarray, budget: int) -> int:
        if budget >= 2 and len(points) >= 2 * PER_LEAF:
            vantage = best_vantage(points)
            d = distance(points, vantage)
            edge = int(np.median(d))
            inner = d <= edge
            to_left, to_right = (d <= edge + radius).mean(), (d > edge - radius).mean()
            if 0 < inner.sum() < len(points) and to_left + to_right < 1.75:
                at = len(nodes)
                nodes.append(None)
                left = build(points[inner], budget // 2)
                right = build(points[~inner], budget - budget // 2)
                nodes[at] = (int(vantage), edge, left, right)
                return at
        count[0] += 1
        return -count[0]

    root = build(np.unique(sample), leaves)
    assert root == 0 or not nodes
    return nodes


def route(nodes: list, points: np.ndarray, radius: int, visits: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, positions of the points that go there): at home, or as visitors too."""
    todo = [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            yield -1 - node, at
            continue
        vantage, edge, left, right = nodes[node]
        d = distance(points[at], np.uint64(vantage))
        reach = radius if visits else 0
        todo += [(left, at[d <= edge + reach]), (right, at[d > edge - reach])]


def placed(distinct: DataFrame, nodes: list, radius: int) -> DataFrame:
    """leaf, home and fp: every fingerprint once at home and wherever else it must look."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            points = fps.view(np.uint64)
            home = np.zeros(len(points), np.int64)
            for leaf, at in route(nodes, points, radius, visits=False):
                home[at] = leaf
            for leaf, at in route(nodes, points, radius, visits=True):
                at = at[home[at] <= leaf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), leaf, np.int64)), pa.array(home[at] == leaf), pa.array(fps[at])],
                    ["leaf", "home", "fp"])

    return distinct.mapInArrow(run, "leaf long, home boolean, fp long")


# ---- comparing blocks -------------------------------------------------------------------------

def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label over linked positions, to the end; every label given or returned is a root's own."""
    while True:
        a, b = labels[a], labels[b]
        open_ = a != b  # ends under one root stay so
        if not open_.any():
            return labels
        a, b = a[open_], b[open_]
        labels = labels.copy()
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while ((higher := labels[labels]) != labels).any():
            labels = higher


def close_pairs(x: np.ndarray, y: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``radius``, in bounded portions, pruned by vantage points."""
    todo = [(np.arange(len(x)), np.arange(len(y)), 0)]
    while todo:
        i, j, depth = todo.pop()
        if not len(i) or not len(j):
            continue
        if len(i) * len(j) > TILE // 4 and depth < 24:
            vantage = best_vantage(x[i])
            dx, dy = distance(x[i], vantage), distance(y[j], vantage)
            edge = int(np.median(dx))
            left, right = dy <= edge + radius, dy > edge - radius
            if (dx <= edge).all() and dx.min() < edge:
                edge -= 1
                left, right = dy <= edge + radius, dy > edge - radius
            inner = dx <= edge
            work = inner.sum() * left.sum() + (~inner).sum() * right.sum()
            if work < 0.9 * len(i) * len(j):
                todo += [(i[inner], j[left], depth + 1), (i[~inner], j[right], depth + 1)]
                continue
        step = max(1, TILE // len(j))
        for s in range(0, len(i), step):
            part = i[s:s + step]
            p, q = np.nonzero(np.bitwise_count(x[part][:, None] ^ y[j][None, :]) <= radius)
            yield part[p], j[q]


def forest(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, smallest value of its group) that join what is linked between and inside x and y."""
    values, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    labels = np.arange(len(values))
    for p, q in close_pairs(x, y, radius):
        a, b = at[p], at[len(x) + q]
        labels = merge_labels(labels, a, b)
    moved = labels != np.arange(len(values))
    return values[moved], values[labels[moved]]


def links(blocks: DataFrame, radius: int) -> DataFrame:
    """Links within leaves: home blocks with each other, visitor blocks with home blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("x"), batch.column("y")):
                x, y = (np.asarray(v.values).view(np.uint64) for v in (left, right))
                a, b = forest(x, y, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    homes = blocks.filter("home").select("leaf", F.col("part").alias("p"), F.col("fps").alias("x"))
    others = blocks.select("leaf", "home", F.col("part").alias("q"), F.col("fps").alias("y"))
    return homes.join(others, "leaf").filter("NOT home OR p <= q").select("x", "y") \
        .mapInArrow(run, "a long, b long")


def packed(rows: DataFrame) -> DataFrame:
    """leaf, home, part and fps: blocks of about ``BLOCK`` fingerprints."""
    # No more rows than twice the leaves of a bounded tree.
    sizes = F.broadcast(rows.groupBy("leaf", "home").agg(F.ceil(F.count("*") / BLOCK).alias("parts")))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    return rows.join(sizes, ["leaf", "home"]).groupBy("leaf", "home", part.alias("part")) \
        .agg(F.collect_list("fp").alias("fps"))


def sampled(distinct: DataFrame, size: int) -> np.ndarray:
    """About ``size`` fingerprints, chosen by hash."""
    total = distinct.count()
    wide = 1 << 30
    share = min(1.0, size / max(1, total))
    rows = distinct.filter(F.pmod(F.xxhash64(F.lit(1), "fp"), F.lit(wide)) < int(share * wide)) if share < 1 else distinct
    return np.sort(rows.limit(2 * size).toArrow().column("fp").to_numpy()).view(np.uint64)


def fingerprint_groups(distinct: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``fp`` and ``root`` for every fingerprint that links to another; ``distinct`` has unique ``fp``."""
    leaves = min(MAX_LEAVES, max(1, -(-distinct.count() // leaf_rows)))
    nodes = grow(sampled(distinct, leaves * PER_LEAF * 4), leaves, max_bits)
    blocks = settle(packed(settle(placed(distinct, nodes, max_bits))))
    return components(links(blocks, max_bits)).withColumnRenamed("node", "fp")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Per document: row, id, check (hash of its text), fp, root (names its group), component_id (smallest id of its group)."""
    if shingle < 1 or not 0 <= max_bits < 64:
        raise ValueError("a shingle needs a word, and bits lie between 0 and 63")
    marked = settle(fingerprints(docs, id_col, text_col, shingle))
    distinct = settle(marked.groupBy("fp").agg(F.min("id").alias("least")))
    linked = fingerprint_groups(distinct, max_bits, leaf_rows)
    rooted = settle(distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    verdict = join_sliced(rooted, lowest, ["root"], "fp").select("fp", "root", "component_id")
    return join_sliced(marked, verdict, ["fp"], "row").select("row", "id", "check", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One document of each group, with all its columns.

    It is the one of the smallest id (null last), then of the smaller text hash. Documents are told apart by id and text, so a different
    text under the same id is judged on its own. Of rows equal in id and text the least in all columns stays.
    """
    found = settle(groups(docs, id_col, text_col, **settings))
    name = F.struct(F.col("id").isNull().alias("no_id"), "id", "check")
    first = found.groupBy("root").agg(F.min(name).alias("keeper"))
    members = found.groupBy("root", "id", "check").agg(F.count("*").alias("n"))
    judged = settle(join_sliced(settle(members), first, ["root"], "check")
                    .select("id", "check", "n", (F.col("keeper") == name).alias("stays")))
    check = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))

    def pairs(rows: DataFrame):
        named = rows.select(F.col("id").alias("__i"), F.col("check").alias("__c")).distinct()
        return named, F.col(id_col).eqNullSafe(F.col("__i")) & (check == F.col("__c"))

    left = docs.join(*pairs(judged.filter("NOT stays")), "left_anti")
    repeated = judged.filter("stays AND n > 1")
    if repeated.isEmpty():
        return left
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = left.join(*pairs(repeated), "left_semi").groupBy(F.col(id_col).alias("__i"), check.alias("__c")).agg(F.min(whole).alias("__row"))
    return left.join(*pairs(repeated), "left_anti").unionByName(single.select("__row.*"))
