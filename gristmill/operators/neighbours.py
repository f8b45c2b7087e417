"""Nearest neighbours by cosine distance, exact or probed.

The exact search is a blocked similarity join with triangle-inequality pruning:

1. Rows with the same vector are folded into one *group* that carries its lowest ids, so
   a vector shared by a third of the table costs one comparison, not a quadratic number.
2. A tree of two levels is grown on a bounded sample: *tops*, and under each its own cells. A group goes to the
   nearest top and there to the nearest cell; large cells are cut into blocks of bounded size.
3. Each block is solved on its own, which bounds every row's k-th distance from above.
4. A row then visits just those other blocks whose cell may hold something closer. Tops are
   tested first; only the cells of a top that may hold something are looked at.
5. Blocks next to each other make a *bundle*. Visitors are regrouped by bundle, in chunks of bounded size, with a bit for
   each block they want: a row travels once to a bundle, however many of its blocks it visits, and a bundle once for a full
   chunk of visitors. A unit of work is one chunk beside one bundle, whatever the skew. What travels may grow with the square of the rows, so
   bundles are visited in waves: what a wave moves is a few times the vectors, and it is deleted before the next one.

Only the best of a unit leave a task; pairs are never listed. Unit vectors are
compared by chord length (a metric; cosine distance is half its square). A zero vector
gets a component of its own, which puts it at cosine distance 1 from everything else.
Distances are rounded to six digits and ties go to the lower id.

``approximate_knn`` is a job of its own: every row visits its ``probes`` nearest cells only. ``recall`` says what share of the
true neighbours it found. No search chooses between the two.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from gristmill.functions.packed import matrix as _matrix, pack as _pack, vectors as _vectors
from gristmill.plans.joins import hot_join
from gristmill.plans.lineage import remove, settle, shuffles_dropped, small_side, transient

# Task functions travel whole, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 6
# Distances this close may round to the same value, so pruning must keep them.
SLACK = 2e-6
# Bounds on what a task holds: pivots, and rows handled at a time.
MAX_CELLS = 1 << 16
PIVOT_BYTES = 32 << 20
VISIT_ROWS = 1024
CHUNK_ROWS = 32_768
PACK_ROWS = 128
# Vectors of a bundle, or of a chunk of visitors; a search has this many bundles at least, to share the work.
BUNDLE_BYTES = 16 << 20
BUNDLES = 8
# Bytes of vectors that a wave moves: so many, or so many times those of all vectors if that is more.
WAVE_BYTES = 1 << 30
WAVE_TIMES = 4
# Rows of a bundle compared at a time.
RUN_ROWS = 2048
# With more entries in reach than this many times k, a row's k-th is found first.
MANY = 8
# Beyond this share of a product's entries, all of them are computed again at once.
DENSE = 64
# Sample rows for each cell, and rounds of moving pivots to the middle of their rows.
PER_CELL = 4
ROUNDS = 3


@dataclass(frozen=True)
class Tree:
    """Two levels of pivots. Cells of top ``t`` are numbered ``first[t]`` to ``first[t + 1]``."""

    tops: np.ndarray          # tops x dims
    top_near: np.ndarray      # per top: least chord from the pivot to a group under it
    top_far: np.ndarray       # per top: greatest
    first: np.ndarray
    pivots: np.ndarray        # cells x dims
    near: np.ndarray          # per cell: least chord from the pivot to a group
    far: np.ndarray           # per cell: greatest
    blocks: np.ndarray        # per cell: number of blocks
    start: np.ndarray         # per cell: number of its first block
    bundles: np.ndarray       # per bundle: number of its first block


@dataclass(frozen=True)
class VectorIndex:
    """Groups of equal vectors in blocks, on disk, with the tree on the driver."""

    members: DataFrame        # id, grp: every row and the lowest id that has its vector
    groups: DataFrame         # grp, copies, vec, cell, block
    tree: Tree


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, VISIT_ROWS):
            yield batch.slice(start, VISIT_ROWS)


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _distance(sim: np.ndarray) -> np.ndarray:
    return np.round(np.maximum(0.0, 1.0 - sim), DIGITS) + 0.0


def _near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Products of unit vectors in single precision, and how far each may be from the true one, whatever the order of its sum."""
    return a.astype(np.float32) @ b.astype(np.float32).T, (a.shape[1] + 8) * 2.0 ** -24


def _at_least(sim: np.ndarray, room: float, floor: np.ndarray) -> np.ndarray:
    """Places in ``sim`` of all entries that may reach their row's floor; ``sim`` and ``room`` come from ``_near``."""
    return np.flatnonzero(sim >= (floor - room).astype(np.float32)[:, None])


def _again(at: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, product) at some places, in full precision."""
    rows, cols = np.divmod(at, len(b))
    if len(at) > len(a) * len(b) // DENSE:
        return rows, cols, (a @ b.T)[rows, cols]
    return rows, cols, np.einsum("ij,ij->i", a[rows], b[cols])


def _unit(batches):
    """Scale to unit length and append the component for zero vectors."""
    for batch in batches:
        raw = _matrix(batch.column("embedding"))
        norm = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
        zero = norm == 0
        unit = np.hstack([raw / np.where(zero, 1.0, norm), zero.astype(np.float64)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("grp"), batch.column("copies"), _pack(unit)], ["grp", "copies", "vec"])


def _fold_copies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to (id, grp) and one row per distinct vector.

    Equal vectors meet by a 128-bit key; vectors themselves are not shuffled for it.
    """
    keyed = df.select(
        "id", "embedding",
        F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("k2"))
    folded = settle(keyed.groupBy("k1", "k2").agg(F.min("id").alias("grp"), F.count("*").alias("copies")))
    members = hot_join(
        keyed.select("id", "k1", "k2"), folded.select("k1", "k2", "grp"), ["k1", "k2"],
        folded.withColumnRenamed("copies", "n")).select("id", "grp")
    distinct = keyed.select(F.col("id").alias("grp"), "embedding").join(
        folded.select("grp", "copies"), "grp")
    return members, distinct


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest pivot and the chord to it, a bounded slice at a time."""
    found, chords = [], []
    for at in range(0, len(rows), VISIT_ROWS):
        chord = _chords(rows[at:at + VISIT_ROWS], pivots)
        found.append(chord.argmin(axis=1))
        chords.append(chord[np.arange(len(chord)), found[-1]])
    return np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0), *chords])


def _spread_pivots(rows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``n`` unit vectors in the middle of the rows nearest to them."""
    pivots = rows[np.sort(rng.choice(len(rows), min(n, len(rows)), replace=False))]
    for _ in range(ROUNDS):
        place, _ = _nearest(rows, pivots)
        order = np.argsort(place, kind="stable")
        names, heads = np.unique(place[order], return_index=True)
        sums = np.add.reduceat(rows[order], heads, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), pivots[names])
    return pivots


def _grow(sample: np.ndarray, cells: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """tops, first and pivots: as many cells under a top as it has of the sample."""
    rng = np.random.default_rng(seed)
    tops = _spread_pivots(sample, max(1, math.isqrt(cells)), rng)
    place, _ = _nearest(sample, tops)
    under = []
    for t in range(len(tops)):
        rows = sample[place == t]
        under.append(_spread_pivots(rows, max(1, round(cells * len(rows) / len(sample))), rng) if len(rows) else tops[t:t + 1])
    return tops, np.concatenate([[0], np.cumsum([len(u) for u in under])]), np.vstack(under)


def build_index(df: DataFrame, cell_rows: int = 256, block_rows: int = 4096, seed: int = 0) -> VectorIndex:
    """Fold copies, grow the tree on a sample, place every distinct vector in a cell and block."""
    members, distinct = _fold_copies(df.select("id", "embedding"))
    members = settle(members)
    vectors = settle(distinct.mapInArrow(_unit, "grp long, copies long, vec binary"))
    n, size = vectors.agg(F.count("*"), F.coalesce(F.max(F.octet_length("vec")), F.lit(8))).first()
    width = size // 8
    if n <= block_rows:
        # Any pivot will do; the cell's bounds say nothing.
        one = np.zeros((1, width))
        tree = Tree(one, np.zeros(1), np.full(1, np.inf), np.array([0, 1]), one, np.zeros(1), np.full(1, np.inf),
                    np.ones(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))
        return VectorIndex(members, vectors.select("*", F.lit(0).alias("cell"), F.lit(0).alias("block")), tree)
    cells = max(1, min(math.ceil(n / cell_rows), MAX_CELLS, PIVOT_BYTES // (8 * width)))
    tops, first, pivots = _grow(_sampled(vectors, n, PER_CELL * cells, seed), cells, seed)

    def assign(batches):
        for batch in _slices(batches):
            vec = _vectors(batch.column("vec"))
            top, top_chord = _nearest(vec, tops)
            cell, chord = np.empty(len(vec), np.int32), np.empty(len(vec))
            for t in np.unique(top):
                rows = np.flatnonzero(top == t)
                place, chord[rows] = _nearest(vec[rows], pivots[first[t]:first[t + 1]])
                cell[rows] = first[t] + place
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("copies"), batch.column("vec"), pa.array(cell), pa.array(chord), pa.array(top_chord)],
                ["grp", "copies", "vec", "cell", "chord", "top_chord"])

    placed = settle(vectors.mapInArrow(
        assign, "grp long, copies long, vec binary, cell int, chord double, top_chord double"))
    # One row per cell, and cells are bounded by the pivot budget.
    stats = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("chord").alias("near"), F.max("chord").alias("far"),
        F.min("top_chord").alias("top_near"), F.max("top_chord").alias("top_far")).collect()
    near, far = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    top_near, top_far = np.full(len(tops), np.inf), np.full(len(tops), -np.inf)
    blocks, held = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for row in stats:
        near[row.cell], far[row.cell] = row.near, row.far
        t = int(np.searchsorted(first, row.cell, "right")) - 1
        top_near[t], top_far[t] = min(top_near[t], row.top_near), max(top_far[t], row.top_far)
        blocks[row.cell], held[row.cell] = math.ceil(row.n / block_rows), row.n
    start = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    per_cell = df.sparkSession.createDataFrame(
        [(c, int(b), int(s)) for c, (b, s) in enumerate(zip(blocks, start)) if b], "cell int, blocks int, first int")
    block = (F.col("first") + F.pmod(F.xxhash64("grp"), F.col("blocks"))).cast("int")
    groups = settle(placed.join(F.broadcast(per_cell), "cell").select("grp", "copies", "vec", "cell", block.alias("block")))
    return VectorIndex(members, groups, Tree(
        tops, top_near, top_far, first, pivots, near, far, blocks, start, _bundled(blocks, held, width)))


def _most_rows(width: int) -> int:
    return max(1, BUNDLE_BYTES // (8 * width))


def _bundled(blocks: np.ndarray, held: np.ndarray, width: int) -> np.ndarray:
    """The first blocks of bundles of about equal rows; ``held`` are the rows of each cell."""
    rows = np.repeat(held / np.maximum(blocks, 1), blocks)
    bundle = ((np.cumsum(rows) - rows) // min(_most_rows(width), math.ceil(held.sum() / BUNDLES))).astype(np.int64)
    return np.unique(bundle, return_index=True)[1]


def _sampled(vectors: DataFrame, n: int, wanted: int, seed: int) -> np.ndarray:
    """About ``wanted`` vectors chosen by a hash of the group; bounded by the pivot budget."""
    wide = 1 << 30
    share = min(1.0, wanted / n)
    rows = vectors.filter(F.pmod(F.xxhash64(F.lit(seed), "grp"), F.lit(wide)) < int(share * wide)) if share < 1 else vectors
    found = rows.select("grp", "vec").toArrow()
    if not found.num_rows:
        found = vectors.orderBy("grp").limit(1).select("grp", "vec").toArrow()
    return _vectors(found.sort_by("grp").column("vec"))


def restricted(index: VectorIndex, kept: DataFrame) -> VectorIndex:
    """The index without the rows whose id is not in ``kept``; nothing is placed again.

    Tree and blocks stay as they are: the bounds hold for any part of the rows.
    """
    left = settle(index.members.join(kept.select("id"), "id", "left_semi"))
    # A group that lost its lowest id is named by the lowest that stays.
    now = settle(left.groupBy("grp").agg(F.min("id").alias("now"), F.count("*").alias("copies")))
    members = hot_join(left, now.select("grp", "now"), ["grp"], now.select("grp", F.col("copies").alias("n")))
    groups = index.groups.drop("copies").join(now, "grp").select(F.col("now").alias("grp"), "copies", "vec", "cell", "block")
    return VectorIndex(settle(members.select("id", F.col("now").alias("grp"))), settle(groups), index.tree)


def _by_cell(groups: DataFrame) -> DataFrame:
    """Neighbouring groups together, so that a slice of rows has few blocks to visit."""
    return groups.repartitionByRange("cell", "block").sortWithinPartitions("cell", "block")


def _packed_blocks(index: VectorIndex, wave: tuple[int, int]) -> DataFrame:
    """One row per block of a wave's bundles: its bundle, groups, copies and vectors, each packed."""
    bundles = index.tree.bundles
    first, last = int(bundles[wave[0]]), int(np.append(bundles, int(index.tree.blocks.sum()))[wave[1]]) - 1

    def pack(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = [table.column(c).to_numpy().tobytes() for c in ("grp", "copies")]
        block = keys[0].as_py()
        bundle = int(np.searchsorted(bundles, block, "right")) - 1
        return pa.table({"bundle": pa.array([bundle], pa.int32()), "block": pa.array([block], pa.int32()),
                         "grps": [columns[0]], "copies": [columns[1]], "vecs": [_vectors(table.column("vec")).tobytes()]})

    return index.groups.filter(F.col("block").between(first, last)).groupBy("block").applyInArrow(pack, "bundle int, block int, grps binary, copies binary, vecs binary")


def _nearest_k(vecs: np.ndarray, block: np.ndarray, wants: tuple[np.ndarray, np.ndarray] | None, visitors: np.ndarray, grps: np.ndarray, k: int, reach: np.ndarray):
    """(row, column, distance) of each row's ``k`` nearest by (distance, group), within its reach and without itself.

    Only entries that may still count are computed in full, rounded and sorted. ``wants`` says which blocks each row wants
    and which block each column is of (None: all).
    """
    floor = 1.0 - reach - SLACK
    sim, room = _near(vecs, block)
    at = _at_least(sim, room, floor)
    if len(at) > MANY * (k + 1) * len(sim) and sim.shape[1] > k + 1:
        if wants is not None:
            sim[~wants[0][:, wants[1]]] = -3.0
        # The row itself may be among the k + 1.
        kth = np.partition(sim, sim.shape[1] - k - 1, axis=1)[:, sim.shape[1] - k - 1]
        at = _at_least(sim, room, np.maximum(floor, kth.astype(np.float64) - room - SLACK))
    rows, cols, found = _again(at, vecs, block)
    d = _distance(found)
    real = (d <= reach[rows]) & (visitors[rows] != grps[cols])
    if wants is not None:
        real &= wants[0][rows, wants[1][cols]]
    rows, cols, d = rows[real], cols[real], d[real]
    order = np.lexsort((grps[cols], d, rows))
    rows, cols, d = rows[order], cols[order], d[order]
    starts = np.r_[0, np.cumsum(np.bincount(rows, minlength=len(sim)))][:-1]
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep], d[keep]


def _least_chords(chord: np.ndarray, pivots: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """A lower bound of each row's chord to anything that belongs to each pivot.

    What belongs to a pivot lies between two spheres around it, and on its side of the plane between it and the pivot
    nearest to the row.
    """
    closest = chord.argmin(axis=1)
    own = chord[np.arange(len(chord)), closest]
    names, place = np.unique(closest, return_inverse=True)
    gap = _chords(pivots[names], pivots)[place]
    plane = np.where(gap > 1e-6, (chord**2 - own[:, None]**2) / (2.0 * np.maximum(gap, 1e-6)), 0.0)
    return np.maximum.reduce([np.zeros_like(chord), chord - far, near - chord, plane])


def _wanted_cells(tree: Tree, vec: np.ndarray, reach: np.ndarray, asked: np.ndarray):
    """(cell, rows) of every cell asked for that may hold something within a row's reach."""
    least = _least_chords(_chords(vec, tree.tops), tree.tops, tree.top_near, tree.top_far)
    may = least**2 / 2.0 <= reach[:, None] + SLACK
    for t in np.flatnonzero(may.any(axis=0)):
        rows, inside = np.flatnonzero(may[:, t]), slice(tree.first[t], tree.first[t + 1])
        if not asked[inside].any():
            continue
        least = _least_chords(_chords(vec[rows], tree.pivots[inside]), tree.pivots[inside], tree.near[inside], tree.far[inside])
        open_ = (least**2 / 2.0 <= reach[rows, None] + SLACK) & asked[inside] & (tree.blocks[inside] > 0)
        for c in np.flatnonzero(open_.any(axis=0)):
            yield int(tree.first[t] + c), rows[open_[:, c]]


def _probed_cells(tree: Tree, vec: np.ndarray, probes: int, tops: int, asked: np.ndarray):
    """(cell, rows): for each row its ``probes`` nearest cells under its ``tops`` nearest tops, as far as they are asked for."""
    chord = _chords(vec, tree.tops)
    chord[:, tree.top_far < 0] = np.inf
    chosen = np.argsort(chord, axis=1)[:, :tops]
    cells, chords = [], []
    for t in np.unique(chosen):
        if np.isneginf(tree.top_far[t]):
            continue
        inside = np.arange(tree.first[t], tree.first[t + 1])
        inside = inside[tree.blocks[inside] > 0]
        found = _chords(vec, tree.pivots[inside])
        found[~(chosen == t).any(axis=1)] = np.inf
        cells.append(inside)
        chords.append(found)
    cells, chords = np.concatenate(cells), np.hstack(chords)
    nearest = np.argsort(chords, axis=1, kind="stable")[:, :probes]
    rows = np.repeat(np.arange(len(vec)), nearest.shape[1])
    real = np.isfinite(chords[rows, nearest.ravel()])
    rows, wanted = rows[real], cells[nearest.ravel()[real]]
    for c in np.unique(wanted[asked[wanted]]):
        yield int(c), rows[wanted == c]


def _visits(
    index: VectorIndex, rows: DataFrame, cells_of, include_home: bool, counts: bool = False, bundles: np.ndarray | None = None,
    wave: tuple[int, int] | None = None,
) -> DataFrame:
    """Which bundles each row visits: packed rows of one target bundle and many visitors, or just their number.

    ``rows`` carries ``reach``, the cosine distance beyond which nothing is wanted. ``wanted`` has a bit for each block of the
    bundle. Every block is a bundle of its own where ``bundles``, their first blocks, are not given. Bundles outside ``wave`` are left out.
    """
    tree = index.tree
    n_blocks = int(tree.blocks.sum())
    starts = np.arange(n_blocks) if bundles is None else bundles
    ends = np.append(starts[1:], n_blocks)
    low, high = wave or (0, len(starts))

    def visited(batch):
        """(bundle, rows, wanted) for each bundle that rows of the batch visit."""
        bundle_of = np.searchsorted(starts, np.arange(n_blocks), "right") - 1
        home, vec = batch.column("block").to_numpy(), _vectors(batch.column("vec"))
        now, wanted = -1, np.zeros((len(vec), 0), bool)
        asked = (tree.start + tree.blocks > starts[low]) & (tree.start < ends[high - 1])
        # Cells come in order, and so do their blocks.
        for cell, inside in cells_of(tree, vec, batch.column("reach").to_numpy(zero_copy_only=False), asked):
            for block in range(max(tree.start[cell], starts[low]), min(tree.start[cell] + tree.blocks[cell], ends[high - 1])):
                if bundle_of[block] != now:
                    if wanted.any():
                        yield now, np.flatnonzero(wanted.any(axis=1)), wanted
                    now = int(bundle_of[block])
                    wanted = np.zeros((len(vec), ends[now] - starts[now]), bool)
                wanted[inside if include_home else inside[home[inside] != block], block - starts[now]] = True
        if wanted.any():
            yield now, np.flatnonzero(wanted.any(axis=1)), wanted

    def count(batches):
        total = np.zeros(len(starts), np.int64)
        for batch in _slices(batches):
            for bundle, inside, _ in visited(batch):
                total[bundle] += len(inside)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bundle", "n"])

    def body(batches):
        for batch in _slices(batches):
            grp, vec = batch.column("grp").to_numpy(), _vectors(batch.column("vec"))
            reach = batch.column("reach").to_numpy(zero_copy_only=False)
            for bundle, inside, wanted in visited(batch):
                out = [(bundle, grp[p].tobytes(), reach[p].tobytes(), vec[p].tobytes(), np.packbits(wanted[p], axis=1).tobytes())
                       for p in (inside[at:at + PACK_ROWS] for at in range(0, len(inside), PACK_ROWS))]
                names, *packed = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), *(pa.array(v, pa.binary()) for v in packed)],
                    ["bundle", "visitors", "reach", "vecs", "wanted"])

    if counts:
        return _by_cell(rows).mapInArrow(count, "bundle int, n long")
    return _by_cell(rows).mapInArrow(body, "bundle int, visitors binary, reach binary, vecs binary, wanted binary")


def _waves(chunks: dict[int, int], chunk_rows: int, n_bundles: int, vectors: float, held: float) -> list[tuple[int, int]]:
    """Ranges of bundles whose visits and copies move a bounded number of vectors, a bundle at least.

    ``vectors`` are allowed, and a bundle has ``held``.
    """
    waves, low, moved = [], 0, 0.0
    for bundle in range(n_bundles):
        more = chunks.get(bundle, 0) * (chunk_rows + held)
        if moved and moved + more > vectors:
            waves.append((low, bundle))
            low, moved = bundle, 0.0
        moved += more
    return [*waves, (low, n_bundles)]


def _meet(index: VectorIndex, rows: DataFrame, cells_of, include_home: bool, solve, schema: str, fold=lambda found: found) -> DataFrame:
    """Apply ``solve(visitors, reach, vecs, runs)`` to each bundle and slices of its visitors.

    ``runs`` yields (rows, grps, copies, block_vecs, wants): the visitors that want something of a few blocks, those blocks' rows,
    and which of the blocks each wants, with the block of each row (None: all). A bundle travels once per chunk of visitors, ``CHUNK_ROWS`` or as many as fill ``BUNDLE_BYTES``.
    The chunks of a bundle are dealt over as many tasks. For that the visits are counted first and
    made again, which costs little beside the products and spares writing the visitors down. ``fold`` folds what units of work found, and folds it again
    with what another wave found.
    """
    spark, tree = rows.sparkSession, index.tree
    starts, n_blocks = tree.bundles, int(tree.blocks.sum())
    chunk_rows = min(CHUNK_ROWS, _most_rows(tree.pivots.shape[1]))
    counts = _visits(index, rows, cells_of, include_home, True, starts).groupBy("bundle") \
        .agg(F.ceil(F.sum("n") / chunk_rows).cast("int").alias("chunks")).filter("chunks > 0")
    counts = settle(counts)
    sizes = small_side(counts, 300_000)
    chunk = F.pmod(F.xxhash64("visitors"), F.col("chunks")).cast("int").alias("chunk")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:  # a bundle that holds nothing any more
            return pa.table({n: pa.array([], pa.float64() if n == "d" else pa.int64()) for n in names})
        at = keys[0].as_py()
        n_wanted = int(np.append(starts, n_blocks)[at + 1] - starts[at])
        visitors, reach, vecs, bits = (
            np.frombuffer(b"".join(left.column(c).to_pylist()), kind)
            for c, kind in (("visitors", np.int64), ("reach", np.float64), ("vecs", np.float64), ("wanted", np.uint8)))
        vecs, bits = vecs.reshape(len(visitors), -1), bits.reshape(len(visitors), -1)
        right = right.sort_by("block")
        place = right.column("block").to_numpy() - starts[at]
        grps, copies, all_vecs = (
            [np.frombuffer(v, kind) for v in right.column(c).to_pylist()]
            for c, kind in (("grps", np.int64), ("copies", np.int64), ("vecs", np.float64)))
        held = np.array([len(g) for g in grps])
        run_of = (np.cumsum(held) - held) // RUN_ROWS
        cuts = [np.flatnonzero(run_of == r) for r in np.unique(run_of)]
        cuts = [(place[c], held[c], *(np.concatenate([parts[i] for i in c]) for parts in (grps, copies, all_vecs))) for c in cuts]

        def runs(bits):
            wanted = np.unpackbits(bits, axis=1, count=n_wanted).astype(bool)
            for blocks, sizes, names, copies, flat in cuts:
                mine = wanted[:, blocks]
                rows = np.flatnonzero(mine.any(axis=1))
                if len(rows):
                    wants = None if mine[rows].all() else (mine[rows], np.repeat(np.arange(len(sizes)), sizes))
                    yield rows, names, copies, flat.reshape(len(names), -1), wants

        parts = [solve(visitors[i:i + VISIT_ROWS], reach[i:i + VISIT_ROWS], vecs[i:i + VISIT_ROWS], runs(bits[i:i + VISIT_ROWS]))
                 for i in range(0, len(visitors), VISIT_ROWS)]
        return pa.table({n: np.concatenate([p[j] for p in parts]) for j, n in enumerate(names)})

    def met(wave: tuple[int, int]) -> DataFrame:
        visits = _visits(index, rows, cells_of, include_home, False, starts, wave)
        dealt = visits.join(sizes, "bundle").select("bundle", chunk, "visitors", "reach", "vecs", "wanted")
        blocks = _packed_blocks(index, wave).join(sizes, "bundle").select(
            "bundle", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "block", "grps", "copies", "vecs")
        return dealt.groupBy("bundle", "chunk").cogroup(blocks.groupBy("bundle", "chunk")).applyInArrow(run, schema)

    # One row per bundle.
    chunks, n = {r.bundle: r.chunks for r in counts.collect()}, index.groups.count()
    allowed = max(WAVE_BYTES / (8 * tree.pivots.shape[1]), WAVE_TIMES * n)
    waves = _waves(chunks, min(chunk_rows, n), len(starts), allowed, n / len(starts))
    if len(waves) == 1:
        return fold(met(waves[0]))
    kept, path = None, None
    for wave in waves:
        found = met(wave) if kept is None else kept.unionByName(met(wave))
        path, before = transient(spark), path
        with shuffles_dropped(spark):
            fold(found).write.parquet(path)
        kept = spark.read.schema(found.schema).parquet(path)
        if before:
            remove(spark, before)
    return kept


def _solver(k: int):
    """The nearest ``k`` of a bundle for each visitor, within its reach and without itself."""
    def solve(visitors, reach, vecs, runs):
        reach = reach.copy()
        row, other, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for rows, grps, _, block, wants in runs:
            r, c, far = _nearest_k(vecs[rows], block, wants, visitors[rows], grps, k, reach[rows])
            if not len(r):
                continue
            row, other, d = np.append(row, rows[r]), np.append(other, grps[c]), np.append(d, far)
            order = np.lexsort((other, d, row))
            row, other, d = row[order], other[order], d[order]
            counts = np.bincount(row, minlength=len(visitors))
            keep = np.arange(len(row)) - (np.cumsum(counts) - counts)[row] < k
            row, other, d = row[keep], other[keep], d[keep]
            # From here on only what is no farther than a row's k-th counts.
            full = np.flatnonzero(counts >= k)
            last = np.cumsum(np.minimum(counts, k)) - 1
            reach[full] = np.minimum(reach[full], d[last[full]])
        return visitors[row], other, d
    return solve


_PAIRS = "grp long, other long, d double"


def _candidates(index: VectorIndex, k: int) -> DataFrame:
    """(grp, other, d): the ``k`` nearest other groups of each group."""

    def solve_block(table):
        grp, vec = table.column("grp").to_numpy(), _vectors(table.column("vec"))
        parts = []
        for at in range(0, len(grp), VISIT_ROWS):
            mine, everywhere = grp[at:at + VISIT_ROWS], np.full(len(grp[at:at + VISIT_ROWS]), 2.0)
            rows, cols, d = _nearest_k(vec[at:at + VISIT_ROWS], vec, None, mine, grp, k, everywhere)
            parts.append((mine[rows], grp[cols], d))
        return pa.table({n: np.concatenate([p[j] for p in parts]) for j, n in enumerate(("grp", "other", "d"))})

    near_home = index.groups.groupBy("block").applyInArrow(solve_block, _PAIRS)
    if int(index.tree.blocks.sum()) <= 1:
        return near_home

    near_home = settle(near_home)
    # With fewer than k neighbours at home there is no bound yet: reach is the full range.
    reach = near_home.groupBy("grp").agg(
        F.when(F.count("*") >= k, F.max("d")).otherwise(F.lit(2.0)).alias("reach"))
    rows = index.groups.join(reach, "grp", "left").select(
        "grp", "vec", "cell", "block", F.coalesce("reach", F.lit(2.0)).alias("reach"))
    rows = settle(rows)
    abroad = _meet(index, rows, _wanted_cells, False, _solver(k), _PAIRS, lambda found: _best(found, k))
    return _best(near_home.unionByName(abroad), k)


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each group's candidates."""
    best = F.row_number().over(Window.partitionBy("grp").orderBy("d", "other"))
    return candidates.withColumn("rank", best).filter(F.col("rank") <= k).drop("rank")


def _copies(index: VectorIndex) -> DataFrame:
    return index.groups.select("grp", F.col("copies").alias("n"))


def knn(index: VectorIndex, k: int = 10) -> DataFrame:
    """(id, neighbours): the ``k`` nearest other rows of every row as an ordered array of
    (d, id), by rounded distance, then id."""
    return _neighbour_lists(index, _candidates(index, k), k)


def approximate_knn(index: VectorIndex, k: int = 10, probes: int = 8, tops: int = 3) -> DataFrame:
    """As ``knn`` among the rows of each row's ``probes`` nearest cells, under its ``tops`` nearest tops.

    One pass whose work grows with the rows, whatever the data; ``recall`` measures what it misses.
    """
    if probes < 1 or tops < 1:
        raise ValueError("at least one cell must be probed")
    rows = index.groups.select("grp", "vec", "cell", "block", F.lit(2.0).alias("reach"))
    cells_of = lambda tree, vec, reach, asked: _probed_cells(tree, vec, probes, tops, asked)
    found = _meet(index, rows, cells_of, True, _solver(k), _PAIRS, lambda found: _best(found, k))
    return _neighbour_lists(index, found, k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: neighbours in ``truth``, those among them that ``found`` has at no greater distance, and their share.

    Rows at equal distance stand for each other, so a tie at the end of a list is no miss.
    """
    nearest = found.select("id", F.col("neighbours").alias("got"))
    within = F.filter("got", lambda x: x["d"] <= F.array_max(F.transform("neighbours", lambda y: y["d"])))
    return truth.join(nearest, "id", "left").agg(
        F.sum(F.size("neighbours")).alias("wanted"),
        F.sum(F.when(F.size("neighbours") > 0, F.coalesce(F.size(within), F.lit(0))).otherwise(0)).alias("found")
    ).withColumn("recall", F.try_divide("found", "wanted"))


def _neighbour_lists(index: VectorIndex, candidates: DataFrame, k: int) -> DataFrame:
    # The k + 1 lowest ids of each group: enough to fill a list after leaving out the row itself.
    lowest = F.row_number().over(Window.partitionBy("grp").orderBy("id"))
    heads = index.members.withColumn("rank", lowest).filter(F.col("rank") <= k + 1) \
        .groupBy("grp").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    own = index.groups.select("grp", F.col("grp").alias("other"), F.lit(0.0).alias("d"))
    wanted = settle(own.unionByName(candidates))
    # A vector in the middle of many others is wanted by all of them.
    wanted_by = wanted.groupBy("other").agg(F.count("*").alias("n"))
    members_of = hot_join(wanted, heads.withColumnRenamed("grp", "other"), ["other"], wanted_by, deal_by="grp")
    # k + 1 groups at most, each with k + 1 ids at most.
    lists = members_of.select("grp", "d", F.explode("ids").alias("id")).groupBy("grp").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("d", "id"))), 1, k + 1).alias("near"))
    others = F.filter("near", lambda x: x["id"] != F.col("id"))
    return hot_join(index.members, lists, ["grp"], _copies(index)).select(
        "id", F.slice(others, 1, k).alias("neighbours"))


def within(index: VectorIndex, radius: float) -> DataFrame:
    """(id, others, first_other): how many other rows lie within ``radius`` of each row, and
    the lowest id among them (null when alone).

    Counts and minima are folded inside each task, so the number of close pairs does not
    matter.
    """
    rows = index.groups.select("grp", "vec", "cell", "block", F.lit(float(radius)).alias("reach"))

    def fold(visitors, reach, vecs, runs):
        total, first = np.zeros(len(visitors), np.int64), np.full(len(visitors), np.iinfo(np.int64).max)
        for rows, grps, copies, block, _ in runs:
            mine = vecs[rows]
            at, cols, sim = _again(_at_least(*_near(mine, block), 1.0 - reach[rows] - SLACK), mine, block)
            close = (_distance(sim) <= radius) & (visitors[rows[at]] != grps[cols])
            at, cols = rows[at[close]], cols[close]
            np.add.at(total, at, copies[cols])
            np.minimum.at(first, at, grps[cols])
        found = total > 0
        return visitors[found], total[found], first[found]

    folded = _meet(index, rows, _wanted_cells, True, fold, "grp long, rows long, first long", lambda found: found.groupBy("grp").agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first")))
    around = index.groups.select("grp", "copies").join(folded, "grp", "left")
    others = F.col("copies") - 1 + F.coalesce("rows", F.lit(0))
    # A row that is not the lowest of its own group has that group's id as a neighbour too.
    own = F.when(F.col("id") != F.col("grp"), F.col("grp"))
    second = index.members.filter("id <> grp").groupBy("grp").agg(F.min("id").alias("second"))
    own_first = F.when(F.col("id") == F.col("grp"), F.col("second")).otherwise(own)
    facts = around.join(second, "grp", "left")
    return hot_join(index.members, facts, ["grp"], _copies(index)).select(
        "id", others.alias("others"), F.least(own_first, F.col("first")).alias("first_other"))
