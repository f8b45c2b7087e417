"""Aligning the tokens of two tokenizers, with pair counts over the whole corpus.

Each text is encoded by a byte-level BPE (side A) and a piece model (side B). Tokens whose bytes overlap are linked, ends that both sides
share cut a text into groups, and every link is weighed by how often its pair of ids is linked in the whole corpus. Pairs are
counted outside memory:

1. *Runs.* A task encodes texts in shards of about ``SHARD_BYTES`` and folds the links of a shard to (pair, document, links)
   records. They are radix-partitioned by the B id into ``BUCKETS`` buckets. The records of one shard and bucket, sorted by B id,
   then A id, then document, are written as one run: zstd blocks of pairs (the head) and of records (the body). The runs are a table
   in the shared folder.
2. *Counting.* The runs of a bucket are dealt into lanes of bounded size, so no bucket, however common its tokens, is one
   task. A lane merges the heads of its runs by a heap over their blocks, and the lanes' totals are summed.
3. *Contributions.* Each lane reads its runs once more beside the totals of its bucket. In B-major order the pairs of one B id stand
   together, so its highest count is a running maximum. Every record then adds its links' counts to its document: what
   leaves is one packed array per run, summed per shard.

A text over ``PIECE_CHARS`` is encoded in pieces. They are cut where a letter is followed by a space and a letter: there the pattern
of A ends a word, and no piece of B runs across (the model is checked for that), so the tokens are those of the whole text. Such a
text is encoded twice, first to see that all its bytes come back.

Texts that are null, empty or whose bytes don't come back from both sides have no tokens: zeros, and the empty string for groups.
Rows are told apart by row, so equal ids, null ids and repeated rows each count. Extra columns are ignored. The vocabulary files are
read by the driver and broadcast (a few megabytes).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from gristmill.llm.common import dealt, ship, with_row
from gristmill.plans.lineage import settle

ship(__name__)

FILE_A = "/opt/tokenizers/byte_bpe_50k.json"
FILE_B = "/opt/tokenizers/piece_bpe_32k.model"
BUCKETS = 64
SHARD_BYTES = 2 << 20
PIECE_CHARS = 1 << 18
BLOCK_PAIRS = 8_192
LANE_BYTES = 16 << 20
FAN_IN = 64
# A shard has fewer documents than this.
PLACES = 1 << 20

# How byte-level BPE splits texts, and the settings of a file that does no more than that.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
               "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
PLAIN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
# Words longer than this are merged by the library whose time doesn't grow with their square.
LONG_WORD = 400

_LONG_GAP = re.compile(r"\s{%d}" % LONG_WORD)
_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


# ---- the two sides ------------------------------------------------------------------------------

def byte_of_character() -> dict[str, int]:
    """Byte-level alphabets show printable bytes as themselves and number the others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def rank_encoder(file: bytes, back: dict[str, int]):
    """A byte-level BPE file as a rank encoder, which is several times faster; None if it is anything else.

    Merges in the order of their ids are ranks, so both give the same tokens.
    """
    import tiktoken

    data = json.loads(file)
    model, split = data["model"], data["pre_tokenizer"] or {}
    vocab = model.get("vocab", {})
    merged_ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
    plain = (data["normalizer"] is None and not any(model.get(k) not in (v, None) for k, v in PLAIN_MODEL.items())
             and all(split.get(k) == v for k, v in PLAIN_SPLIT.items())
             and all(x < y for x, y in zip(merged_ids, merged_ids[1:])))
    if not plain:
        return None
    wanted = {*merged_ids, *(i for token, i in vocab.items() if len(token) == 1)}
    ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if i in wanted}
    return tiktoken.Encoding("side_a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Sides:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, file_a: bytes, file_b: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(file_a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        back = byte_of_character()
        self.fast = rank_encoder(file_a, back)
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode("utf-8")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in enumerate(pieces)]
        self.divides = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)

    def encode(self, pieces: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides for pieces that begin with a space; None where the bytes don't come back."""
        found = [self.encode_a(p) for p in pieces]
        others = self.b.encode([p[1:] for p in pieces], num_threads=1)
        out = []
        for piece, ids, second in zip(pieces, found, others):
            raw = piece.encode("utf-8")
            same = b"".join(map(self.bytes_a.__getitem__, ids)) == raw == b"".join(map(self.bytes_b.__getitem__, second))
            out.append((ids, second) if same else None)
        return out

    def encode_a(self, piece: str) -> list[int]:
        if self.fast is None or max(map(len, piece.split()), default=0) > LONG_WORD or _LONG_GAP.search(piece):
            return self.a.encode(piece, add_special_tokens=False).ids
        return self.fast.encode_ordinary(piece)

    def pieces(self, text: str) -> list[str]:
        """``text`` after a space, cut into pieces that can be encoded apart."""
        whole, out, start = " " + text, [], 0
        while self.divides and len(whole) - start > PIECE_CHARS:
            cut = _CUT.search(whole, start + PIECE_CHARS)
            if not cut:
                break
            out.append(whole[start:cut.start()])
            start = cut.start()
        return [*out, whole[start:]]


def opened(sent) -> Sides:
    """The broadcast files as tokenizers, built once per worker."""
    held = sent.value
    if "sides" not in held:
        held["sides"] = Sides(held["a"], held["b"])
    return held["sides"]


# ---- one shard ----------------------------------------------------------------------------------

def decimal(ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids in decimal, each followed by its mark, and where each ends."""
    width = len(str(int(ids.max(initial=0))))
    digits = np.empty((len(ids), width + 1), np.uint8)
    shown = np.ones((len(ids), width + 1), bool)
    for k in range(width):
        power = 10 ** (width - 1 - k)
        digits[:, k] = 48 + ids // power % 10
        if power > 1:
            shown[:, k] = ids >= power
    digits[:, width] = marks
    return digits[shown].tobytes(), np.cumsum(shown.sum(axis=1))


class Shard:
    """Tokens of some pieces (pairs of id lists), aligned."""

    def __init__(self, encoded: list[tuple[list[int], list[int]]], size_a: np.ndarray, size_b: np.ndarray):
        n = len(encoded)
        count_a = np.array([len(a) for a, _ in encoded], np.int64)
        count_b = np.array([len(b) for _, b in encoded], np.int64)
        ids_a = np.fromiter(chain.from_iterable(a for a, _ in encoded), np.int64, int(count_a.sum()))
        ids_b = np.fromiter(chain.from_iterable(b for _, b in encoded), np.int64, int(count_b.sum()))
        ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        stops_a, stops_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        stops_a[ends_a], stops_b[ends_b] = True, True
        closes_a, closes_b = stops_b[ends_a], stops_a[ends_b]

        at_byte = np.repeat(np.arange(len(ids_b), dtype=np.int32), size_b[ids_b])
        first = at_byte[ends_a - size_a[ids_a]].astype(np.int64)
        links = at_byte[ends_a - 1] - first + 1
        piece_a = np.repeat(np.arange(n), count_a)
        left = np.repeat(np.arange(len(ids_a)), links)
        right = np.arange(len(left)) + np.repeat(first - (np.cumsum(links) - links), links)
        self.pairs = ids_b[right] * len(size_a) + ids_a[left]
        self.places = piece_a[left]
        self.n_a, self.n_b = count_a, count_b
        self.n_groups = np.bincount(piece_a[closes_a], minlength=n)
        self.n_links = np.bincount(self.places, minlength=n)

        # Group by group, the tokens of A and then those of B.
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        last_a, last_b = np.flatnonzero(closes_a), np.flatnonzero(closes_b)
        before_b = np.concatenate([[0], last_b[:-1] + 1])
        to_a = np.arange(len(ids_a)) + (before_b[group_a] if len(ids_a) else 0)
        to_b = np.arange(len(ids_b)) + (last_a[group_b] + 1 if len(ids_b) else 0)
        ids, marks = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
        ids[to_a], ids[to_b] = ids_a, ids_b
        marks[to_a] = np.where(closes_a, ord("|"), ord(","))
        marks[to_b] = np.where(closes_b, ord(";"), ord(","))
        self._text, ends = decimal(ids, marks)
        self._cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count_a + count_b)])]

    def groups(self, piece: int) -> bytes:
        """The groups of one piece, each closed by a semicolon."""
        return self._text[self._cuts[piece]:self._cuts[piece + 1]]

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, place, links), in the order of pair and place."""
        keys = np.sort(self.pairs.astype(np.uint64) * np.uint64(PLACES) + self.places.astype(np.uint64))
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        folded = keys[heads]
        return ((folded // np.uint64(PLACES)).astype(np.int64), (folded % np.uint64(PLACES)).astype(np.int64),
                np.diff(np.append(heads, len(keys))))


# ---- runs ---------------------------------------------------------------------------------------

def packed(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """A zstd block of keys, as steps that may wrap around, and of other numbers below 2^32."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return zstandard.ZstdCompressor(level=3).compress(steps.tobytes() + b"".join(c.astype(np.uint32).tobytes() for c in others))


def unpacked(block: bytes, kind: type, others: int) -> list[np.ndarray]:
    """The keys, of type ``kind``, and the other columns of a block."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    size = np.dtype(kind).itemsize
    n = len(raw) // (size + 4 * others)
    rest = np.frombuffer(raw, np.uint32, offset=size * n).astype(np.int64)
    return [np.cumsum(np.frombuffer(raw, kind, n), dtype=kind).astype(np.int64), *(rest[k * n:(k + 1) * n] for k in range(others))]


def run_blocks(pairs: np.ndarray, places: np.ndarray, links: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Head blocks (pair, links, records) and body blocks (place, links) of sorted records."""
    heads = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    sums, sizes = np.add.reduceat(links, heads), np.diff(np.append(heads, len(pairs)))
    head, body = [], []
    for at in range(0, len(heads), BLOCK_PAIRS):
        end = min(at + BLOCK_PAIRS, len(heads))
        low, high = heads[at], heads[end] if end < len(heads) else len(pairs)
        head.append(packed(pairs[heads[at:end]].astype(np.uint64), sums[at:end], sizes[at:end]))
        body.append(packed(places[low:high].astype(np.uint32), links[low:high]))
    return head, body


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge streams of sorted (keys, counts) blocks; equal keys are summed.

    A heap over the last keys of the blocks in hand says how far all of them reach; everything up
    to there is complete. Only one block of each stream is held.
    """
    if len(runs) > FAN_IN:
        runs = [merged(runs[i:i + FAN_IN]) for i in range(0, len(runs), FAN_IN)]
        yield from merged(runs)
        return
    held, heap = {}, []

    def load(i: int) -> None:
        block = next(runs[i], None)
        if block is not None:
            held[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        load(i)
    while heap:
        limit, parts = heap[0][0], []
        for i, (keys, counts) in list(held.items()):
            cut = int(np.searchsorted(keys, limit, "right"))
            if cut:
                parts.append((keys[:cut], counts[:cut]))
                held[i] = keys[cut:], counts[cut:]
        while heap and heap[0][0] == limit:
            i = heapq.heappop(heap)[1]
            del held[i]
            load(i)
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield keys[heads], np.add.reduceat(counts, heads)


# ---- jobs ---------------------------------------------------------------------------------------

LISTED = ("shard long, place int, row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, sha string, "
          "bucket int, documents int, head array<binary>, body array<binary>")


def listed(source: DataFrame, sent) -> DataFrame:
    """A row per piece of a document (``place`` set) and a row per run (``bucket`` set)."""
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, state = opened(sent), {}
        schema = None
        for batch in batches:
            rows, ids = batch.column("row").to_pylist(), batch.column("id")
            names = ["shard", "place", "row", "id", "n_a", "n_b", "n_groups", "n_links", "sha",
                     "bucket", "documents", "head", "body"]
            schema = schema or pa.schema(list(zip(names, [
                pa.int64(), pa.int32(), pa.int64(), ids.type, *[pa.int64()] * 4, pa.string(),
                pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.binary())])))
            for entries, encoded in shards(sides, batch.column("text")):
                yield piece_rows(schema, sides, entries, encoded, rows, ids, state)
                if encoded:
                    yield run_rows(schema, state["shard"], state["name"])

    def shards(sides: Sides, column: pa.Array) -> Iterator[tuple[list, list]]:
        """Entries (row, last piece, slot of its ids or None) and id lists, about ``SHARD_BYTES`` at a time."""
        entries, encoded, size, waiting = [], [], 0, []

        def flush_waiting() -> None:
            for (i, last, _), found in zip(waiting, sides.encode([p for _, _, p in waiting])):
                entries.append((i, last, None if found is None else len(encoded)))
                if found is not None:
                    encoded.append(found)
            waiting.clear()

        small = 0
        for i, value in enumerate(column):
            raw = value.as_py()
            text = (raw or b"").decode("utf-8", "replace")
            if not text or ("\ufffd" in text and text.encode("utf-8") != raw):  # null, empty, or no UTF-8
                entries.append((i, True, None))
                continue
            pieces = sides.pieces(text)
            if len(pieces) > 1:
                if any(sides.encode([p])[0] is None for p in pieces):
                    entries.append((i, True, None))
                    continue
            for k, piece in enumerate(pieces):
                waiting.append((i, k == len(pieces) - 1, piece))
                small += len(piece)
                size += len(piece)
                if small >= PIECE_CHARS:
                    flush_waiting()
                    small = 0
                if size >= SHARD_BYTES:
                    flush_waiting()
                    yield entries, encoded
                    entries, encoded, size, small = [], [], 0, 0
        flush_waiting()
        if entries:
            yield entries, encoded

    def piece_rows(schema, sides, entries, encoded, rows, ids, state) -> pa.RecordBatch:
        shard = Shard(encoded, sides.size_a, sides.size_b)
        # A row's number times its first piece's: a name no other shard has.
        name = hash_name(rows[entries[0][0]], state)
        state.update(shard=shard, name=name)
        sha, counts = [], np.zeros((4, len(entries)), np.int64)
        for k, (i, last, slot) in enumerate(entries):
            if slot is None:
                sha.append("" if last else None)
                continue
            counts[:, k] = shard.n_a[slot], shard.n_b[slot], shard.n_groups[slot], shard.n_links[slot]
            groups = shard.groups(slot)
            digest = state.pop("digest", None) or hashlib.sha256()
            digest.update(groups[:-1] if last else groups)
            if not last:
                state["digest"] = digest
            sha.append(digest.hexdigest() if last else None)
        at = pa.array([e[0] for e in entries])
        n = len(entries)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.int64()), pa.array([-1 if e[2] is None else e[2] for e in entries], pa.int32()),
             pa.array([rows[e[0]] for e in entries], pa.int64()), ids.take(at), *(pa.array(c) for c in counts),
             pa.array(sha, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.list_(pa.binary()))], schema=schema)

    def hash_name(row: int, state: dict) -> int:
        """The first row's number, and how many shards this row has begun."""
        begun = state.get("begun", (None, 0))
        state["begun"] = (row, begun[1] + 1 if begun[0] == row else 0)
        return int.from_bytes(hashlib.blake2b(b"%d:%d" % (row, state["begun"][1]), digest_size=8).digest(), "little", signed=True)

    def run_rows(schema, shard: Shard, name: int) -> pa.RecordBatch:
        pairs, places, links = shard.records()
        bucket = (pairs // len_a % BUCKETS).astype(np.uint8 if BUCKETS <= 256 else np.uint16)
        order = np.argsort(bucket, kind="stable")
        pairs, places, links, bucket = pairs[order], places[order], links[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(BUCKETS + 1))
        found = [(b, *run_blocks(pairs[x:y], places[x:y], links[x:y]))
                 for b, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, schema.field("id").type),
             *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.string()), pa.array([f[0] for f in found], pa.int32()),
             pa.array([len(shard.n_a)] * n, pa.int32()), pa.array([f[1] for f in found], pa.list_(pa.binary())),
             pa.array([f[2] for f in found], pa.list_(pa.binary()))], schema=schema)

    len_a = opened(sent).size_a.shape[0]
    return source.mapInArrow(run, LISTED.format(kind=kind))


def count_pairs(runs: DataFrame) -> DataFrame:
    """bucket, pair and n, its links in the whole corpus."""
    def run(keys: tuple, table: pa.Table) -> pa.Table:
        streams = [((k, n) for k, n, _ in (unpacked(b, np.uint64, 2) for b in head)) for head in table.column("head").to_pylist()]
        found = list(merged(streams))
        pairs = np.concatenate([k for k, _ in found])
        return pa.table({"bucket": pa.array([keys[0].as_py()] * len(pairs), pa.int32()),
                         "pair": pairs, "n": np.concatenate([n for _, n in found])})

    return runs.select("bucket", "lane", "head").groupBy("bucket", "lane") \
        .applyInArrow(run, "bucket int, pair long, n long") \
        .groupBy("bucket", "pair").agg(F.sum("n").alias("n"))


def contributions(runs: DataFrame, totals: DataFrame, lanes: int, len_a: int) -> DataFrame:
    """shard and packed (best links, sum of counts) of its documents, a row for each run."""
    def run(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, counts = right.column("pair").to_numpy(), right.column("n").to_numpy()
        order = np.argsort(pairs)
        pairs, counts = pairs[order], counts[order]
        sides = pairs // len_a
        heads = np.flatnonzero(np.concatenate([[True], sides[1:] != sides[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        highest = np.repeat(np.maximum.reduceat(counts, heads), np.diff(np.append(heads, len(pairs)))) if len(pairs) else counts
        is_best = counts == highest
        out = []
        for n, head, body in zip(*(left.column(c).to_pylist() for c in ("documents", "head", "body"))):
            best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for h, b in zip(head, body):
                names, _, sizes = unpacked(h, np.uint64, 2)
                places, links = unpacked(b, np.uint32, 1)
                at = np.repeat(np.searchsorted(pairs, names), sizes)
                np.add.at(sums, places, links * counts[at])
                np.add.at(best, places, links * is_best[at])
            out.append(zstandard.ZstdCompressor(level=1).compress(best.tobytes() + sums.tobytes()))
        return pa.table({"shard": left.column("shard"), "gain": pa.array(out, pa.binary())})

    each = totals.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return runs.select("bucket", "lane", "shard", "documents", "head", "body").groupBy("bucket", "lane") \
        .cogroup(each.groupBy("bucket", "lane")).applyInArrow(run, "shard long, gain binary")


def with_gains(pieces: DataFrame, gains: DataFrame) -> DataFrame:
    """``pieces`` with n_best and count_sum, added up over the runs of their shard."""
    def run(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        places = left.column("place").to_numpy()
        total = np.zeros((2, int(places.max(initial=-1)) + 2), np.int64)
        for value in right.column("gain").to_pylist():
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.int64).reshape(2, -1)
            total[:, :raw.shape[1]] += raw
        # Place -1, a document without tokens, is the empty last one.
        return left.append_column("n_best", pa.array(total[0][places])).append_column("count_sum", pa.array(total[1][places])) \
            .drop_columns(["shard", "place"])

    kind = pieces.schema["id"].dataType.simpleString()
    return pieces.groupBy("shard").cogroup(gains.groupBy("shard")).applyInArrow(
        run, f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, sha string, n_best long, count_sum long")


def align(docs: DataFrame, file_a: str = FILE_A, file_b: str = FILE_B, lane_bytes: int = LANE_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark: SparkSession = docs.sparkSession
    with open(file_a, "rb") as a, open(file_b, "rb") as b:
        sent = spark.sparkContext.broadcast({"a": a.read(), "b": b.read()})
    source = with_row(dealt(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))))
    found = settle(listed(source, sent))
    runs = found.filter("bucket IS NOT NULL")
    size = F.aggregate(F.concat("head", "body"), F.lit(0).cast("long"), lambda s, b: s + F.octet_length(b))
    heaviest = runs.groupBy("bucket").agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0] or 0
    lanes = max(1, -(-heaviest // lane_bytes))
    runs = runs.withColumn("lane", F.pmod(F.xxhash64("shard"), F.lit(lanes)).cast("int"))
    totals = settle(count_pairs(runs))
    pieces = found.filter("place IS NOT NULL").select(
        "shard", "place", "row", "id", "n_a", "n_b", "n_groups", "n_links", "sha")
    gained = with_gains(pieces, contributions(runs, totals, lanes, len(opened(sent).bytes_a)))
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return gained.groupBy("row").agg(F.max("id").alias("id"), *[F.sum(c).alias(c) for c in sums], F.max("sha").alias("groups_sha256")) \
        .drop("row")
