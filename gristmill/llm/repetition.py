"""Quality rules: word counts, and how much of a text repeats itself, by suffix array.

Repetition is measured on the UTF-8 bytes of one text; texts are never compared with each other.

1. *Candidates.* A start whose ``least`` next bytes occur nowhere else in the text can't begin a repeat of that length. Hashes of
   these bytes are marked in a table sized by the text, and only starts with a hash seen twice stay (a false mark costs work only).
2. *Suffix array.* The suffixes at the candidates are sorted: first by ``least`` bytes, eight at a time, then by doubling, which
   looks up the rank of the suffix as many bytes further on. The ranks of every doubling step are kept.
3. *Common prefixes.* Neighbours in the array agree for as many steps as their ranks do, taken from the longest step down; the rest
   is compared byte by byte. Every value of at least ``least`` bounds an interval of suffixes that share a maximal repeated substring.
4. *Spans.* The longest repeat at a start is the higher of its two common prefixes; the spans are united.

A text is kept if it has at least ``least_words`` words, at most half of its words lie in repeated windows of three words, repeats
cover at most ``most_covered`` of its bytes, and no repeat is longer than ``most_longest`` of them.

Documents are judged one by one, inside the scan: nothing is shuffled. Texts are read in chunks of about a megabyte; a longer
text is hashed in overlapping pieces, so memory follows its candidates. Null text is the empty text, has no words and fails. Equal and null ids do
no harm, repeated rows give repeated results, extra columns are ignored. Bytes that are no UTF-8 are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, ship
from gristmill.llm.wordscan import _BASE, _INVERSE, _powers, chunks, mixed

ship(__name__)

LEAST = 64
LEAST_WORDS = 50
MOST_COVERED = 0.3
MOST_LONGEST = 0.2
SYMBOLS = b"#*$%&|<>"
PIECE_BYTES = 1 << 20
# No byte of UTF-8; it ends every text.
END = b"\xff"

_VALUES = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


# ---- repeats ------------------------------------------------------------------------------------

def gram_hashes(piece: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at every start that has as many."""
    n = len(piece)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[piece] * _powers(_BASE, n), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _powers(_INVERSE, n)[:n - size + 1])


def candidates(buffer: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Starts whose ``least`` bytes occur twice or more in their text, in ascending order.

    ``offsets`` says where each text begins; a text's last ``least`` bytes are end marks.
    """
    bits = max(12, int(2 * len(buffer)).bit_length())
    once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)

    def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for low in range(0, len(buffer), PIECE_BYTES):
            found = gram_hashes(buffer[low:low + PIECE_BYTES + least - 1], least)
            at = np.arange(low, low + len(found))
            text = np.searchsorted(offsets, at, "right") - 1
            inside = at + least <= offsets[text + 1] - least  # not in the end marks
            yield at[inside], mixed(found[inside] + text[inside].astype(np.uint64) * _BASE)

    low_bits = np.uint64((1 << bits) - 1)
    # One piece is held; more are hashed twice.
    first = list(pieces()) if len(buffer) <= 2 * PIECE_BYTES else None
    for _, found in first or pieces():
        slots, counts = np.unique(found & low_bits, return_counts=True)
        twice[slots[(counts > 1) | once[slots]]] = True
        once[slots] = True
    del once
    marked = [(at[hit], found[hit]) for at, found in first or pieces() for hit in [twice[found & low_bits]]]
    if not marked:
        return np.zeros(0, np.int64)
    at, found = (np.concatenate(c) for c in zip(*marked))
    order = np.argsort(found, kind="stable")
    same = found[order][1:] == found[order][:-1]
    keep = np.zeros(len(order), bool)
    keep[1:] |= same
    keep[:-1] |= same
    return np.sort(at[order[keep]])


def eight(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number, in byte order; past the end lie end marks."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | buffer[np.minimum(at + k, len(buffer) - 1)].astype(np.uint64)
    return out


def refined(rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Dense ranks by (rank, key)."""
    order = np.lexsort((key, rank))
    step = np.zeros(len(order), np.int64)
    step[1:] = (rank[order][1:] != rank[order][:-1]) | (key[order][1:] != key[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


class SuffixArray:
    """The suffixes at ``starts`` in order (``order``) and the common prefix of each with the one before it (``common``)."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, starts: np.ndarray, least: int):
        # Where a repeat ends, the bytes that differ may start at no candidate; these places get a rank too.
        places = np.union1d(starts, starts + least)
        text = np.searchsorted(offsets, places, "right") - 1
        rank = text
        for shift in range(0, least, 8):
            rank = refined(rank, eight(buffer, places + shift))
        levels, step = [(least, rank)], least
        at = np.searchsorted(places, starts)
        while len(np.unique(rank[at])) < len(at):
            # Equal ranks mean equal bytes so far, so the place ``step`` bytes on has a rank.
            beyond = np.minimum(np.searchsorted(places, places + step), len(places) - 1)
            found = places[beyond] == places + step
            rank = refined(rank, np.where(found, rank[beyond] + 1, 0))
            step *= 2
            levels.append((step, rank))
        self.order = starts[np.argsort(rank[at], kind="stable")]
        left, right = self.order[:-1].copy(), self.order[1:].copy()
        owner = np.searchsorted(offsets, self.order, "right") - 1
        live = owner[1:] == owner[:-1]
        for size, ranks in reversed(levels):
            i = np.minimum(np.searchsorted(places, left), len(places) - 1)
            j = np.minimum(np.searchsorted(places, right), len(places) - 1)
            same = live & (places[i] == left) & (places[j] == right) & (ranks[i] == ranks[j])
            left, right = left + size * same, right + size * same
        for _ in range(least):
            live = live & (buffer[np.minimum(left, len(buffer) - 1)] == buffer[np.minimum(right, len(buffer) - 1)])
            if not live.any():
                break
            left, right = left + live, right + live
        self.common = np.concatenate([[0], right - self.order[1:]]) if len(starts) else np.zeros(0, np.int64)


def repeats(texts: list[bytes], least: int = LEAST) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """For each text: bytes covered by repeats of at least ``least`` bytes, the longest one, and the united spans."""
    ends = END * least
    buffer = np.frombuffer(ends.join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes + least)])
    starts = candidates(buffer, offsets, least)
    out: list[tuple[int, int, list[tuple[int, int]]]] = [(0, 0, []) for _ in texts]
    if not len(starts):
        return out
    found = SuffixArray(buffer, offsets, starts, least)
    # The deepest interval a suffix lies in is bounded by the higher of its two common prefixes.
    depth = np.maximum(found.common, np.append(found.common[1:], 0))
    real = depth >= least
    low, high = found.order[real], found.order[real] + depth[real]
    by_place = np.argsort(low)
    low, high = low[by_place], np.maximum.accumulate(high[by_place])
    if not len(low):
        return out
    heads = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
    begins, stops = low[heads], high[np.append(heads[1:], len(low)) - 1]
    owner = np.searchsorted(offsets, begins, "right") - 1
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, np.searchsorted(offsets, found.order, "right") - 1, depth)
    for i in np.unique(owner).tolist():
        mine = owner == i
        spans = list(zip((begins[mine] - offsets[i]).tolist(), (stops[mine] - offsets[i]).tolist()))
        out[i] = (sum(b - a for a, b in spans), int(longest[i]), spans)
    return out


# ---- words --------------------------------------------------------------------------------------

def repeated_window_words(hashes: np.ndarray, text: np.ndarray, n_texts: int, size: int = 3) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur twice or more in it."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(n_texts, np.int64)
    window = text[:n].astype(np.uint64) * _BASE
    for k in range(size):
        window = mixed(window * np.uint64(0x94D049BB133111EB) + hashes[k:k + n])
    at = np.flatnonzero(text[:n] == text[size - 1:size - 1 + n])
    order = at[np.argsort(window[at], kind="stable")]
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(hashes), bool)
    for k in range(size):
        hit[order[twice] + k] = True
    return np.bincount(text[hit], minlength=n_texts)


def word_facts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n_words, word_chars and n_repeat_words of each text."""
    hashes, owners, chars = [], [], np.zeros(len(texts), np.int64)
    for first, last in chunks(texts):
        for piece, whose in _word_pieces(texts, first, last):
            buffer = np.frombuffer(piece, np.uint8)
            inside = ~_BLANK[buffer]
            edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            sums = np.zeros(len(buffer) + 1, np.uint64)
            np.cumsum(_VALUES[buffer] * _powers(_BASE, len(buffer)), out=sums[1:])
            shift = _powers(_INVERSE, len(buffer))[starts]
            hashes.append(mixed((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64)))
            text = whose(starts)
            owners.append(text)
            heads = np.concatenate([[0], np.cumsum(inside & ((buffer & 0xC0) != 0x80))])
            np.add.at(chars, text, heads[ends] - heads[starts])
    words, owner = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *owners])
    return np.bincount(owner, minlength=len(texts)), chars, repeated_window_words(words, owner, len(texts))


def _word_pieces(texts: list[bytes], first: int, last: int):
    """Bytes to scan, with a function from places to texts; a long text comes in pieces that end between words."""
    if last - first > 1 or len(texts[first]) <= PIECE_BYTES:
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts[first:last]])])
        yield b"\n".join(texts[first:last]) + b"\n", lambda at: np.searchsorted(offsets, at, "right") - 1 + first
        return
    text, start = texts[first], 0
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[start:end] + b"\n", lambda at: np.full(len(at), first)
        start = end


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\v\f\r"):
            n += line in seen
            seen.add(line)
    return n


# ---- the operator -------------------------------------------------------------------------------

def judge(
    docs: DataFrame, least: int = LEAST, least_words: int = LEAST_WORDS, most_covered: float = MOST_COVERED,
    most_longest: float = MOST_LONGEST, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bytes, covered, longest, spans, base_failed, kept."""
    if least < 8 or least % 8:
        raise ValueError("the least repeat must be a multiple of eight bytes")
    source = dealt(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")))
    kind = source.schema["id"].dataType.simpleString()
    spots = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "covered", "longest", "spans"]
        for batch in batches:
            every = [t if END not in t else t.decode("utf-8", "replace").encode("utf-8") for t in batch.column("text").to_pylist()]
            for first, last in chunks(every, PIECE_BYTES):
                texts = every[first:last]
                n_words, chars, windows = word_facts(texts)
                found = repeats(texts, least)
                columns = [
                    n_words, chars, [sum(t.count(s) for s in (SYMBOLS[i:i + 1] for i in range(len(SYMBOLS)))) for t in texts],
                    [repeated_lines(t) for t in texts], windows, [len(t) for t in texts], [f[0] for f in found], [f[1] for f in found]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, last - first), *(pa.array(c, pa.int64()) for c in columns),
                     pa.array([[{"start": a, "end": b} for a, b in f[2]] for f in found], spots)], names)

    longs = ", ".join(f"{c} long" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "covered", "longest"))
    failed = (F.col("n_words") < least_words) | (2 * F.col("n_repeat_words") > F.col("n_words"))
    fine = (F.col("covered") <= most_covered * F.col("n_bytes")) & (F.col("longest") <= most_longest * F.col("n_bytes"))
    return source.mapInArrow(run, f"id {kind}, {longs}, spans array<struct<start: long, end: long>>") \
        .withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
