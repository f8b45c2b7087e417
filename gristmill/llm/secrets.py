"""Secret scan: fixed patterns, and two character Markov models compared by likelihood ratio.

The models give the probability of a character after the one before it, in random strings
and in ordinary identifiers. They are trained on labelled tokens: the values that the fixed patterns
find are random strings. Ordinary at first are other tokens whose neighbouring characters seldom change between upper case, lower
case and digits, as in names, dates and part numbers, or whose letters are mostly of one case and digits few. (All unlabelled
tokens would not do: one secret among a dozen of them hides every rare pair.) Those that these models then
call random are taken out and the models are counted again, ``ROUNDS`` times in all, so secrets without
a label don't pass for ordinary. Tasks count character pairs in every document, and only sums of
a table bounded by the alphabet reach the driver. Then every token of 16 or more
characters in every text gets its log-likelihood ratio; one above the threshold per character and
in total is a span of kind ``markov``, unless it touches a span of a fixed pattern.

Spans are (kind, start, end) in code points, end exclusive, sorted by start, then kind in the order of KINDS.
Null text is the empty text and has no spans. Rows are told apart by row, so equal ids and equal
rows each get their own result. An empty table trains on nothing: the models then
know only the smoothing, and no token passes. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, ship, with_row
from gristmill.llm.wordscan import chunks

ship(__name__)

KINDS = ("assign", "access", "hex", "markov")
# The patterns of the base kinds. The last two hold their least length, as the
# longest run decides.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_VALUE = 12

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1     # the last one stands before a token
TOKEN_LEAST = 16
PER_CHARACTER, IN_TOTAL = 0.5, 16.0  # nats
LEAN = 20.0
ROUNDS = 2
FEW_CHANGES = 0.2

CODES = np.full(256, SYMBOLS - 1, np.int64)
CODES[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))


def base_spans(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, value start, value end) in bytes, by kind."""
    found = []
    if b":" in text or b"=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                found.append((0, m.start(), m.end(), m.start(2), m.end(2)))
    if b"AKIA" in text:
        found += [(1, m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found


def runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` true values."""
    steps = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    long = ends - starts >= least
    return starts[long], ends[long]


_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_CLASS = np.select([_UPPER, _DIGIT, np.isin(np.arange(256), np.arange(97, 123))], [1, 2, 3], 0)
_TOKEN = CODES < SYMBOLS - 1


class Scan:
    """A range of texts as one buffer, with its base spans and its tokens."""

    def __init__(self, texts: list[bytes], least: int):
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.base = [
            (kind, int(o) + s, int(o) + e, int(o) + v, int(o) + w)
            for o, text in zip(self.offsets, texts) for kind, s, e, v, w in base_spans(text)]
        self.base += [(2, s, e, s, e) for s, e in zip(*(a.tolist() for a in runs(_HEX[self.buffer], TOKEN_LEAST)))]
        self.starts, self.ends = runs(_TOKEN[self.buffer], least)
        covered = np.zeros(len(self.buffer) + 1, np.int64)
        for _, s, e, _, _ in self.base:
            covered[s] += 1
            covered[e] -= 1
        hit = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
        self.free = hit[self.ends] == hit[self.starts]

    def ordinary(self) -> np.ndarray:
        """Tokens without a base span that look like names, dates or numbers."""
        size = self.ends - self.starts

        def share(inside: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(inside)])
            return (sums[self.ends] - sums[self.starts]) / size
        kind = _CLASS[self.buffer]
        # A change stands at the later character; the first of a token follows a character outside, of no class.
        changed = np.concatenate([[False], (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)])
        upper = share(_UPPER[self.buffer])
        one_case = (share(_DIGIT[self.buffer]) <= 0.25) & ((upper <= 0.25) | (upper >= 0.75))
        return self.free & (one_case | (share(changed) <= FEW_CHANGES))

    def random(self, table: np.ndarray, per_character: float, in_total: float) -> np.ndarray:
        """Tokens without a base span that the models take for random strings."""
        ratio = self.ratios(table)
        return self.free & (ratio > per_character * (self.ends - self.starts)) & (ratio > in_total)

    def pairs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of (character before, character) inside the given runs."""
        table = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        if len(starts):
            codes = CODES[self.buffer]
            firsts = (SYMBOLS - 1) * SYMBOLS + codes[starts]
            lengths = ends - starts - 1
            jump = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            at = np.arange(lengths.sum()) + jump
            table = np.bincount(firsts, minlength=len(table)) + np.bincount(
                codes[at] * SYMBOLS + codes[at + 1], minlength=len(table))
        return table

    def ratios(self, table: np.ndarray) -> np.ndarray:
        """The log-likelihood ratio of every token."""
        codes = CODES[self.buffer]
        steps = np.concatenate([[0.0], np.cumsum(table[codes[:-1], codes[1:]].astype(np.float64))])
        return table[SYMBOLS - 1, codes[self.starts]] + steps[self.ends - 1] - steps[self.starts]


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS,
          per_character: float = PER_CHARACTER, in_total: float = IN_TOTAL) -> np.ndarray:
    """The table of log-likelihood ratios, random against ordinary, by (character before, character).

    Each round reads all documents once.
    """
    table = None
    for _ in range(rounds):
        table = _counted(docs, text_col, table, per_character, in_total)
    return table


def _counted(docs: DataFrame, text_col: str, before: np.ndarray | None, per_character: float, in_total: float) -> np.ndarray:
    """The table from one pass; tokens that are random by the table ``before`` are not ordinary."""
    known = docs.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for first, last in chunks(texts):
                scan = Scan(texts[first:last], 4)
                values = np.array([b[3:] for b in scan.base], np.int64).reshape(-1, 2)
                sums[0] += scan.pairs(values[:, 0], values[:, 1])
                plain = scan.ordinary()
                if known.value is not None:
                    plain &= ~scan.random(known.value, per_character, in_total)
                sums[1] += scan.pairs(scan.starts[plain], scan.ends[plain])
        kind, pair = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(pair), pa.array(sums[kind, pair])], ["kind", "pair", "n"])

    source = docs.select(F.col(text_col).cast("binary").alias("text"))
    # At most two rows for each pair of symbols.
    sums = dealt(source).mapInArrow(run, "kind long, pair long, n long") \
        .groupBy("kind", "pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, SYMBOLS * SYMBOLS))
    counts[sums.column("kind").to_numpy(), sums.column("pair").to_numpy()] = sums.column("n").to_numpy()
    counts = counts.reshape(2, SYMBOLS, SYMBOLS)
    # A character's probability after another leans on its probability anywhere.
    alone = counts.sum(axis=1, keepdims=True) + 1.0
    alone /= alone.sum(axis=2, keepdims=True)
    logs = np.log((counts + LEAN * alone) / (counts.sum(axis=2, keepdims=True) + LEAN))
    return (logs[0] - logs[1]).astype(np.float32)


def scan(
    docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    per_character: float = PER_CHARACTER, in_total: float = IN_TOTAL,
) -> DataFrame:
    """Per document: row, id, spans (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            every: list[list] = []
            for first, last in chunks(texts):
                s = Scan(texts[first:last], TOKEN_LEAST)
                good = s.random(shared.value, per_character, in_total)
                spans = [b[:3] for b in s.base] + [
                    (3, a, b) for a, b in zip(s.starts[good].tolist(), s.ends[good].tolist())]
                own: list[list] = [[] for _ in range(last - first)]
                if spans:
                    points = np.concatenate([[0], np.cumsum((s.buffer & 0xC0) != 0x80)])
                    for kind, a, b in sorted(spans, key=lambda x: (x[1], x[0])):
                        i = int(np.searchsorted(s.offsets, a, "right")) - 1
                        zero = points[s.offsets[i]]
                        own[i].append({"kind": KINDS[kind], "start": int(points[a] - zero), "end": int(points[b] - zero)})
                every += own
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(every, schema)], ["row", "id", "spans"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = with_row(dealt(source))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, spans array<struct<kind:string,start:int,end:int>>")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 per_character: float = PER_CHARACTER, in_total: float = IN_TOTAL) -> DataFrame:
    """Train on all texts, then scan each."""
    table = train(docs, text_col, per_character=per_character, in_total=in_total)
    return scan(docs, table, id_col, text_col, per_character, in_total)
