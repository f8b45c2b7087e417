"""Language of texts by a linear-chain conditional random field over words.

Every word of a line has a hidden language. Its evidence is the sum of learned weights of its
prefixes, suffixes, byte trigrams and of the word itself (the lexicon), hashed into one table; neighbours
are tied by learned transitions. Forward-backward gives each word's probabilities, also where a
line switches language. A text's language has the largest sum over its words, its score is that
sum's share.

It learns from lines of labelled documents outside the held-out fold: at most ``lines_per_language``
lines, chosen by hash, for each language, ``LINES`` in all, and lines joined from two languages
to learn switches. A line of over ``LINE_BYTES`` bytes counts as several: it is cut at word bounds, and a longer word
between characters. Equal lines count once. The fit runs in one task, whose input that bound limits; the driver gets the model.

Null texts and texts without a letter are ``und`` with score 0, and so is everything where no
labelled text exists. Chains end at line breaks; of a line of over ``CHAIN`` words
each part is judged with ``CONTEXT`` words around it. Rows are told apart
by row; extra columns are ignored by ``identify`` and returned by ``keep_known``.
"""

from __future__ import annotations

import heapq
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, held_out, ship, with_row
from gristmill.llm.wordscan import Words, byte_values, chunks, letter_bytes, mixed
from gristmill.plans.lineage import small_side

ship(__name__)

UNKNOWN = "und"
LINES_PER_LANGUAGE = 1_000
LINE_BYTES = 1_000
TABLE = 1 << 17
CHAIN = 64
CONTEXT = 32           # words read on both sides of a part of a long line
TRAIN_CHAIN = 30
LINES = 8_000          # of all languages together
FIT_BYTES = 1 << 17
AFFIXES = (2, 3, 4)
LEAST_SCORE = 0.5
SIGN = 1 << 63         # makes a hash a signed number
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = letter_bytes().tolist()


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray      # TABLE x languages
    moves: np.ndarray        # languages x languages
    first: np.ndarray        # languages


def lowered(buffer: np.ndarray) -> np.ndarray:
    """Lower-case ASCII letters and those of Latin-1, as UTF-8 bytes."""
    out = buffer.copy()
    upper = (out >= 65) & (out <= 90)
    upper[1:] |= (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
    out[upper] += 32
    return out


def slots(code: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(code * np.uint64(0xD6E8FEB86659FD93) + np.uint64(kind)) % np.uint64(TABLE)).astype(np.int64)


def word_features(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of trigrams, where each word's begin, and a matrix with each word's other slots."""
    lengths = ends - starts
    padded = lengths + 2
    head = np.concatenate([[0], np.cumsum(padded)[:-1]])
    line = np.full(int(padded.sum()), 94, np.uint8)
    inner = np.ones(len(line), bool)
    inner[head] = inner[head + padded - 1] = False
    line[head + padded - 1] = 36
    spread = np.arange(int(lengths.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    line[inner] = buffer[spread]
    wide = line.astype(np.uint64)
    triples = wide[:-2] | (wide[1:-1] << np.uint64(8)) | (wide[2:] << np.uint64(16))
    last = np.zeros(len(triples), bool)
    last[(head + padded - 2)[:-1]] = last[(head + padded - 1)[:-1]] = True
    trigrams = slots(triples[~last], 1)
    fixed = []
    for side in (0, 1):
        for size in AFFIXES:
            code = np.zeros(len(starts), np.uint64)
            for k in range(size):
                at = head + 1 + k if side == 0 else head + padded - 2 - k
                there = k < lengths
                code = (code << np.uint64(8)) | np.where(there, wide[np.where(there, at, 0)], np.uint64(0))
            fixed.append(slots(code, 10 + 5 * side + size))
    whole = np.zeros(len(starts), np.uint64)
    powers = (np.uint64(0x9E3779B97F4A7C15) * (2 * np.arange(int(lengths.max(initial=0))).astype(np.uint64) + np.uint64(1)))
    place = np.arange(int(lengths.sum())) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    if len(starts):
        whole = np.add.reduceat(mixed(wide[inner] + powers[place]), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    fixed.append(slots(whole, 2))
    return trigrams, np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), np.stack(fixed, axis=1)


def evidence(weights: np.ndarray, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    trigrams, heads, fixed = features
    total = np.add.reduceat(weights[trigrams], heads, axis=0)
    for j in range(fixed.shape[1]):
        total += weights[fixed[:, j]]
    return total


def forward_backward(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Each word's probabilities, chain by chain, and the expected moves if asked.

    ``scores`` has a row per word; chains are runs of rows, longest first.
    """
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    m, f = np.exp(moves - moves.max()), np.exp(first - first.max())
    ahead, behind = np.empty_like(e), np.ones_like(e)
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), "left")  # chains with more than t words
    for t in range(longest):
        at = starts[:alive[t]] + t
        a = (f if t == 0 else ahead[at - 1] @ m) * e[at]
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros_like(moves, dtype=np.float64) if pairs else None
    for t in range(longest - 2, -1, -1):
        at = starts[:alive[t + 1]] + t
        b = (behind[at + 1] * e[at + 1]) @ m.T
        if pairs:
            after = behind[at + 1] * e[at + 1]
            mass = ((ahead[at] @ m) * after).sum(axis=1, keepdims=True)
            expected += m * ((ahead[at] / mass).T @ after)
        behind[at] = b / b.sum(axis=1, keepdims=True)
    both = ahead * behind
    return both / both.sum(axis=1, keepdims=True), expected


def chains_of(line: np.ndarray, longest: int, context: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chains of the words of one line each, longest first: the words they read, starts, lengths, and which of these words they judge.

    A line of over ``longest`` words is judged in parts; each part also reads ``context`` words on both sides.
    """
    n = len(line)
    fresh = np.ones(n, bool)
    fresh[1:] = line[1:] != line[:-1]
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, n))
    parts = -(-sizes // longest)
    jump = (np.arange(int(parts.sum())) - np.repeat(np.concatenate([[0], np.cumsum(parts)[:-1]]), parts)) * longest
    size, head = np.repeat(sizes, parts), np.repeat(heads, parts)
    low, high = np.maximum(jump - context, 0), np.minimum(jump + longest + context, size)
    order = np.argsort(low - high, kind="stable")
    low, high, jump, head, size = low[order], high[order], jump[order], head[order], size[order]
    lengths = high - low
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    place = np.arange(int(lengths.sum())) - np.repeat(starts - low, lengths)
    judged = (place >= np.repeat(jump, lengths)) & (place < np.repeat(np.minimum(jump + longest, size), lengths))
    return place + np.repeat(head, lengths), starts, lengths, judged


class Block:
    """Training chains of some lines: the features of their words, chains and true languages."""

    def __init__(self, lines: list[tuple[int, bytes]], values: np.ndarray, k: int):
        scan = Words([text for _, text in lines], values)
        label = np.array([lang for lang, _ in lines])
        bounds = np.searchsorted(scan.text, np.arange(len(lines) + 1))
        whole = [np.arange(low, high) for low, high in zip(bounds[:-1], bounds[1:])]
        chains = [(at[i:i + TRAIN_CHAIN], lang) for at, lang in zip(whole, label) for i in range(0, len(at), TRAIN_CHAIN)]
        half = TRAIN_CHAIN // 2
        ids, truths = [c[0] for c in chains], [np.full(len(c[0]), c[1]) for c in chains]
        for (at, first), (other, second) in zip(chains, chains[1:] + chains[:1]):
            if first != second:  # a line that switches language
                ids.append(np.concatenate([at[:half], other[:half]]))
                truths.append(np.repeat([first, second], [min(half, len(at)), min(half, len(other))]))
        order = sorted(range(len(ids)), key=lambda c: -len(ids[c]))
        self.lengths = np.array([len(ids[c]) for c in order], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        word = np.concatenate([np.zeros(0, np.int64), *(ids[c] for c in order)])
        truth = np.concatenate([np.zeros(0, np.int64), *(truths[c] for c in order)])
        _, kept, back = np.unique(scan.hashes, return_index=True, return_inverse=True)
        trigrams, heads, fixed = word_features(lowered(scan.buffer), scan.starts[kept], scan.ends[kept])
        self.used, compact = np.unique(np.concatenate([trigrams, fixed.ravel()]), return_inverse=True)
        compact = compact.astype(np.int32)
        self.trigrams, self.fixed = compact[:len(trigrams)], compact[len(trigrams):].reshape(fixed.shape)
        self.heads, self.kept = heads.astype(np.int32), len(kept)
        self.unique, self.truth, self.words = back[word].astype(np.int32), truth.astype(np.int16), len(word)
        inside = np.ones(len(word), bool)
        inside[self.starts[self.lengths > 0]] = False
        self.moved = np.zeros((k, k))
        np.add.at(self.moved, (truth[np.flatnonzero(inside) - 1], truth[inside]), 1)
        self.begun = np.bincount(truth[self.starts], minlength=k) if len(word) else np.zeros(k)

    def add_slopes(self, params: list[np.ndarray], slopes: list[np.ndarray]) -> None:
        """Add the gradient of the negative log likelihood."""
        if not self.words:
            return
        scores = evidence(params[0][self.used], (self.trigrams, self.heads, self.fixed)).astype(np.float64)
        found, expected = forward_backward(scores[self.unique], self.starts, self.lengths, params[1], params[2], pairs=True)
        owner = np.repeat(np.arange(self.kept), np.diff(np.append(self.heads, len(self.trigrams))))
        for c in range(found.shape[1]):
            gap = np.bincount(self.unique, found[:, c] - (self.truth == c), minlength=self.kept)
            slope = np.bincount(self.trigrams, gap[owner], minlength=len(self.used))
            for j in range(self.fixed.shape[1]):
                slope += np.bincount(self.fixed[:, j], gap, minlength=len(self.used))
            slopes[0][self.used, c] += slope
        slopes[1] += expected - self.moved
        slopes[2] += found[self.starts].sum(axis=0) - self.begun


def fit(lines: list[tuple[str, bytes]], rounds: int = 40, rate: float = 0.25, penalty: float = 1e-6, seed: int = 0) -> Model:
    """Maximum likelihood by Adam; each round adds the gradients of blocks of lines.

    Every word of a line is learned from: a line is cut into chains of ``TRAIN_CHAIN`` words. Memory holds the features of the lines
    and, per language, a few numbers per slot; what a block needs while it is worked on is bounded.
    """
    languages = sorted({lang for lang, _ in lines})
    number = {lang: c for c, lang in enumerate(languages)}
    k, values = len(languages), byte_values(letter_bytes())
    mixed_up = [(number[lines[i][0]], lines[i][1]) for i in np.random.default_rng(seed).permutation(len(lines))]
    blocks, taken, size = [], [], 0
    for line in mixed_up:
        taken.append(line)
        size += len(line[1])
        if size >= FIT_BYTES:
            blocks.append(Block(taken, values, k))
            taken, size = [], 0
    if taken:
        blocks.append(Block(taken, values, k))
    params = [np.zeros((TABLE, k), np.float32), np.zeros((k, k)), np.zeros(k)]
    total = sum(b.words for b in blocks)
    if not total:
        return Model(languages, *params)
    mean, square, slopes = ([np.zeros_like(p) for p in params] for _ in range(3))
    for step in range(1, rounds + 1):
        for g in slopes:
            g[...] = 0
        for block in blocks:
            block.add_slopes(params, slopes)
        for p, g, m, s in zip(params, slopes, mean, square):
            g /= total
            g += penalty * p
            m += 0.1 * (g - m)
            g *= g
            s += 0.01 * (g - s)
            g[...] = np.sqrt(s / (1 - 0.99 ** step)) + 1e-8
            p -= rate / (1 - 0.9 ** step) * m / g
    return Model(languages, *params)


def pieces(line: bytes, most: int) -> Iterator[bytes]:
    """The line in runs of at most ``most`` bytes, cut at word bounds, and inside a longer word between characters."""
    start = 0
    while len(line) - start > most:
        end = start + most
        while end > start and _LETTER[line[end]] and _LETTER[line[end - 1]]:
            end -= 1
        if end == start:
            end = start + most
            while end > start + 1 and line[end] & 0xC0 == 0x80:
                end -= 1
        yield line[start:end]
        start = end
    yield line[start:]


def sampled_lines(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """h, lang and line: hashed lines of labelled documents outside the held-out fold, about two of each sampled document."""
    docs = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    counts = small_side(docs.groupBy(lang_col).agg(F.count("*").alias("__n")))
    wide = 1 << 30
    # As many documents as lines are wanted: equal lines are folded later.
    chance = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("__n")) * wide
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col)) \
        .join(counts, lang_col) \
        .filter(F.pmod(F.xxhash64(F.lit(8), F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(wide)) < chance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                ranked = (((xxhash.xxh64_intdigest(x, 42) ^ SIGN) - SIGN, x) for line in text.split(b"\n") for x in pieces(line, LINE_BYTES))
                usable = (r for r in ranked if any(c.isalpha() for c in r[1].decode("utf-8", "ignore")))
                found += [(h, lang, x) for h, x in heapq.nsmallest(2, usable)]
            h, lang, x = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(lang, pa.string()), pa.array(x, pa.binary())],
                ["h", "lang", "line"])

    return picked.select(F.col(lang_col).cast("string").alias("lang"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "h long, lang string, line binary")


def chosen_lines(rows: list[tuple[int, str, bytes]], per_language: int, most: int = LINES) -> list[tuple[str, bytes]]:
    """The first lines of each language by hash, equal ones once; fewer of each where ``most`` would be passed."""
    rows = sorted(set(rows))
    share = max(1, min(per_language, most // max(1, len({lang for _, lang, _ in rows}))))
    taken: dict[str, int] = {}
    out = []
    for _, lang, line in rows:
        if taken.get(lang, 0) < share:
            taken[lang] = taken.get(lang, 0) + 1
            out.append((lang, line))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          lines_per_language: int = LINES_PER_LANGUAGE) -> Model:
    """Fit on the bounded sample, in one task; the driver gets the model only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("h", "lang", "line")))]
        model = fit(chosen_lines(rows, lines_per_language))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.languages], pa.list_(pa.string())),
             *(pa.array([p.tobytes()], pa.binary()) for p in (model.weights, model.moves, model.first))],
            ["languages", "weights", "moves", "first"])

    # At most about two lines for each wanted one.
    found = sampled_lines(docs, id_col, text_col, lang_col, lines_per_language).repartition(1) \
        .mapInArrow(run, "languages array<string>, weights binary, moves binary, first binary").collect()
    if not found:
        return Model([], np.zeros((TABLE, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    k = len(found[0].languages)
    return Model(found[0].languages, np.frombuffer(found[0].weights, np.float32).reshape(TABLE, k),
                 np.frombuffer(found[0].moves).reshape(k, k), np.frombuffer(found[0].first))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: row, id, check (hash of its text), lang_pred, score, sure (mean of each word's highest probability)."""
    # Plain lists and arrays: workers need not know this package's classes.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.moves, model.first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, moves, begin = shared.value
        values = byte_values(letter_bytes())
        k = len(languages)
        names = np.array([*languages, UNKNOWN], object)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            best, share, sure = np.full(len(texts), k), np.zeros(len(texts)), np.zeros(len(texts))
            for first, last in chunks(texts) if k else ():
                scan = Words(texts[first:last], values)
                if not len(scan.starts):
                    continue
                _, kept, back = np.unique(scan.hashes, return_index=True, return_inverse=True)
                low = lowered(scan.buffer)
                scores = evidence(weights, word_features(low, scan.starts[kept], scan.ends[kept])).astype(np.float64)
                breaks = np.flatnonzero(scan.buffer == 10)
                at, starts, lengths, judged = chains_of(np.searchsorted(breaks, scan.starts), CHAIN, CONTEXT)
                each, _ = forward_backward(scores[back[at]], starts, lengths, moves, begin)
                found = np.empty((len(scan.starts), k))
                found[at[judged]] = each[judged]
                heads = np.flatnonzero(np.diff(scan.text, prepend=-1))
                sums = np.add.reduceat(found, heads, axis=0)
                at = scan.text[heads]
                best[first + at] = sums.argmax(axis=1)
                share[first + at] = sums.max(axis=1) / sums.sum(axis=1)
                sure[first + at] = np.add.reduceat(found.max(axis=1), heads) / sums.sum(axis=1)
            for i, text in enumerate(texts):
                if best[i] < k and not _ASCII_LETTER.search(text) and not any(c.isalpha() for c in text.decode()):
                    best[i], share[i], sure[i] = k, 0.0, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("check"),
                 pa.array(names[best].tolist(), pa.string()), pa.array(share), pa.array(sure)],
                ["row", "id", "check", "lang_pred", "score", "sure"])

    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("check"),
                         text.cast("binary").alias("text"))
    rows = with_row(dealt(source))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, check long, lang_pred string, score double, sure double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             lines_per_language: int = LINES_PER_LANGUAGE) -> DataFrame:
    """Learn from the labelled documents, then predict every document."""
    return predict(docs, train(docs, id_col, text_col, lang_col, lines_per_language), id_col, text_col)


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents with a language and words at least ``least_score`` sure, of one language or several, with all their columns.

    Where no labelled text exists nothing can be told apart: all documents stay, and a warning says so.
    """
    model = train(docs, id_col, text_col, lang_col)
    if not model.languages:
        warnings.warn("no labelled text to learn languages from; all documents stay", stacklevel=2)
        return docs
    found = predict(docs, model, id_col, text_col)
    bad = found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("sure") < least_score)) \
        .select(F.col("id").alias("__i"), F.col("check").alias("__c")).distinct()
    check = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__i")) & (check == F.col("__c")), "left_anti")
