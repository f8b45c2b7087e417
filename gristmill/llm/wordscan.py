"""Finding and hashing the words of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from gristmill.llm.common import ship

ship(__name__)

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def byte_values(word_bytes: np.ndarray) -> np.ndarray:
    """A random value per byte: zero for separators, one value for both cases of A-Z."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    return np.where(word_bytes, values, np.uint64(0))


def ascii_word_bytes() -> np.ndarray:
    """Digits, letters of either case, and every byte of a character beyond ASCII."""
    keep = np.zeros(256, bool)
    keep[48:58] = keep[65:91] = keep[97:123] = keep[128:] = True
    return keep


def letter_bytes() -> np.ndarray:
    """ASCII letters of either case, and every byte of a character beyond ASCII."""
    keep = ascii_word_bytes()
    keep[48:58] = False
    return keep


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    found = _POWERS.get(int(base))
    if found is None or len(found) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        found = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:  # what a long text needs is not kept
            _POWERS[int(base)] = found
    return found[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a range of texts: text number, start, end (bytes of ``buffer``) and hash."""

    def __init__(self, texts: Sequence[bytes], values: np.ndarray):
        self.joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(self.joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        inside = (values != 0)[self.buffer].view(np.int8)
        steps = np.diff(inside, prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.text = np.searchsorted(self.offsets, self.starts, "right") - 1
        n = len(self.buffer)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[self.buffer] * _powers(_BASE, n), out=sums[1:])
        self._sums, self._shift = sums, _powers(_INVERSE, n)[self.starts]
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * self._shift)

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the first ``size`` bytes of every word that is longer."""
        at = np.flatnonzero(self.ends - self.starts > size)
        s = self.starts[at]
        return at, mixed((self._sums[s + size] - self._sums[s]) * self._shift[at] + np.uint64(size))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of ``size`` words inside one text."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total = mixed(total * np.uint64(0x94D049BB133111EB) + self.hashes[k:k + n])
        at = np.flatnonzero(self.text[:n] == self.text[size - 1:size - 1 + n])
        return at, total[at]

    def words(self, first: int, last: int) -> list[bytes]:
        return [self.joined[s:e] for s, e in zip(self.starts[first:last].tolist(), self.ends[first:last].tolist())]
