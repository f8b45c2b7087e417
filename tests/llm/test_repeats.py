import random

import numpy as np
import pytest

import shared
from gristmill.llm import repeats


def brute(texts, length):
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]] = seen.get(t[p:p + length], 0) + 1
    kept = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        kept.append(bytes(b for b, g in zip(t, gone) if not g))
    return kept


def texts(seed, n=60):
    rng = random.Random(seed)
    passage = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 500))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(rng.choice(passage)[rng.randrange(10):])
            parts.append("".join(rng.choice("xyz") for _ in range(rng.randrange(60))))
        out.append("".join(parts))
    return [*out, out[3], "a" * 700, "", "ab" * 150]


@pytest.mark.parametrize("limit", [4_096, 3])
def test_against_brute_force(spark, limit):
    rows = list(enumerate(texts(2)))
    want = brute([t.encode() for _, t in rows], 200)
    found = repeats.remove_repeats(shared.docs(spark, rows), group_limit=limit, bucket_bytes=4_000).collect()
    assert {r.id: bytes(r.kept) for r in found} == dict(enumerate(want))
    for r in found:
        assert r.n_removed == r.n_bytes - len(r.kept)


def test_merged_transforms_find_all_repeated_windows():
    rng = random.Random(4)
    for shard_bytes in (1, 300, 1 << 20):
        contents = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(20, 60))) for _ in range(80)]
        contents += [b"ab" * 20, b"a" * 41]
        weights = np.ones(len(contents), np.int64)
        found = repeats.repeated_windows(contents, weights, 16, 4, shard_bytes)
        seen = {}
        for c in contents:
            for p in range(len(c) - 15):
                seen[c[p:p + 16]] = seen.get(c[p:p + 16], 0) + 1
        for c, ranges in zip(contents, found):
            hit = {p for a, b in ranges for p in range(a, b)}
            assert hit == {p for p in range(len(c) - 15) if seen[c[p:p + 16]] > 1}


def test_repeats_inside_one_document_and_equal_rows(spark):
    block = "".join(random.Random(1).choice("abcdefgh") for _ in range(230))
    rows = [(1, block + "--" + block), (2, "q" * 199), (3, None), (4, "z" * 250), (4, "z" * 250), (None, block)]
    found = sorted((str(r.id), r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(shared.docs(spark, rows)).collect())
    assert found == sorted([("1", 460, 2, b"--"), ("2", 0, 0, b"q" * 199), ("3", 0, 0, b""), ("4", 250, 1, b""),
                            ("4", 250, 1, b""), ("None", 230, 1, b"")])
