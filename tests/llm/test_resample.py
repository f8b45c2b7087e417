"""Importance resampling against a plain version, runs across lines included."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

import shared
from gristmill.llm import resample


def brute(rows, items, ngrams, buckets=997, percent=30, least=3, seed=5):
    def features(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        return len(words), [b" ".join(words[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]

    bucket = lambda f: crc32(f) % buckets
    corpus, target = Counter(), Counter()
    for _, text in rows:
        corpus.update(map(bucket, features(text)[1]))
    for text in items:
        target.update(map(bucket, features(text)[1]))
    s_all, t_all = sum(corpus.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))
    out = []
    for doc_id, text in rows:
        n, found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return out, able[:len(able) * percent // 100]


ROWS = [(1, "The red fox\nran over\n\nthe hill"), (2, "the red fox\nRAN over\n\nthe hill"), (3, "one"), (4, None), (5, ""), (6, "\n \n"),
        (7, "a\nb\nc\nd e f\ng"), (8, "a\nb\nc\nd e f\ng"), (9, "über Straße 漢字\nüber"), (10, "x y z " * 50), (11, "hill fox hill fox ran"),
        (12, "the hill\nthe hill\nthe hill\nthe hill"), (None, "no id here at all"), (13, "quality text about foxes")]


@pytest.mark.parametrize("ngrams", [1, 2, 3, 4])
@pytest.mark.parametrize("piece", [5, 1 << 20])
def test_equals_plain_version(spark, monkeypatch, ngrams, piece):
    monkeypatch.setattr(resample.word_lists, "__defaults__", (piece,))
    items = ["the red fox\nran", None, "quality text", "a b c d"]
    target = shared.docs(spark, list(enumerate(items)))
    out = resample.resample(shared.docs(spark, ROWS), target, ngrams, 997, 30, 3, 5).collect()
    want, drawn = brute(ROWS, items, ngrams)
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r)[:5] for r in out), key=key) == sorted(want, key=key)
    assert [r[0] for r in sorted((r for r in out if r.rank is not None), key=lambda r: r.rank)] == [r[0] for r in drawn]
    assert sorted(r.rank for r in out if r.rank is not None) == list(range(1, len(drawn) + 1))


def test_runs_across_lines():
    hasher = resample.Hasher(3, 1 << 31)
    text = b"a b\nc\n\nd e f g\nh"
    words = [w for line in text.split(b"\n") for w in line.split()]
    every = Counter(crc32(b" ".join(words[i:i + n])) % (1 << 31) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    inside = Counter(b for line in text.split(b"\n") for b in hasher.line(line)[1].tolist())
    assert inside + Counter(hasher.crossing(text).tolist()) == every


def test_repeated_rows_and_no_target(spark):
    rows = shared.ODD * 2
    out = resample.resample(shared.docs(spark, rows), shared.docs(spark, []), percent=100, least_words=0).collect()
    assert len(out) == len(rows) and sorted(r.rank for r in out) == list(range(1, len(rows) + 1))
    assert resample.resample(shared.docs(spark, []), shared.docs(spark, rows)).collect() == []


def test_settings(spark):
    for bad in ({"ngrams": 0}, {"buckets": 0}, {"percent": 101}):
        with pytest.raises(ValueError):
            resample.resample(None, None, **bad)
