"""Quality rules against plain versions."""

import random
import re

import numpy as np
import pytest

import shared
from gristmill.llm import queries, repetition


def brute_repeats(text, least):
    """Covered bytes, longest repeat and spans by comparing all pairs of suffixes."""
    deepest, hit = 0, [False] * (len(text) + 1)
    for i in range(len(text)):
        depth = 0
        for j in range(len(text)):
            if i != j:
                k = 0
                while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                    k += 1
                depth = max(depth, k)
        deepest = max(deepest, depth)
        if depth >= least:
            hit[i:i + depth] = [True] * depth
    edges = np.flatnonzero(np.diff(np.array([False, *hit]).astype(int)))
    return sum(hit), deepest if deepest >= least else 0, list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def texts():
    rnd, out = random.Random(5), [b"a" * 60, b"ab" * 40, b"", b"x", b"abcdefgh" * 2, b"abcdefgh" * 3, b"\0" * 40, "é漢".encode() * 9]
    for _ in range(60):
        words = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 12))]
        out.append(b" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))))
    return out


@pytest.mark.parametrize("least", [8, 16])
@pytest.mark.parametrize("piece", [37, 1 << 20])
def test_repeats_equal_all_pairs(monkeypatch, least, piece):
    monkeypatch.setattr(repetition, "PIECE_BYTES", piece)
    got = repetition.repeats(texts(), least)
    for text, found in zip(texts(), got):
        covered, longest, spans = brute_repeats(text, least)
        assert (found[0], found[1]) == (covered, longest)
        united = []
        for a, b in found[2]:  # touching spans count as one in the plain version
            if united and united[-1][1] == a:
                united[-1] = (united[-1][0], b)
            else:
                united.append((a, b))
        assert united == spans


def test_a_long_text_is_read_in_pieces():
    half = random.Random(1).randbytes(1 << 20).hex().encode()
    (covered, longest, spans), = repetition.repeats([half + b"|" + half], 64)
    assert (covered, longest, spans) == (2 * len(half), len(half), [(0, len(half)), (len(half) + 1, 2 * len(half) + 1)])
    assert repetition.repeats([half], 64) == [(0, 0, [])]


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3_000 else None
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, hit


def check(rows, texts_by_id):
    for r in rows:
        text = texts_by_id[r.doc_id] or ""
        n, chars, symbols, dup, hit = brute_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (n, chars, symbols, dup)
        if hit is not None:
            assert r.n_repeat_words == len(hit)
        assert r.base_failed == (n < 50 or 2 * r.n_repeat_words > n)
        size = len(text.encode())
        assert r.kept == (not r.base_failed and r.covered <= 0.3 * size and r.longest <= 0.2 * size)


def test_query_equals_plain_counts(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op12_quality_rules(spark, sf).collect()
    assert len(rows) == len(docs)
    check(rows, docs)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, shared.LONG), (5, "a b c " * 3 + "\n\n" + "a b c " * 3), (6, "é漢字 x | # \n é漢字 x | # "),
            (7, "same line\n" * 30), (8, "0" * 50_000)]
    docs = shared.docs(spark, rows)
    out = repetition.judge(docs).withColumnRenamed("id", "doc_id").collect()
    check(out, dict(rows))
    by_id = {r.doc_id: r for r in out}
    assert by_id[8].longest == 49_999 and by_id[8].covered == 50_000 and by_id[1].n_bytes == 0
    assert len(repetition.judge(docs.union(docs)).collect()) == 2 * len(rows)


def test_verdict_by_repeats(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(7))
    clean = " ".join(word() for _ in range(400))
    passage = " ".join(word() for _ in range(90))
    # Three copies of a passage: under half of the words repeat, but more than 0.3 of the bytes.
    copied = " ".join([clean[:2_400], passage, clean[2_400:3_000], passage, passage])
    # One long repeat: 0.24 of the text twice.
    long = clean[:800] + "\n" + clean[:800] + clean[800:2_500]
    out = {r.id: r for r in repetition.judge(shared.docs(spark, [(1, clean), (2, copied), (3, long)])).collect()}
    assert out[1].kept and out[1].covered == 0
    assert not out[2].base_failed and not out[2].kept
    assert not out[3].base_failed and not out[3].kept and out[3].longest >= 800


def test_settings():
    with pytest.raises(ValueError):
        repetition.judge(None, least=12)
