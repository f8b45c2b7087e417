import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import shared
from gristmill.llm import components, exact_dedup, line_dedup, simhash


@pytest.mark.parametrize("keep", ["first", "last"])
def test_exact_dedup_trees_agree_with_grouping(spark, keep):
    rng = random.Random(3)
    rows = [(i, rng.choice(["Same Text", "same text", "other", "É", "é", str(rng.randrange(40))])) for i in range(600)]
    pick = min if keep == "first" else max
    groups = {}
    for i, text in rows:
        groups.setdefault("".join(c.lower() if c.isascii() else c for c in text), []).append(i)
    want = {i: (pick(ids), len(ids), i == pick(ids)) for ids in groups.values() for i in ids}
    for run_rows, fan_in in ((10, 2), (50, 8), (10_000, 4)):
        found = exact_dedup.decide(shared.docs(spark, rows), keep=keep, run_rows=run_rows, fan_in=fan_in).collect()
        assert {r.id: (r.keep_id, r.group_size, r.kept) for r in found} == want


def test_exact_dedup_keeps_one_of_equal_rows(spark):
    found = exact_dedup.decide(shared.docs(spark, shared.ODD), keep="last").collect()
    assert len(found) == len(shared.ODD)
    assert sum(r.kept for r in found) == len({r.digest for r in found})
    with pytest.raises(ValueError):
        exact_dedup.decide(shared.docs(spark, []), keep="any")


def brute_lines(rows, n=3):
    first, gone = {}, {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        for p in range(len(lines) - n + 1):
            w = tuple(lines[p:p + n])
            if any(w):
                if w in first:
                    gone.setdefault(i, set()).update(range(p, p + n))
                first.setdefault(w, (i, p))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in rows}


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice("abcd") if rng.random() < 0.8 else "" for _ in range(rng.randrange(12)))) for i in range(80)]
    want = brute_lines(rows)
    table = shared.docs(spark, rows)
    marked = line_dedup.mark(table, slice_rows=7)
    got = {r.doc_id: r.kept for r in marked.select("doc_id", F.array_join(line_dedup.kept_lines(), "\n").alias("kept")).collect()}
    assert got == want
    rest = line_dedup.remove_repeats(table)
    assert rest.columns == table.columns
    kept = {r.doc_id: r.text for r in rest.collect()}
    assert all(want[i] == t for i, t in kept.items())
    assert all(want[i] == "" for i, _ in rows if i not in kept)


def test_line_dedup_counts_equal_rows_as_one_document(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\na\nb\nc\ny"), (3, None), (4, "\n\n\n\n")]
    found = sorted((r.doc_id, r.text) for r in line_dedup.remove_repeats(shared.docs(spark, rows)).collect())
    assert found == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\ny"), (3, None), (4, "\n\n\n\n")]


def brute_fingerprint(text, size=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    text = (text or "")
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(0, 400, 4):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 60]))]
        for k in range(4):
            rows.append((i + k, " ".join(words)))
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rows += [(400, None), (401, "É é x"), (402, "A\tB\x0bC")]
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, 2)
    for leaf_rows in (8, 10_000):
        found = {r.id: r for r in simhash.groups(shared.docs(spark, rows), leaf_rows=leaf_rows).collect()}
        assert [found[i].fp & (2**64 - 1) for i, _ in rows] == fps
        assert [found[i].component_id for i, _ in rows] == [rows[r][0] for r in roots]


def test_tree_finds_every_close_pair(spark, monkeypatch):
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(300)]
    fps = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(6)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    roots = brute_components(fps, 2)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    monkeypatch.setattr(simhash, "TILE", 4096)
    linked = simhash.fingerprint_groups(spark.createDataFrame([(s,) for s in signed], "fp long"), 2, leaf_rows=64).collect()
    got = {r.fp: r.root for r in linked}
    groups, want = {}, {}
    for s, r in zip(signed, roots):
        groups.setdefault(got.get(s, s), set()).add(s)
        want.setdefault(r, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_forest_joins_a_root_met_late():
    fps = np.array([7, 64, 128, 134], np.uint64)
    values, roots = simhash.forest(fps, fps, 2)
    assert dict(zip(values.tolist(), roots.tolist())) == {64: 7, 128: 7, 134: 7}


def chains(seed, count, length):
    """Distinct fingerprints of walks by two bits a step, and the smallest of each one's group by union-find."""
    rng = random.Random(seed)
    fps = set()
    for _ in range(count):
        at = rng.getrandbits(64)
        for _ in range(length):
            fps.add(at)
            for bit in rng.sample(range(64), 2):
                at ^= 1 << bit
    fps = np.array(sorted(fps), np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 2).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return fps, fps[[find(i) for i in range(len(fps))]]


@pytest.mark.parametrize("tile", [64, 4096, simhash.TILE])
@pytest.mark.parametrize("seed, count, length", [(1, 40, 12), (2, 3, 1_000), (3, 1, 3_000)])
def test_forest_against_union_find_on_long_chains(monkeypatch, tile, seed, count, length):
    monkeypatch.setattr(simhash, "TILE", tile)
    fps, want = chains(seed, count, length)
    values, roots = simhash.forest(fps, fps, 2)
    got = dict(zip(values.tolist(), roots.tolist()))
    assert [got.get(f, f) for f in fps.tolist()] == want.tolist()


@pytest.mark.parametrize("block, tile, leaf_rows", [(64, 4096, 64), (simhash.BLOCK, simhash.TILE, simhash.LEAF_ROWS)])
def test_groups_against_union_find_on_long_chains(spark, monkeypatch, block, tile, leaf_rows):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "TILE", tile)
    fps, want = chains(4, 8, 300)
    table = spark.createDataFrame([(f,) for f in fps.view(np.int64).tolist()], "fp long")
    got = {r.fp: r.root for r in simhash.fingerprint_groups(table, 2, leaf_rows=leaf_rows).collect()}
    groups, expected = {}, {}
    for fp, signed, r in zip(fps.tolist(), fps.view(np.int64).tolist(), want.tolist()):
        groups.setdefault(got.get(signed, signed), set()).add(fp)
        expected.setdefault(r, set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept(docs):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.source or "") for r in simhash.keep_first(docs).collect())


def test_first_of_each_group_by_id_and_text(spark):
    a, b = "alpha beta gamma delta " * 9, "some quite different text with words of its own"
    assert kept(shared.docs(spark, [(3, a), (5, a), (5, b)])) == [(False, 3, a, ""), (False, 5, b, "")]
    # Equal rows: one stays, the least in its other columns. Null ids come last.
    rows = [(3, a, "en", "z"), (3, a, "en", "y"), (None, a), (None, a), (None, b), (None, b)]
    assert kept(shared.docs(spark, rows)) == [(False, 3, a, "y"), (True, 0, b, "")]
    out = kept(shared.docs(spark, shared.ODD))
    # 1, 2, 3 and a null row are blank and one group; 4 and both rows of 5 are equal texts.
    assert [x[1] for x in out if not x[0]] == [1, 4, 6, 7, 7, 8, 9] and [x[2] for x in out if x[0]] == ["no id here"]
