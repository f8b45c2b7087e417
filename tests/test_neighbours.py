"""The pruned, blocked search against brute force, on shapes that stress it."""

import numpy as np
import pytest

from gristmill.operators import issues, neighbours as nb, repair
from gristmill.plans import joins
from gristmill.plans.lineage import settle


def brute(ids, raw):
    norm = np.linalg.norm(raw, axis=1, keepdims=True)
    unit = np.hstack([raw / np.where(norm == 0, 1, norm), (norm == 0).astype(float)])
    return np.round(np.maximum(0.0, 1.0 - unit @ unit.T), 6) + 0.0


def shapes():
    rng = np.random.default_rng(3)
    clusters = rng.normal(size=(12, 16))
    spread = np.repeat(clusters, 20, axis=0) + 0.05 * rng.normal(size=(240, 16))
    hot = np.vstack([spread, np.repeat(spread[:1], 130, axis=0), np.zeros((3, 16))])
    return {"scattered": rng.normal(size=(200, 8)), "clustered": spread, "a third are copies": hot}


@pytest.mark.parametrize("shape", sorted(shapes()))
@pytest.mark.parametrize("cell_rows, block_rows", [(2048, 4096), (16, 12)])
def test_exact(spark, monkeypatch, shape, cell_rows, block_rows):
    if block_rows == 12:
        monkeypatch.setattr(joins, "HOT_ROWS", 20)
        monkeypatch.setattr(nb, "CHUNK_ROWS", 25)
    raw = shapes()[shape]
    ids = np.random.default_rng(0).permutation(len(raw) * 3)[:len(raw)]
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, raw)],
                               "id long, embedding array<double>")
    distance = brute(ids, raw)
    index = nb.build_index(df, cell_rows, block_rows)
    if block_rows == 12:
        assert index.tree.blocks.sum() > 5

    k = 5
    got = {r.id: [(n.d, n.id) for n in r.neighbours] for r in nb.knn(index, k).collect()}
    for row, i in enumerate(ids):
        expected = sorted((distance[row, c], j) for c, j in enumerate(ids) if c != row)[:k]
        assert got[i] == expected

    radius = float(np.quantile(distance, 0.1))
    around = {r.id: (r.others, r.first_other) for r in nb.within(index, radius).collect()}
    for row, i in enumerate(ids):
        near = [j for c, j in enumerate(ids) if c != row and distance[row, c] <= radius]
        assert around[i] == (len(near), min(near, default=None))


def clustered(spark, n=3_000, dims=12, seed=8):
    rng = np.random.default_rng(seed)
    raw = rng.normal(size=(40, dims))[rng.integers(0, 40, n)] + 0.15 * rng.normal(size=(n, dims))
    return raw, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(raw)], "id long, embedding array<double>")


def test_many_tops_and_a_part_of_the_rows(spark):
    raw, df = clustered(spark)
    index = nb.build_index(df, cell_rows=20, block_rows=16)
    assert len(index.tree.tops) > 8 and len(index.tree.pivots) > 100
    distance = brute(range(len(raw)), raw)

    def check(index, rows):
        got = {r.id: [(n.d, n.id) for n in r.neighbours] for r in nb.knn(index, 6).collect()}
        assert sorted(got) == rows
        for i in rows[::7]:
            assert got[i] == sorted((distance[i, j], j) for j in rows if j != i)[:6]

    check(index, list(range(len(raw))))
    # Two parts of the rows, the second of the first, without building an index again.
    some = nb.restricted(index, df.filter("id % 3 <> 0"))
    check(some, [i for i in range(len(raw)) if i % 3])
    check(nb.restricted(some, df.filter("id < 1000")), [i for i in range(1000) if i % 3])


def test_restricted_groups_take_a_new_name(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0] if i < 5 else [0.0, 1.0 + i]) for i in range(8)], "id long, embedding array<double>")
    index = nb.restricted(nb.build_index(df), df.filter("id > 1"))
    assert {(r.id, r.grp) for r in index.members.collect()} == {(2, 2), (3, 2), (4, 2), (5, 5), (6, 6), (7, 7)}
    assert {(r.grp, r.copies) for r in index.groups.collect()} == {(2, 3), (5, 1), (6, 1), (7, 1)}
    gone = nb.restricted(index, df.filter("id < 0"))
    assert nb.knn(gone, 3).collect() == [] and nb.within(gone, 0.1).collect() == []


def test_probing_misses_little_and_everything_is_exact(spark):
    raw, df = clustered(spark)
    index = nb.build_index(df, cell_rows=50, block_rows=64)
    truth = settle(nb.knn(index, 6))
    some = nb.recall(nb.approximate_knn(index, 6, probes=6), truth).first()
    assert some.wanted == 6 * len(raw) and 0.9 <= some.recall <= 1.0
    few = nb.recall(nb.approximate_knn(index, 6, probes=1, tops=1), truth).first()
    assert few.recall < some.recall
    every = nb.approximate_knn(index, 6, probes=10_000, tops=10_000)
    assert sorted(map(str, every.collect())) == sorted(map(str, truth.collect()))
    with pytest.raises(ValueError):
        nb.approximate_knn(index, 6, probes=0)


def test_what_a_search_moves_does_not_grow_with_its_blocks(spark):
    """Without structure every row visits every block; it still travels once a bundle, and k rows at most come back."""
    from pyspark.sql import functions as F
    raw = np.random.default_rng(4).normal(size=(2_000, 10))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "id long, embedding array<double>")
    index = nb.build_index(df, cell_rows=12, block_rows=16)
    rows = index.groups.select("grp", "vec", "cell", "block", F.lit(2.0).alias("reach"))
    found = nb._meet(index, rows, nb._wanted_cells, True, nb._solver(3), nb._PAIRS)
    assert index.tree.blocks.sum() > 100 and found.count() <= 3 * len(raw) * 9
    plan = settle(nb._meet(index, rows, nb._wanted_cells, True, nb._solver(3), nb._PAIRS)).groupBy("grp").count()
    assert plan.filter("count < 3").count() == 0


def test_single_row_and_small_tables(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    assert nb.knn(nb.build_index(one), 3).first().neighbours == []
    near = settle(nb.knn(nb.build_index(one), 3))
    assert issues.near_duplicate_cutoff(near) == 0.0
    issue = issues.near_duplicate_issues(near, 0.0).first()
    assert not issue.is_near_duplicate_issue and issue.near_duplicate_score == 1.0
    assert not issues.outlier_issues(near).first().is_outlier_issue


def test_sets_of_three(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [1.0, 0.0, 0.01])] + [
        (10 + i, v) for i, v in enumerate(np.random.default_rng(5).normal(size=(12, 3)).tolist())]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    index = nb.build_index(df)
    near = settle(nb.knn(index, 5))
    found = issues.near_duplicate_issues(near, 0.001)
    assert {r.id for r in found.filter("is_near_duplicate_issue").collect()} == {1, 2, 3}
    assert {r.id: set(r.nearest_duplicates) for r in found.collect()}[1] == {2, 3}
    assert {r.id for r in repair.drop_near_duplicates(df, found).collect()}.isdisjoint({1, 2, 3})
    left = repair.drop_near_duplicates(df, found, "first", nb.within(index, 0.001)).collect()
    assert {1, 2, 3} & {r.id for r in left} == {1}


def test_documents_are_embedded_once(spark, monkeypatch, tmp_path):
    from gristmill.catalog import neighbouring
    rows = [(i, f"word{i % 7} other{i % 5} end{i}") for i in range(40)] + [(50, "word1 other1 end1")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, embed = spark.sparkContext.accumulator(0), neighbouring.vec.hashed_embeddings

    def counted(df):
        def look(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        found = embed(df)
        return found.mapInArrow(look, found.schema)

    monkeypatch.setattr(neighbouring.vec, "hashed_embeddings", counted)
    shown = {r.id: r for r in neighbouring.duplicate_examples(spark, str(tmp_path)).collect()}
    assert shown[1].text == "word1 other1 end1" and shown[1].duplicates.split("|")[0] == "word1 other1 end1"
    assert seen.value == len(rows)


def test_examples_of_repeated_ids_and_missing_texts(spark, tmp_path):
    rows = [(1, "a"), (1, "A"), (2, None), (3, "c"), (4, "d"), (None, "n")]
    spark.createDataFrame(rows, "id long, text string").write.parquet(f"{tmp_path}/corpus")
    corpus = spark.read.parquet(f"{tmp_path}/corpus")
    found = spark.createDataFrame(
        [(1, True, 0.5, [3, 2, 9]), (1, True, 0.5, [3, 2, 9]), (2, True, 0.1, [1]), (3, True, 0.2, [9]), (4, False, 0.9, [1]), (8, True, 0.3, [4])],
        "id long, is_near_duplicate_issue boolean, near_duplicate_score double, nearest_duplicates array<long>")
    shown = repair.duplicate_examples(corpus, found)
    assert shown.columns == ["id", "text", "near_duplicate_score", "duplicates"]
    assert sorted(map(tuple, shown.collect()), key=str) == sorted([
        (1, "a", 0.5, ["c", "c", None, None]), (1, "A", 0.5, ["c", "c", None, None]), (2, None, 0.1, ["A", "a"])], key=str)
    # The plan reads the texts in one place.
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_dealt_out(spark, monkeypatch, how):
    from pyspark.sql import functions as F
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    left = spark.range(100).select("id", F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(k, f"v{k}") for k in (0, 1, 2, 3, 9)], "k long, v string")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    got = joins.hot_join(left, right, ["k"], counts, how)
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, want.select("id", "k", "v").collect()))
    assert "__part" in got._jdf.queryExecution().analyzed().toString() and "__part" not in got.columns


def test_single_precision_only_chooses_what_is_computed_again():
    pick = np.random.default_rng(5)
    rows = pick.standard_normal((300, 64))
    rows[100:200] = rows[:100] + 1e-4 * pick.standard_normal((100, 64))
    rows = np.hstack([rows / np.linalg.norm(rows, axis=1, keepdims=True), np.zeros((300, 1))])
    true = rows @ rows.T
    sim, room = nb._near(rows, rows)
    assert sim.dtype == np.float32 and (np.abs(sim - true) <= room).all()
    # Floors at the very products, few of which single precision gives: none of them is lost, with many entries above the floor or few.
    for floor in (np.sort(true, axis=1)[:, -2], np.sort(true, axis=1)[:, 20]):
        r, c, found = nb._again(nb._at_least(sim, room, floor), rows, rows)
        got = set(zip(r.tolist(), c.tolist()))
        assert got >= set(zip(*(x.tolist() for x in np.nonzero(true >= floor[:, None])))) and found == pytest.approx(true[r, c], abs=1e-14)
    wants = (np.arange(300)[:, None] % 3 != np.arange(3)[None, :], np.repeat(np.arange(3), 100))
    everywhere, ids = np.full(300, 2.0), np.arange(300)
    for chosen in (None, wants):
        r, c, d = nb._nearest_k(rows, rows, chosen, ids, ids, 4, everywhere)
        for i in range(300):
            open_ = [j for j in range(300) if j != i and (chosen is None or chosen[0][i, chosen[1][j]])]
            assert list(zip(d[r == i], c[r == i])) == sorted((round(max(0.0, 1 - true[i, j]), 6), j) for j in open_)[:4]


def test_waves_move_a_bounded_number_of_vectors_and_change_nothing(spark, monkeypatch):
    pick = np.random.default_rng(8)
    data = [(i, [float(x) for x in row]) for i, row in enumerate(np.round(pick.standard_normal((400, 4)), 1))]
    index = nb.build_index(spark.createDataFrame(data, "id long, embedding array<double>"), cell_rows=20, block_rows=40)
    made, real = [], nb._waves

    def counted(*args):
        made.append(real(*args))
        return made[-1]

    def run():
        near = {r.id: [(n.d, n.id) for n in r.neighbours] for r in nb.knn(index, 5).collect()}
        probed = {r.id: [(n.d, n.id) for n in r.neighbours] for r in nb.approximate_knn(index, 5).collect()}
        return near, probed, {r.id: (r.others, r.first_other) for r in nb.within(index, 0.05).collect()}

    monkeypatch.setattr(nb, "_waves", counted)
    whole = run()
    assert len(index.tree.bundles) > 3 and all(len(w) == 1 for w in made)
    made.clear()
    monkeypatch.setattr(nb, "WAVE_BYTES", 1)
    monkeypatch.setattr(nb, "WAVE_TIMES", 2)
    assert run() == whole
    assert all(len(w) > 2 and [a for a, _ in w[1:]] == [b for _, b in w[:-1]] and w[0][0] == 0 and w[-1][1] == len(index.tree.bundles) for w in made)
    assert nb._waves({0: 3, 2: 1}, 10, 4, 50, 5) == [(0, 2), (2, 4)]
