"""Every stage against a plain version, on the stage's own input."""

import os
import re
import subprocess
import sys

import pytest

import corpus_pipeline
import shared
from test_dedup import brute_components, brute_fingerprint, brute_lines

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, out = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], sf).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
        if name != "mix":
            assert out[-1].columns == columns
    return [[r.asDict() for r in d.collect()] for d in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_language_keeps_what_has_letters(stages):
    assert len(stages[1]) >= 0.98 * len(stages[0])
    kept = texts(stages[1])
    assert all(texts(stages[0])[i] == t for i, t in kept.items())


def test_lines(stages):
    want = brute_lines([(r["doc_id"], r["text"]) for r in stages[1]])
    assert texts(stages[2]) == {i: t for i, t in want.items() if t}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_one_of_each_group(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[2])
    roots = brute_components([brute_fingerprint(t) for _, t in rows], 2)
    assert texts(stages[3]) == dict(rows[r] for r in set(roots))


def test_benchmark(stages, spark, sf):
    words = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t))
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {" ".join(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w.split()) for w in windows}
    clean = {}
    for i, t in texts(stages[3]).items():
        w = words(t)
        if not any(" ".join(w[p:p + n]) in windows for n in sizes for p in range(len(w) - n + 1)):
            clean[i] = t
    assert texts(stages[4]) == clean


def test_mix_reaches_its_targets(stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sources, taken, whole = {}, {}, {}
    for r in stages[4]:
        sources[r["source"]] = sources.get(r["source"], 0) + size(r["text"])
        whole[r["doc_id"]] = size(r["text"])
    for r in stages[5]:
        taken[r["source"]] = taken.get(r["source"], 0) + r["words"]
        assert r["words"] <= whole[r["doc_id"]] and 1 <= r["epoch"] <= 2
    total, names = sum(sources.values()), sorted(sources)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    aim, held = {}, set()
    while True:
        level = (1.5 * total - sum(2 * sources[s] for s in held)) / sum(weight[s] for s in names if s not in held)
        above = {s for s in names if s not in held and level * weight[s] > 2 * sources[s]}
        if not above:
            break
        held |= above
    aim = {s: 2 * sources[s] if s in held else level * weight[s] for s in names}
    assert {s: taken.get(s, 0) for s in names} == {s: int(aim[s]) for s in names}


@pytest.mark.parametrize("rows", [shared.ODD, []])
@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_odd_tables(spark, tmp_path, name, rows):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = shared.docs(spark, rows)
    out = STAGES[name](spark, docs, str(tmp_path))
    assert out.count() <= 2 * len(rows)
    if name != "mix":
        assert out.columns == docs.columns


ALONE = """
import sys, tempfile
sys.path.insert(0, ROOT)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,2,1500]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.executor.memory", "1g").config("spark.checkpoint.dir", FOLDER).getOrCreate())
from gristmill.llm import queries
from pyspark.sql import functions as F
def absent(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("gristmill") is None
        yield batch
spark.range(1).mapInArrow(absent, "id long").collect()
for name in NAMES:
    assert queries.QUERIES[name](spark, SF).count() > 0, name
"""


def test_workers_need_no_package(sf, tmp_path):
    names = ["op5_toxicity", "op8_language", "op11_importance_resample", "op12_quality_rules", "op13_token_alignment"]
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"ROOT, SF, FOLDER, NAMES = {root!r}, {sf!r}, {str(tmp_path)!r}, {names!r}\n{ALONE}"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
