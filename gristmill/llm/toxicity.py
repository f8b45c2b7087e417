"""Toxicity by a counterfactually regularised classifier.

A text is the set of its words and word beginnings. From labelled texts the features most associated
with the label (chi-squared) are chosen, and a logistic model is fitted on them. In every labelled
text that names a group, the identity terms are swapped for others of their kind; the loss adds
the squared difference of the two scores, so a neutral mention of a group can't move a score much
whatever the labels say.

It learns from a sample of about ``train_docs`` labelled documents outside the held-out fold, chosen
by hash. Counting features is a distributed aggregate; the driver gets ``FEATURES`` features and,
for each sampled document, its label and which of these it has. Every text is then scored
whole. Labels, language, source and id are never inputs of a score.

Null text is the empty text and gets the score of a text without any known feature. Without labelled
rows of both classes every score is the share of label 1 (0.5 without rows). Rows are told apart by row. Several
labels for one id are several training rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gristmill.llm.common import dealt, held_out, ship, with_row
from gristmill.llm.wordscan import Words, byte_values, chunks, letter_bytes
from gristmill.plans.lineage import settle

ship(__name__)

TRAIN_DOCS = 12_000
FEATURES = 4_096       # at most
DOCS_PER_FEATURE = 10  # fewer documents allow fewer features
LEAST_FEATURES = 64
LEAST_DOCS = 5
PREFIXES = (4, 5, 6)
CUTOFF = 0.7
# Identity terms; within a kind each may stand for any other.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "indian"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual"),
    ("woman", "man", "girl", "boy"), ("women", "men", "girls", "boys"),
    ("french", "german", "spanish", "english", "american", "mexican", "chinese", "russian", "turkish", "polish"),
    ("frau", "mann", "mädchen", "junge"), ("femme", "homme", "fille", "garçon"), ("mujer", "hombre", "niña", "niño"),
    ("musulman", "chrétien", "juif"), ("musulmán", "cristiano", "judío"), ("muslimisch", "christlich", "jüdisch"),
    ("immigrant", "refugee", "foreigner"), ("disabled", "deaf", "blind"),
)


@dataclass(frozen=True)
class Model:
    features: np.ndarray     # sorted hashes
    weights: np.ndarray
    bias: float


def swaps() -> dict[bytes, bytes]:
    """Every identity term to the next of its kind."""
    return {a.encode(): b.encode() for kind in IDENTITY for a, b in zip(kind, (*kind[1:], kind[0]))}


def text_features(scan: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning; repeats included."""
    texts, hashes = [scan.text], [scan.hashes]
    for size in PREFIXES:
        at, found = scan.prefixes(size)
        texts.append(scan.text[at])
        hashes.append(found)
    return np.concatenate(texts), np.concatenate(hashes)


def distinct_pairs(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[fresh], feature[fresh]


class Lookup:
    """Which of the chosen features each text has."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.marks = np.zeros(1 << 20, bool)
        self.marks[features % np.uint64(1 << 20)] = True

    def __call__(self, texts: list[bytes], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text, feature = text_features(Words(texts, values))
        maybe = self.marks[feature % np.uint64(1 << 20)]
        text, feature = text[maybe], feature[maybe]
        at = np.searchsorted(self.features, feature)
        at[at == len(self.features)] = 0
        real = self.features[at] == feature if len(self.features) else np.zeros(len(at), bool)
        return distinct_pairs(text[real], at[real])


def counterfactual(text: bytes, values: np.ndarray, terms: dict[bytes, bytes]) -> bytes | None:
    """The text with its identity terms swapped; None where it has none."""
    scan = Words([text], values)
    words = [w.lower() for w in scan.words(0, len(scan.starts))]
    if not any(w in terms for w in words):
        return None
    return b" ".join(terms.get(w, w) for w in words)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_docs: int) -> DataFrame:
    """text and label of the sampled training documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    total, wide = max(1, known.count()), 1 << 30
    if total > train_docs:
        known = known.filter(F.pmod(F.xxhash64(F.lit(5), F.col("id").cast("string")), F.lit(wide))
                             < int(wide * train_docs / total))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col(id_col).alias("id"), text).join(known, "id").select("text", "label")


def choose_features(rows: DataFrame, size: int) -> np.ndarray:
    """The features whose presence says most about the label, sorted: ``size`` of them, or fewer for a small sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(letter_bytes())
        for batch in batches:
            texts, label = batch.column("text").to_pylist(), batch.column("label").to_numpy()
            for first, last in chunks(texts):
                text, feature = distinct_pairs(*text_features(Words(texts[first:last], values)))
                names, back = np.unique(feature, return_inverse=True)
                bad = np.bincount(back, label[first:last][text] == 1, minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.bincount(back, minlength=len(names))), pa.array(bad)],
                    ["feature", "n", "bad"])

    facts = rows.agg(F.count("*").alias("n"), F.sum("label").alias("bad")).first()
    if not facts.n:
        return np.zeros(0, np.uint64)
    rate, size = facts.bad / facts.n, min(size, max(LEAST_FEATURES, facts.n // DOCS_PER_FEATURE))
    counts = dealt(rows).mapInArrow(run, "feature long, n long, bad long").groupBy("feature") \
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).filter(F.col("n") >= LEAST_DOCS)
    signal = F.pow(F.col("bad") - F.col("n") * rate, 2) / F.col("n")
    best = counts.select("feature", signal.alias("signal")).orderBy(F.desc("signal"), "feature").limit(size)
    return np.sort(best.toArrow().column("feature").to_numpy().view(np.uint64))


def design(rows: DataFrame, features: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray | None]]:
    """Labels, and each sampled document's features, as it is and swapped."""
    shared = rows.sparkSession.sparkContext.broadcast(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, terms, look = byte_values(letter_bytes()), swaps(), Lookup(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own: list[list[int]] = [[] for _ in texts]
            other: list[list[int] | None] = [None] * len(texts)
            for i, text in enumerate(texts):
                own[i] = look([text], values)[1].tolist()
                if (swapped := counterfactual(text, values, terms)) is not None:
                    other[i] = look([swapped], values)[1].tolist()
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(own, kind), pa.array(other, kind)], ["label", "own", "other"])

    # As many rows as the sample has.
    table = dealt(rows).mapInArrow(run, "label int, own array<int>, other array<int>").toArrow()
    facts = sorted(zip(table.column("label").to_pylist(), table.column("own").to_pylist(), table.column("other").to_pylist()),
                   key=repr)
    return (np.array([f[0] for f in facts], float), [np.array(f[1], np.int64) for f in facts],
            [None if f[2] is None else np.array(f[2], np.int64) for f in facts])


def fit(label: np.ndarray, own: list[np.ndarray], other: list[np.ndarray | None], size: int,
        swap_penalty: float = 5.0, weight: float = 1.0, penalty: float = 2e-5, rounds: int = 600, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias: log loss, ridge, and the squared score change of swapped texts; by Adam.

    ``weight`` is what a document with label 1 counts against one with label 0.
    """
    share = float(label.mean()) if len(label) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(size), float(np.log(share / (1 - share)))
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    col = np.concatenate(own) if own else np.zeros(0, np.int64)
    pairs = [i for i, x in enumerate(other) if x is not None]
    swapped_row = np.repeat(np.arange(len(pairs)), [len(other[i]) for i in pairs])
    swapped_col = np.concatenate([other[i] for i in pairs]) if pairs else np.zeros(0, np.int64)
    paired = np.array(pairs, np.int64)
    number = np.full(len(own), -1)
    number[paired] = np.arange(len(pairs))
    w, bias = np.zeros(size), float(np.log(share / (1 - share)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    n = len(label)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(row, w[col], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        pull = (p - label) * np.where(label == 1, weight, 1.0) / n
        if len(pairs):
            z2 = bias + np.bincount(swapped_row, w[swapped_col], minlength=len(pairs))
            p2 = 1 / (1 + np.exp(-np.clip(z2, -30, 30)))
            gap = 2 * swap_penalty * (z[paired] - z2) / n
            pull[paired] += gap
            back = -gap
        slope = np.bincount(col, pull[row], minlength=size) + penalty * w
        if len(pairs):
            slope += np.bincount(swapped_col, back[swapped_row], minlength=size)
        g = np.append(slope, pull.sum() if not len(pairs) else pull.sum() - gap.sum())
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        move = rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
        w, bias = w - move[:-1], bias - float(move[-1])
    return w, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_docs: int = TRAIN_DOCS, features: int = FEATURES, swap_penalty: float = 5.0) -> Model:
    rows = settle(labelled(docs, labels, id_col, text_col, label_col, train_docs))
    chosen = choose_features(rows, features)
    label, own, other = design(rows, chosen)
    weights, bias = fit(label, own, other, len(chosen), swap_penalty)
    return Model(chosen, weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: row, id, score."""
    # Plain arrays: workers need not know this package's classes.
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights))
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = shared.value
        values, look = byte_values(letter_bytes()), Lookup(features)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            z = np.full(len(texts), bias)
            for first, last in chunks(texts):
                text, feature = look(texts[first:last], values)
                z[first:last] += np.bincount(text, weights[feature], minlength=last - first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                ["row", "id", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = with_row(dealt(source))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, score double")
