"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of single words, neighbouring pairs and pairs that skip one word, of the
whole text, hashed into 2**DIM_BITS slots. Each coordinate has its own learning rate; L1 leaves few
weights that aren't 0, so the model is a short list that every task can hold (at most 2**DIM_BITS
entries, some thousands in practice).

The model is fitted on at most MAX_TRAIN labelled documents, those whose hashed id is smallest; all
documents are scored. Null and empty texts get the score of the intercept alone. A document that is
labelled more than once counts as toxic if any label says so; null labels don't count. With no
labelled document there is no model, and every score is 0. Rows with a null id are scored but never learnt from;
rows that repeat an id are all scored, and one of them is the example if the id is drawn: the one whose text has the smallest hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

DIM_BITS = 20
MAX_TRAIN = 12_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.6, 1.0, 6.0, 0.5
THRESHOLD = 0.3
HELD_OUT = (4, 2)  # rows whose crc32(id) has remainder 2 by 4 are never learnt from
BIAS = 0  # the slot of the intercept

_WORD = re.compile(r"[^\W_]+")
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_MOST_WORDS = 200_000


class _Words(dict):
    """64-bit hashes of words; it starts anew when it is full."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = value
        return value


_words = _Words()
common.cache("toxicity", _words)


def slots(text: str) -> np.ndarray:
    """The slots of a text's features, repeats included."""
    found = _WORD.findall(text.lower())
    w = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    one = w * _K[0]
    parts = [one]
    for skip, k in ((1, _K[1]), (2, _K[2])):
        if len(w) > skip:
            parts.append((w[:-skip] * k) ^ (w[skip:] * _K[0] + k))
    mixed = np.concatenate(parts)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _K[2]
    return (mixed >> np.uint64(64 - DIM_BITS)).astype(np.int32)


def present(text: str) -> np.ndarray:
    found = np.unique(slots(text))
    return found[found != BIAS]


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -35.0), 35.0))))


class Ftrl:
    """FTRL-proximal: the weights follow lazily from z (sums of gradients) and n (sums of squares)."""

    def __init__(self, dim: int = 1 << DIM_BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(dim), np.zeros(dim)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == BIAS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> float:
        w = self.weights(at)
        p = sigmoid(w.sum())
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        return p

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights(np.arange(len(self.z)))
        at = np.flatnonzero(w)
        return at.astype(np.int32), w[at]


def fit_examples(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    model = Ftrl()
    with_bias = [(np.concatenate([[BIAS], at]), y) for at, y in examples]
    for _ in range(epochs):
        for at, y in with_bias:
            model.learn(at, y)
    return model.sparse()


def held_out(id_col: str = "doc_id") -> Column:
    by, rest = HELD_OUT
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(by)) == rest, F.lit(False))


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", most: int = MAX_TRAIN) -> DataFrame:
    """(id, label) of at most ``most`` labelled ids that aren't held out."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    one = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("id"), "id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of the model. The sample, of ``most`` ids at most, is broadcast to pick the
    texts, one an id; their features go to one task, which fits; what comes back is the sparse model."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("toxicity")
        for b in common.slices(batches):
            found = [present(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["at", "label", "slots"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort()
        at, w = fit_examples([(np.frombuffer(s, np.int32), y) for _, y, s in rows])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w, pa.float64())], ["slot", "weight"])

    sample = F.broadcast(labelled(labels, id_col, most=most))
    texts = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    one = texts.join(sample, "id").groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = one.select(F.xxhash64("id").alias("at"), "label", "text")
    model = rows.mapInArrow(featurise, "at long, label int, slots binary").repartition(1).mapInArrow(train, "slot int, weight double")
    found = model.collect()
    return np.array([r.slot for r in found], np.int32), np.array([r.weight for r in found])


def scorer(model: tuple[np.ndarray, np.ndarray]):
    """score(text) of a model; the dense table is made once a task."""
    at, w = model
    dense = np.zeros(1 << DIM_BITS)
    dense[at] = w
    bias = dense[BIAS]
    dense[BIAS] = 0

    def score(text: str) -> float:
        found = slots(text)
        hit = found[dense[found] != 0]
        return sigmoid(bias + dense[np.unique(hit)].sum()) if len(at) else 0.0

    return score


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of docs, with the score as a further column; a column of that name is replaced."""
    docs = docs.drop(name)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("toxicity")
        of = scorer(shared.value)
        for b in common.slices(batches):
            found = pa.array([of(t.as_py() or "") for t in b.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, found], schema=b.schema.append(pa.field(name, pa.float64())))

    schema = docs.withColumn(name, F.lit(0.0)).schema
    return common.over_arrow(docs, run, schema)


def rejected(name: str = "score") -> Column:
    return F.col(name) >= THRESHOLD


def op10(spark, sf_dir: str) -> DataFrame:
    """Scores of every text of documents."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", rejected().cast("int").alias("predicted"))
