"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated temperature.

A token's number is a hash of it, so every token of every document counts and no vocabulary is gathered.
Each number has a fixed sparse ternary index vector.  Its word vector is the sum of
the index vectors of its neighbours over all documents: tasks add up their own documents and one
aggregation adds up the tasks.  A document is the mean and the deviation of its words' vectors, a small numpy
network turns that into a logit, and a temperature fitted on labelled documents outside the
training calibrates the probability.

The table of vectors has ``rows`` rows whatever the input; tokens that share a number share its vector, to which
each of them adds as often as it occurs.  Only the network is fitted on a bounded sample of labelled documents.
What is sent to the tasks is bounded by the table; no text is shuffled.

Defined cases: null, empty and tokenless texts are the mean of nothing, a zero vector; documents with
contradicting labels teach nothing; with labels of one class only, every text gets its share; rows that
repeat are scored each; a null identifier is not held out; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, small_batches, text_or_empty
from .toxicity import agreed_labels, bounded_sample, labelled

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n+")
#: Tokens handled at a time, and numbers remembered per task.
BLOCK = 1 << 16
LIMIT = 500_000


@dataclass(frozen=True)
class QualityConfig:
    dimensions: int = 64
    nonzeros: int = 4
    window: int = 2
    #: Numbers that tokens are hashed to.
    rows: int = 1 << 15
    #: Most labelled documents in the sample that the network is fitted on.
    sample_rows: int = 20_000
    hidden: int = 32
    epochs: int = 60
    rate: float = 0.003
    decay: float = 1e-4
    seed: int = 11
    threshold: float = 0.3
    calibration_fold: int = 4


class _Ids(dict):
    """Number of a token."""

    def __init__(self, rows: int):
        self.rows = rows

    def __missing__(self, token: str) -> int:
        found = zlib.crc32(token.encode()) % self.rows
        if len(self) < LIMIT:
            self[token] = found
        return found

    def of(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def index_vectors(n: int, cfg: QualityConfig) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries, the same in every task."""
    rng = np.random.default_rng(cfg.seed)
    places = rng.random((n, cfg.dimensions)).argsort(axis=1)[:, : cfg.nonzeros]
    return places, rng.choice([-1.0, 1.0], (n, cfg.nonzeros))


def word_vectors(docs: DataFrame, cfg: QualityConfig) -> np.ndarray:
    """A row of unit length per token number, from the neighbours of its tokens in all documents."""
    n, d = cfg.rows, cfg.dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, (places, signs) = _Ids(n), index_vectors(n, cfg)
        total, held = np.zeros(n * d), []
        size = 0

        def add() -> None:
            # Documents are kept apart by a gap as wide as the window.
            ids = np.concatenate(held)
            for step in range(1, cfg.window + 1):
                left, right = ids[:-step], ids[step:]
                real = (left >= 0) & (right >= 0)
                left, right = left[real], right[real]
                for at, near in ((left, right), (right, left)):
                    for k in range(cfg.nonzeros):
                        where = at * d + places[near, k]
                        total[:] += np.bincount(where, signs[near, k], n * d)

        gap = np.full(cfg.window, -1, np.int64)
        for batch in batches:
            for text in batch.column("_text"):
                ids = ids_of.of(text.as_py())
                held += [ids, gap]
                size += len(ids)
                if size >= 16 * BLOCK:
                    add()
                    held, size = [], 0
        if held:
            add()
        vectors = total.reshape(n, d).astype(np.float32)
        some = np.flatnonzero(vectors.any(axis=1))
        columns = [pa.array(some)] + [pa.array(vectors[some, j]) for j in range(d)]
        yield pa.RecordBatch.from_arrays(columns, ["id"] + [f"v{j}" for j in range(d)])

    small_batches(docs.sparkSession)
    schema = "id bigint, " + ", ".join(f"v{j} float" for j in range(d))
    sums = (
        docs.select(text_or_empty().alias("_text")).mapInArrow(run, schema)
        .groupBy("id").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(d)])
    )
    out = np.zeros((n, d))
    for row in sums.collect():  # at most cfg.rows
        out[row[0]] = row[1:]
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norms > 0, norms, 1)).astype(np.float32)


def pool(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of a document's vectors in each dimension.

    The second half tells varied texts from those that repeat a few words.
    """
    if not len(ids):
        return np.zeros(2 * vectors.shape[1])
    total, squares = np.zeros(vectors.shape[1]), np.zeros(vectors.shape[1])
    for at in range(0, len(ids), BLOCK):
        some = vectors[ids[at : at + BLOCK]]
        total += some.sum(axis=0)
        squares += np.einsum("ij,ij->j", some, some)
    mean = total / len(ids)
    return np.concatenate((mean, np.sqrt(np.maximum(0, squares / len(ids) - mean**2))))


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2


def train(x: np.ndarray, y: np.ndarray, cfg: QualityConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Adam on the cross entropy of a network with one hidden layer."""
    rng = np.random.default_rng(cfg.seed)
    p = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], cfg.hidden)), np.zeros(cfg.hidden),
        rng.normal(0, 1 / np.sqrt(cfg.hidden), cfg.hidden), np.zeros(1),
    ]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(cfg.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            xb, yb = x[order[at : at + 128]], y[order[at : at + 128]]
            hidden = np.tanh(xb @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - yb) / len(xb)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            gradients = [xb.T @ back + cfg.decay * p[0], back.sum(0), hidden.T @ error + cfg.decay * p[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(gradients):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - cfg.rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return p[0], p[1], p[2], float(p[3][0])


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest cross entropy, on a fine grid."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(-2, 3, 201))
    z = logits[None, :] / grid[:, None]
    loss = np.logaddexp(0, -z * (2 * y - 1)[None, :]).mean(axis=1)
    return float(grid[loss.argmin()])


def _pooled(rows: DataFrame, vectors: np.ndarray) -> DataFrame:
    """label, fold, vector of labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _Ids(len(vectors))
        for batch in batches:
            found = [pool(ids_of.of(t.as_py()), vectors).tolist() for t in batch.column("_text")]
            columns = [batch.column("label"), batch.column("fold"), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "fold", "vector"])

    return rows.select("label", "fold", "_text").mapInArrow(run, "label double, fold int, vector array<double>")


def fit(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> QualityModel:
    small_batches(docs.sparkSession)
    agreed = cut(agreed_labels(labels, "quality"))
    sample = labelled(docs, bounded_sample(agreed, cfg.sample_rows))
    vectors = word_vectors(docs, cfg)
    rows = _pooled(sample, vectors).collect()  # at most cfg.sample_rows
    width = 2 * cfg.dimensions
    x = np.array([r.vector for r in rows]).reshape(len(rows), width)
    y = np.array([r.label for r in rows])
    held = np.array([r.fold == cfg.calibration_fold for r in rows], bool)
    if len(set(y[~held])) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        flat = (np.zeros((width, cfg.hidden)), np.zeros(cfg.hidden), np.zeros(cfg.hidden), float(np.log(share / (1 - share))))
        return QualityModel(vectors, np.zeros(width), np.ones(width), flat)
    centre, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-6
    model = QualityModel(vectors, centre, scale, train((x[~held] - centre) / scale, y[~held], cfg))
    return QualityModel(vectors, centre, scale, model.layers, temperature_of(model.logits(x[held]), y[held]))


def score(docs: DataFrame, model: QualityModel, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """doc_id, held_out, score, predicted; a row for each document row."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_or_empty().alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _Ids(len(model.vectors))
        for batch in batches:
            x = np.array([pool(ids_of.of(t.as_py()), model.vectors) for t in batch.column("_text")])
            z = model.logits(x.reshape(-1, len(model.centre))) / model.temperature
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cfg.threshold).cast("int").alias("predicted"),
    )
