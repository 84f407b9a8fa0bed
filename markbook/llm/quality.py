"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated output.

Every word has a sparse random index vector given by its hash. The vector of a word is the sum of the index vectors of its
neighbours over the whole corpus (random indexing); words share ``BUCKETS`` rows, so the table has a fixed size whatever the
vocabulary. A document is the mean of its word vectors, joined by the mean of index vectors for the words' shapes (case,
punctuation, length, repetition), which context alone does not show. The network is fitted on a bounded sample of labelled
rows (``MAX_TRAIN``); its temperature is set on a part of them that it was not fitted on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, crc_mod

BUCKETS, DIMS, SHAPE_DIMS, NONZERO, REACH = 1 << 13, 64, 128, 4, 2
MAX_TRAIN = 8000
HIDDEN, EPOCHS, SEED = 32, 400, 7

_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_LETTER[128:] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def index_slots(hashes: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ``NONZERO`` entries of each hash's index vector."""
    spread = hashing.mix(hashes[:, None] + np.arange(1, NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (spread % np.uint64(dims)).astype(np.int64), np.where(spread >> np.uint64(63), 1, -1)


def words_and_shapes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and hashes of each word's shape."""
    words, starts, ends, _ = hashing.hashes_and_spans(text)
    if not len(words):
        return words, words
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    total = lambda table: (upto := np.concatenate([[0], np.cumsum(table[raw])]))[ends] - upto[starts]
    size = ends - starts
    upper, letters, digits = total(_UPPER), total(_LETTER), total(_DIGIT)
    last = np.where(_LETTER[raw[ends - 1]] == 1, 0, raw[ends - 1]).astype(np.int64)
    case = np.where(upper == 0, 0, np.where(upper == letters, 2 + (letters > 1), 1))
    marks = np.minimum(size - letters - digits, 4)
    again = np.r_[False, words[1:] == words[:-1]]
    long = np.searchsorted([2, 3, 5, 8, 13, 21, 55], size, side="right")
    features = [(case * 8 + marks) * 256 + last, (long * 8 + case) * 2 + again, (marks * 4 + np.minimum(digits, 3)) * 2 + again]
    out = [hashing.mix(f.astype(np.uint64) + np.uint64((i + 1) << 40)) for i, f in enumerate(features)]
    return words, np.stack(out, 1)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbours' index vectors over one task: ``slot`` is bucket and dimension."""
    total = np.zeros(BUCKETS * DIMS, np.int64)
    pile, docs, n = [], 0, 0

    def add() -> None:
        nonlocal total
        words = np.concatenate([w for w, _ in pile])
        owner = np.concatenate([np.full(len(w), d) for w, d in pile])
        rows = (words % np.uint64(BUCKETS)).astype(np.int64) * DIMS
        places, signs = index_slots(words, DIMS)
        for o in range(1, REACH + 1):
            same = np.flatnonzero(owner[o:] == owner[:-o])
            for here, there in ((same, same + o), (same + o, same)):
                slots = (rows[here, None] + places[there]).ravel()
                total += np.bincount(slots, signs[there].ravel(), len(total)).astype(np.int64)

    for batch in batches:
        for text in batch.column(0):
            words = hashing.word_hashes(text.as_py())
            pile.append((words, docs))
            docs += 1
            n += len(words)
            if n > 300_000:
                add()
                pile, n = [], 0
    if n:
        add()
    used = np.flatnonzero(total)
    for lo in range(0, len(used), 100_000):
        part = used[lo : lo + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["slot", "value"])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Word vectors by bucket, of length one; summed by Spark over all texts."""
    sums = texts.mapInArrow(_contexts, "slot int, value long").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    table = np.zeros(BUCKETS * DIMS)
    table[sums["slot"].to_numpy()] = sums["value"].to_numpy()
    table = table.reshape(BUCKETS, DIMS)
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norms, norms, 1)).astype(np.float32)


def document_vector(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector, and the log of the length; zeros without words."""
    words, shapes = words_and_shapes(text)
    out = np.zeros(DIMS + SHAPE_DIMS + 1, np.float32)
    if len(words):
        counts = np.bincount((words % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        out[:DIMS] = counts[used] @ vectors[used] / len(words)
        kinds, n = np.unique(shapes, return_counts=True)
        places, signs = index_slots(kinds, SHAPE_DIMS)
        out[DIMS:-1] = np.bincount(places.ravel(), (signs * n[:, None]).ravel(), SHAPE_DIMS) / len(words)
        out[-1] = np.log(len(words))
    return out


@dataclass
class Network:
    """Two layers over standardized inputs; ``score`` gives calibrated probabilities."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit on four fifths of the rows, set the temperature on the rest. Without both labels: their smoothed share."""
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        rate = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    own, rest = order[len(y) // 5 :], order[: len(y) // 5]
    scale = x[own].std(0)
    net = Network(x[own].mean(0), np.where(scale > 1e-6, scale, 1), rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z, t = (x[own] - net.mean) / net.scale, y[own]
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(z @ params[0] + params[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -30, 30))) - t) / len(t)
        back = np.outer(error, params[2]) * (1 - hidden**2)
        grads = [z.T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], np.array([error.sum()])]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] -= 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if len(rest):
        logits = net.logits(x[rest])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda c: _log_loss(logits / c, y[rest])))
    return net


def _pooled(vectors: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [document_vector(t.as_py(), vectors).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("label"), pa.array(rows, pa.binary())], ["doc", "label", "vector"])

    return run


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", folds: tuple[int, int] = (3, 1), max_train: int = MAX_TRAIN) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts, and the network from at most ``max_train`` labelled rows outside the held-out fold."""
    texts = docs.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    vectors = word_vectors(texts.select("text").where("text is not null"))
    usable = labels.select(F.col(id_column).alias("doc"), F.col(label_column).cast("int").alias("label")).where("label in (0, 1)")
    usable = usable.where(crc_mod("doc", folds[0]) != folds[1]).groupBy("doc").agg(F.max("label").alias("label"))
    sample = usable.orderBy(F.xxhash64("doc"), "doc").limit(max_train)  # bounded, so it can be broadcast
    rows = texts.join(F.broadcast(sample), "doc").select("doc", "label", "text").mapInArrow(_pooled(vectors), "doc long, label int, vector binary")
    found = rows.orderBy(F.xxhash64("doc"), "vector").limit(max_train).toArrow()
    y = found["label"].to_numpy().astype(float)
    x = np.array([np.frombuffer(v.as_buffer(), np.float32) for v in found["vector"]], float).reshape(len(y), DIMS + SHAPE_DIMS + 1)
    return vectors, fit(x, y)


def score_column(vectors: np.ndarray, net: Network):
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        x = np.array([document_vector(t.as_py(), vectors) for t in text], float).reshape(len(text), -1)
        return pa.array(net.score(x) if len(text) else [], pa.float64())

    return score


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 if score >= 0.5).

    Only texts are inputs of a score. Missing and empty texts are scored as texts without words. Labels other than 0 and 1, and
    those of unknown documents, are not used; of several labels of a document the highest counts. Without labels every score is
    1/2; with one kind of label it is that label's smoothed share. Columns of ``docs`` named ``score`` or ``predicted`` are
    replaced.
    """
    Shared(spark)  # sets the size of Arrow batches
    vectors, net = train(spark, docs, labels, id_column, text_column, **options)
    scored = docs.withColumn("score", score_column(vectors, net)(F.col(text_column)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
