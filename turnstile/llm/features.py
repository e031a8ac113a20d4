"""Hashed word and character n-grams of texts, and linear models over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import hashing
from turnstile.llm.common import fold, keyed_text, text_bytes

WIDTH = 1 << 16  # hashed places of each kind of feature
KINDS = 4  # words, pairs of neighbouring words, runs of three bytes, runs of three classes of bytes
SIZE = WIDTH * KINDS
SCALE = 8.0
# Classes of bytes: small and other letters, capitals, digits; signs and white space stand for themselves.
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[0x80:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")


def _kinds(texts: list[bytes]):
    """For every kind: the place of each feature and how many each text has."""
    words, counts = hashing.hash_words(texts)
    yield (words % np.uint64(WIDTH)).astype(np.int32), counts
    # A word that repeats its left neighbour has one feature of its own, whatever the word is.
    pair = (hashing.runs(words, 2) % np.uint64(WIDTH - 1) + np.uint64(1)).astype(np.int32)
    pair[words[1:] == words[:-1]] = 0
    yield pair[hashing.run_starts(counts, 2)[: len(pair)]] + WIDTH, np.maximum(counts - 1, 0)
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    inside = np.ones(max(len(data) - 2, 0), bool)
    ends = np.cumsum(sizes)
    for back in (1, 2):  # runs must not cross into the next text
        at = ends - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    counts = sizes - np.minimum(sizes, 2)  # texts of under three bytes have none
    for kind, values in ((2, data.astype(np.uint32)), (3, _CLASS[data])):
        three = (values[:-2] << np.uint32(16)) | (values[1:-1] << np.uint32(8)) | values[2:]
        three = (three * np.uint32(2654435761)) >> np.uint32(16)
        yield three[inside].astype(np.int32) + kind * WIDTH, counts


def sums_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive values, counts[i] of them for each i."""
    total = np.zeros(len(counts))
    some = counts > 0
    if some.any():
        total[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some])
    return total


def linear_scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """bias + SCALE * the sum over kinds of the mean weight of a text's features."""
    total = np.full(len(texts), bias)
    for places, counts in _kinds(texts):
        total += SCALE * sums_of(weights[places], counts) / np.maximum(counts, 1)
    return total


def sparse_row(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one text, such that values * weights sum to its score without bias."""
    places, values = [], []
    for found, counts in _kinds([text]):
        place, n = np.unique(found, return_counts=True)
        places.append(place.astype(np.int32))
        values.append((SCALE / max(int(counts[0]), 1) * n).astype(np.float32))
    return np.concatenate(places), np.concatenate(values)


def sample_ids(rows: DataFrame, n: int) -> DataFrame:
    """The n rows with the smallest hash of their id: the same on every run, n rows at most."""
    return rows.orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(n)


def trusted_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label): one row an id; contradicting rows count as 0, rows without id or label do not count."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"))
    )


def training_fold(doc_id) -> F.Column:
    """Rows that labels may be learned from."""
    return fold(doc_id, 5) != 0


def _flat(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values of a binary column as one array read in place from its buffer, and where each row starts and ends."""
    array = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if len(array) == 0:
        return np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = array.buffers()
    width = np.dtype(dtype).itemsize
    kind = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    place = np.dtype(kind).itemsize
    bounds = np.frombuffer(offsets, kind, len(array) + 1, array.offset * place).astype(np.int64) // width
    return np.frombuffer(data, dtype, int(bounds[-1])), bounds[:-1], bounds[1:]


class Sparse:
    """Rows of a bounded training sample in compressed form, with their labels; ordered by id and label.

    The features are read in place from the collected Arrow buffers (one copy of the sample on the driver); the order
    is a permutation of row starts.
    """

    def __init__(self, rows: pa.Table):
        order = pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("label", "ascending")]).to_numpy()
        self.ids = rows.column("doc_id").to_numpy()[order]
        self.labels = rows.column("label").to_numpy().astype(np.int64)[order]
        self.places, starts, ends = _flat(rows.column("places"), np.int32)
        self.values, _, _ = _flat(rows.column("vals"), np.float32)
        self.starts, self.counts = starts[order], (ends - starts)[order]

    def part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, values and counts of some rows."""
        counts = self.counts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return self.places[at], self.values[at], counts


class _Subset:
    """Some rows of a sample."""

    def __init__(self, sample: Sparse, rows: np.ndarray):
        self._sample, self._rows = sample, rows
        self.labels = sample.labels[rows]

    def part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._sample.part(self._rows[rows])


def subset(sample: Sparse, chosen: np.ndarray) -> _Subset:
    return _Subset(sample, np.flatnonzero(chosen))


def collect_sample(docs: DataFrame, chosen: DataFrame) -> Sparse:
    """Features of the documents with a chosen id. `chosen` (doc_id, label) must be bounded and have no row twice.

    Of rows with the same id the smallest text counts.
    """

    def run(batches):
        for batch in batches:
            rows = [sparse_row(t) for t in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([p.tobytes() for p, _ in rows], pa.binary()),
                    pa.array([v.tobytes() for _, v in rows], pa.binary()),
                ],
                ["doc_id", "label", "places", "vals"],
            )

    # The chosen ids are a bounded sample, so sending them to every task is safe.
    rows = keyed_text(docs).join(F.broadcast(chosen), "doc_id")
    # One row for each, however often its id is repeated: this is what reaches the driver.
    found = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).mapInArrow(
        run, "doc_id long, label int, places binary, vals binary"
    )
    return Sparse(found.toArrow())


def descend(sample: Sparse | _Subset, gradient, steps: int, batch: int, rate: float, decay: float, seed: int = 5):
    """Weights and bias after about as many steps of Adam, whatever the size of the sample.

    gradient(scores, labels) gives the derivative of the loss by each score.
    """
    weights, bias = np.zeros(SIZE + 1), 0.0  # the bias is the last weight
    mean, square, step = np.zeros(SIZE + 1), np.zeros(SIZE + 1), 0
    rng = np.random.default_rng(seed)
    classes = [np.flatnonzero(sample.labels == c) for c in np.unique(sample.labels)]
    n = max(1, -(-len(sample.labels) // batch))
    for _ in range(-(-steps // n)):
        # Every batch has its share of each class.
        mixed = [np.array_split(rng.permutation(c), n) for c in classes]
        for rows in (np.concatenate(parts) for parts in zip(*mixed, strict=True)):
            places, values, counts = sample.part(rows)
            scores = bias + sums_of(weights[places] * values, counts)
            slope = gradient(scores, sample.labels[rows])
            grad = np.bincount(places, np.repeat(slope, counts) * values, SIZE + 1)
            grad += decay * weights
            grad[-1] = slope.sum()
            step += 1
            mean = 0.9 * mean + 0.1 * grad
            square = 0.99 * square + 0.01 * grad**2
            weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            bias = weights[-1]
    return weights[:-1].astype(np.float32), float(bias)


def sample_scores(sample: Sparse, rows: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    places, values, counts = sample.part(rows)
    return bias + sums_of(weights[places].astype(np.float64) * values, counts)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
