"""Text statistics with fixed limits, and a calibrated logistic regression over hashed n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import features, hashing
from turnstile.llm.common import by_size, keyed_text, text_bytes

MAX_LABELLED = 3000  # rows of each class in the training sample
WINDOW = 5
_SPACES = b" \t\n\v\f\r"
_NOT_CHARACTERS = _SPACES + bytes(range(0x80, 0xC0))  # later bytes of a character start none
_SYMBOLS = b"#*$%&|<>"


def _repeated_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and how many lie in a run of WINDOW words that its text has twice or more."""
    words, counts = hashing.hash_words(texts)
    row = np.repeat(np.arange(len(texts)), counts)
    starts = np.flatnonzero(hashing.run_starts(counts, WINDOW))
    keys = hashing.runs(words, WINDOW)[starts] ^ hashing.mix(row[starts].astype(np.uint64) + np.uint64(1))
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    starts = starts[times[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + WINDOW, 1)
    return counts, features.sums_of((np.cumsum(cover)[:-1] > 0).astype(np.int64), counts).astype(np.int64)


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    words, repeated = _repeated_words(texts)
    return {
        "n_words": words,
        "word_chars": np.array([len(t.translate(None, _NOT_CHARACTERS)) for t in texts], np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated,
    }


MIN_ASIDE = 5  # rows of each class from which a fifth of the sample is set aside for calibration


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """(weights, bias, slope, offset): a logistic regression and its calibration (Platt scaling).

    Learns from labels.quality of the training folds, at most `max_labelled` rows of each class, those with the
    smallest hash of their id, weighted to the shares that the classes have in all labelled rows. A fifth of the
    sample is set aside for the calibration; with fewer than MIN_ASIDE rows of a class the calibration is
    cross-fitted instead (each half scored by a model of the other half, then one model of all rows). Without
    rows of one of the classes nothing tells them apart: every text has probability 1.
    """
    known = features.trusted_labels(labels, "quality")
    known = known.where(features.training_fold(F.col("doc_id")) & F.col("label").isin(0, 1))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = features.sample_ids(known.where("label = 0"), max_labelled).unionByName(
        features.sample_ids(known.where("label = 1"), max_labelled)
    )
    sample = features.collect_sample(docs, chosen)
    found = [int((sample.labels == c).sum()) for c in (0, 1)]
    if min(found) == 0:
        return np.zeros(features.SIZE, np.float32), 0.0, 0.0, 40.0
    weight = np.array([shares[c] / found[c] for c in (0, 1)])
    weight /= (weight * found).sum() / sum(found)

    def gradient(scores, labels):
        return weight[labels] * (features.sigmoid(scores) - labels) / len(labels)

    def fit(rows):
        return features.descend(rows, gradient, steps=220, batch=512, rate=0.02, decay=1e-6)

    n = len(sample.labels)
    if min(found) >= MIN_ASIDE:
        aside = np.arange(n) % 5 == 0
        weights, bias = fit(features.subset(sample, ~aside))
        rows = np.flatnonzero(aside)
        scores = features.sample_scores(sample, rows, weights, bias)
    else:
        rows, scores = np.arange(n), np.zeros(n)
        for part in (np.arange(n) % 2 == 0, np.arange(n) % 2 == 1):
            other = fit(features.subset(sample, ~part))
            scores[part] = features.sample_scores(sample, np.flatnonzero(part), *other)
        weights, bias = fit(sample)
    slope, offset = _platt(scores, sample.labels[rows], weight[sample.labels[rows]])
    return weights, bias, slope, offset


def _platt(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibrated log-odds, by Newton steps on smoothed targets."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.stack([scores, np.ones(len(scores))], axis=1)
    x = np.array([1.0, 0.0])
    for _ in range(30):
        p = features.sigmoid(design @ x)
        slope = design.T @ (weight * (p - target)) + 1e-3 * (x - [1.0, 0.0])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        x -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(x[0], 0.0)), float(x[1])


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    min_probability: float = 0.5,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept).

    One row for every row of docs. A text fails the base rules with fewer than `min_words` words, or where over
    `max_repeat_percent` percent of its words lie in repeated runs of five words. What passes is kept if its
    calibrated probability of good quality reaches `min_probability`. Null texts count as empty and fail.
    Rows without an id are judged like others. Repeated rows give repeated result rows. Empty tables give empty
    results; without labels of both classes only the base rules decide.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_labelled))  # fixed size

    def run(batches):
        weights, bias, slope, offset = model.value
        for batch in batches:
            texts, parts = text_bytes(batch), []
            for a, b in by_size(texts):
                columns = statistics(texts[a:b])
                scores = features.linear_scores(texts[a:b], weights, bias)
                parts.append(columns | {"probability": features.sigmoid(slope * scores + offset)})
            names = parts[0] if parts else ()
            columns = {k: np.concatenate([p[k] for p in parts]) for k in names}
            if parts:
                failed = (columns["n_words"] < min_words) | (
                    100 * columns["n_repeat_words"] > max_repeat_percent * columns["n_words"]
                )
                columns |= {"base_failed": failed, "kept": ~failed & (columns["probability"] >= min_probability)}
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *map(pa.array, columns.values())], ["doc_id", *columns]
                )

    return keyed_text(docs).mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "probability double, base_failed boolean, kept boolean",
    )
