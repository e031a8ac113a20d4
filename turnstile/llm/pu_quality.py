"""Quality classifier learned from positives and unlabelled text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import features
from turnstile.llm.common import by_size, fold, keyed_text, text_bytes

MAX_POSITIVE = 3000  # bounds of the training sample
MAX_UNLABELLED = 4000


def nn_pu_gradient(prior: float):
    """Slope of the non-negative unbiased risk with logistic loss.

    Risk: prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)). Where the second part is negative, the step raises it
    instead, as in non-negative PU learning.
    """

    def gradient(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
        p, u = labels == 1, labels == 0
        n_p, n_u = max(p.sum(), 1), max(u.sum(), 1)
        prob = features.sigmoid(scores)
        loss_negative = np.logaddexp(0, scores)
        rest = loss_negative[u].sum() / n_u - prior * loss_negative[p].sum() / n_p
        as_positive = np.where(p, -prior * (1 - prob) / n_p, 0.0)
        as_negative = np.where(u, prob / n_u, -prior * prob / n_p)
        return as_positive + as_negative if rest >= 0 else -as_negative

    return gradient


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of rows that the scorer has not seen.

    Above any threshold the unlabelled hold at least prior times the share that the positives hold there. The
    smallest such ratio, with a confidence margin, estimates the prior (best-bin estimation).
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.unique(positive)
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = int(np.argmin((u + margin) / p))
    return float(np.clip(u[best] / p[best], 0.05, 0.99))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED):
    """(weights, bias, prior) from labelled positives and a sample of all documents of the training folds.

    At most `max_positive` and `max_unlabelled` rows are used, those with the smallest hash of their id.
    Labels other than 1 are not used: the sample is of all text, labelled or not.
    """
    known = features.trusted_labels(labels, "quality")
    positive = known.where((F.col("label") == 1) & features.training_fold(F.col("doc_id")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull())
    unlabelled = ids.where(features.training_fold(F.col("doc_id"))).distinct()
    chosen = features.sample_ids(positive, max_positive).unionByName(
        features.sample_ids(unlabelled, max_unlabelled).withColumn("label", F.lit(0))
    )
    sample = features.collect_sample(docs, chosen)
    has = [int((sample.labels == c).sum()) for c in (0, 1)]
    if not all(has):
        # Without positives nothing is known.
        return np.zeros(features.SIZE, np.float32), 0.0, 0.5
    share = has[1] / sum(has)
    # Split by id: a positive may be in the sample of all text, too.
    half = np.unique(sample.ids, return_inverse=True)[1] % 2 == 0

    def plain(scores, labels):
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)
        return weight * (features.sigmoid(scores) - labels)

    # Positives against unlabelled on one half, the prior from its scores on the other half.
    scorer = features.subset(sample, half)
    weights, bias = features.descend(scorer, plain, steps=90, batch=512, rate=0.02, decay=1e-6)
    other = np.flatnonzero(~half)
    scores, kind = features.sample_scores(sample, other, weights, bias), sample.labels[other]
    prior = estimate_prior(scores[kind == 1], scores[kind == 0])
    weights, bias = features.descend(
        sample, nn_pu_gradient(prior), steps=420, batch=512, rate=0.05, decay=1e-4
    )
    return weights, bias, prior


def _scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    scores = [features.linear_scores(texts[a:b], weights, bias) for a, b in by_size(texts)]
    return features.sigmoid(np.concatenate([np.zeros(0), *scores]))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    The score sees the text alone. Null and empty texts get the score of a text without features. held_out is
    true where crc32 of the id as text is divisible by 5 (and false for null ids); such rows are never learned
    from, neither as positives nor as unlabelled text. Repeated rows give repeated result rows and count once
    in training. Without positives all scores are 0.5. Empty tables give empty results.
    """
    weights, bias, _ = train(docs, labels, **bounds)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))  # fixed size

    def run(batches):
        for batch in batches:
            scores = pa.array(_scores(text_bytes(batch), *model.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    scored = keyed_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, keep_null_ids: bool = True, **bounds: int
) -> DataFrame:
    """The rows whose text the classifier accepts, with all their columns; all rows without an id if wanted."""
    weights, bias, _ = train(docs, labels, **bounds)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))  # fixed size

    def run(batches):
        for batch in batches:
            good = _scores([t or b"" for t in text_bytes(batch)], *model.value) >= threshold
            if keep_null_ids:
                good |= batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
