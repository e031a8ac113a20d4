"""Language-model scores: subword lattice likelihood, and a smoothed unigram model of words."""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import lattice
from turnstile.llm.common import by_size, fold, keyed_text, stash, text_bytes

FREQUENT = 100_000  # bound of the words that every task gets; the others go through a join
_WORDS_AT_ONCE = 100_000
_SMOOTHING = 0.1


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Ordinary pieces of a sentencepiece model, and starting log-probabilities of these, the bytes and the end.

    The scores of the file are negative ranks, not probabilities; a piece of rank r starts with weight 1 / (r + 10).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            pieces.append(model.id_to_piece(i))
            ranks.append(-model.get_score(i))
    ranks = np.minimum(np.array(ranks), 10.0 * len(ranks))
    weights = np.concatenate([1 / (ranks + 10), np.full(256, 0.1 / len(pieces)), [0.01]])
    return pieces, np.log(weights / weights.sum())


@functools.lru_cache(maxsize=2)
def _pieces(path: str, logp: bytes) -> lattice.Pieces:
    return lattice.Pieces(vocabulary(path)[0], np.frombuffer(logp))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c): every word of all texts and how often it occurs in texts to learn from (0 if only in others)."""

    def run(batches):
        for batch in batches:
            values, learn = text_bytes(batch), batch.column("learn").to_pylist()
            for a, b in by_size(values, 1 << 24):
                counts: Counter[bytes] = Counter()
                for text, use in zip(values[a:b], learn[a:b], strict=True):
                    words = text.lower().split()
                    counts.update(words if use else dict.fromkeys(words, 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())],
                    ["word", "c"],
                )

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _batches(batches, size: int = _WORDS_AT_ONCE):
    """Arrow batches joined up to about `size` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def learn_pieces(words: DataFrame, ends: int, path: str, rounds: int) -> np.ndarray:
    """Log-probabilities of the pieces after `rounds` of expectation-maximisation over all counted words."""
    logp = vocabulary(path)[1]
    for _ in range(rounds):
        current = logp.tobytes()

        def run(batches, current=current):
            total = np.zeros(len(current) // 8)
            for table in _batches(batches):
                total += lattice.expected_counts(
                    _pieces(path, current), text_bytes(table, "word"), table.column("c").to_numpy()
                )
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["piece", "n"])

        expected = words.where("c > 0").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(logp))
        for row in expected.collect():  # one row a piece
            counts[row["piece"]] = row["n"]
        counts[-1] = ends
        # What the file says counts as much as one text in a thousand, and at least a little.
        weight = max(1.0, counts.sum() / 1000)
        logp = np.log((counts + weight * np.exp(vocabulary(path)[1])) / (counts.sum() + weight))
    return logp


def score_texts(
    docs: DataFrame,
    vocabulary_path: str,
    folds: int = 10,
    rounds: int = 2,
    frequent: int = FREQUENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    Tokens are the lower-cased (A-Z) words of a text and one end. Rows whose crc32 of the id as text is divisible by
    `folds` are held out; the others are learned from. base_score is the log10 probability under a word unigram model
    with 0.1 added to every count. score is the log10 probability under a unigram model of subword pieces: each word
    is the sum over all its segmentations into pieces of an existing vocabulary (log-space forward recursion), and
    words and end are independent, as pieces do not cross words. The scores of the vocabulary start two rounds of
    expectation-maximisation over all words learned from, and stay in it as a prior. Characters without a piece are
    spelled in byte pieces, so every text has a probability.

    Counts cover all words of the table. The `frequent` most frequent words are given to every task; all other words,
    none of which is a hot key then, get their values by a join. Null texts count as empty: one token, the end.
    Rows without an id are held out. Repeated rows each count, and give a row each. An empty table gives an empty
    result; with nothing to learn from all counts are 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = keyed_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) != 0, F.lit(False)).alias("learn"),
        "text",
    )
    counted = stash(count_words(texts))
    ends = texts.where("learn").count()
    total = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = total["n"] + ends, total["v"] + (ends > 0)
    floor = n + _SMOOTHING * (v + 1)
    logp = learn_pieces(counted, ends, vocabulary_path, rounds)
    model, end_score = logp.tobytes(), float(logp[-1]) / math.log(10)
    end_base = math.log10((ends + _SMOOTHING) / floor) if floor else 0.0

    def value(batches):
        for table in _batches(batches):
            scores = lattice.log_likelihood(_pieces(vocabulary_path, model), text_bytes(table, "word")) / math.log(10)
            arrays = [table.column("word").combine_chunks(), table.column("c").combine_chunks(), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(
                [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays], ["word", "c", "score"]
            )

    valued = stash(counted.mapInArrow(value, "word string, c long, score double"))
    top = valued.orderBy(F.desc("c"), "word").limit(frequent)  # a bounded number of rows
    known = spark.sparkContext.broadcast(
        {r["word"].encode(): (r["c"], math.log10((r["c"] + _SMOOTHING) / floor), r["score"]) for r in top.toLocalIterator()}
    )

    def add_up(batches):
        names = ["row", "doc_id", "learn", "word", "n", "n_words", "known", "base", "score"]
        for batch in batches:
            values, table = text_bytes(batch), known.value
            fixed = [batch.column(c).to_pylist() for c in ("row", "doc_id", "learn")]
            for a, b in by_size(values, 1 << 22):
                out: list[tuple] = []
                for text, row, doc_id, learn in zip(values[a:b], *(f[a:b] for f in fixed), strict=True):
                    words = text.lower().split()
                    seen, base, score = 0, 0.0, 0.0
                    for word, times in Counter(words).items():
                        entry = table.get(word)
                        if entry is None:
                            out.append((row, None, None, word, times, None, None, None, None))
                        else:
                            seen += times * (entry[0] > 0)
                            base += times * entry[1]
                            score += times * entry[2]
                    # A key with a space is no word: it spreads these rows and finds nothing.
                    out.append((row, doc_id, learn, b" %d" % row, 0, len(words), seen, base, score))
                columns = [list(c) for c in zip(*out, strict=True)]
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), *[pa.int64()] * 3, *[pa.float64()] * 2]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                arrays[3] = arrays[3].cast(pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names)

    parts = texts.mapInArrow(
        add_up,
        "row long, doc_id long, learn boolean, word string, n long, n_words long, known long, base double, score double",
    )
    rare = valued.select("word", "c", F.col("score").alias("word_score"))
    of_word = F.log10((F.col("c") + _SMOOTHING) / F.lit(floor))
    zero = F.lit(0.0)
    return (
        parts.join(rare, "word", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("learn").alias("learn"),
            F.max("n_words").alias("n_words"),
            F.sum(F.coalesce("known", F.when(F.col("c") > 0, F.col("n")), F.lit(0))).alias("known"),
            F.sum(F.coalesce("base", F.col("n") * of_word, zero)).alias("base"),
            F.sum(F.coalesce("score", F.col("n") * F.col("word_score"), zero)).alias("score"),
        )
        .select(
            "doc_id",
            (~F.col("learn")).alias("held_out"),
            (F.col("n_words") + 1).alias("n_tokens"),
            (F.col("known") + int(ends > 0)).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("base") + end_base).alias("base_score"),
            (F.col("score") + end_score).alias("score"),
        )
    )
