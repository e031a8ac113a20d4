"""Packing of token sequences by best-two-fit."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import keyed_text, stash
from turnstile.llm.tokens import encode

BROADCAST_ROWS = 500_000  # a table of offsets up to this size is broadcast
_PIECE = "doc_id long, piece int, start long, length long, ids binary"


# --- the plan: which lengths share a sequence ----------------------------------


def _largest(left: list[int], used: Counter, limit: int) -> int:
    """Largest length up to a limit of which one is left; 0 for none."""
    return next((n for n in range(limit, 0, -1) if left[n] > used[n]), 0)


def _best_pair(left: list[int], used: Counter, gap: int, more_than: int) -> tuple[int, int] | None:
    """Two lengths left whose sum comes nearest to the gap from below and is over `more_than`."""
    best, pair, low = more_than, None, 1
    for high in range(gap - 1, 0, -1):
        if left[high] <= used[high]:
            continue
        while low + high <= gap and low <= high:
            if left[low] > used[low] + (low == high) and low + high > best:
                best, pair = low + high, (high, low)
            low += 1
        # A smaller high leaves room for larger partners only; those already passed are no better with it.
        if best == gap or low > high:
            break
    return pair


def best_two_fit(counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Contents of the sequences as (lengths, how many such sequences); counts[n] pieces have length n.

    A sequence is filled greedily with the largest piece that fits. If room is left, its smallest piece is replaced
    by the two unpacked pieces that fill the enlarged gap best. Equal choices repeat as long as no length runs out, so
    the work depends on the number of lengths and not on the number of pieces.
    """
    left, plan = list(counts), []
    while longest := _largest(left, Counter(), capacity):
        greedy, gap, used = [], capacity, Counter()
        size = longest
        while size:
            greedy.append(size)
            used[size] += 1
            gap -= size
            size = _largest(left, used, gap)
        lengths = greedy
        if gap and len(greedy) > 1:
            smallest = greedy[-1]
            pair = _best_pair(left, used, gap + smallest, smallest)
            lengths = greedy if pair is None else [*greedy[:-1], *pair]
        final = Counter(lengths)
        need = Counter(greedy) | final
        times = 1 + min((left[n] - need[n]) // final[n] for n in final)
        for n, k in final.items():
            left[n] -= k * times
        plan.append((sorted(lengths, reverse=True), times))
    return plan


def _slots(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: from rank `first` of a length on, `each` pieces go into every sequence from `sequence` on."""
    rows, taken, sequence = [], Counter(), 0
    for lengths, times in plan:
        offset = 0
        for n, k in Counter(lengths).items():
            rows.append((n, taken[n], k, sequence, offset))
            taken[n] += k * times
            offset += n * k
        sequence += times
    rows.sort()
    names = ("length", "first", "each", "sequence", "offset")
    return {name: np.array(c, np.int64) for name, c in zip(names, zip(*rows, strict=True) if rows else [()] * 5, strict=True)}


# --- operator ----------------------------------------------------------------


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole if it fits, else full pieces after a first one with the remainder."""
    rest = len(ids) % capacity
    starts = [*([0] if rest else []), *range(rest, len(ids), capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece of every row with its place.

    ids are little-endian unsigned 32-bit integers. Documents longer than `capacity` tokens are cut into full pieces,
    of which the first may be shorter. Pieces of one length can stand for each other, so the plan is made from the
    number of pieces of each length alone (`capacity` numbers on the driver). Pieces then take the places of their
    length by rank: each task numbers its pieces, and offsets by task and length, summed over all tasks, make that a
    global rank. No group of pieces is ever gathered.

    A null text counts as empty: its only piece is the end. Null ids and repeated rows are packed like others. An
    empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession

    def pieces_of(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts, tokenizer_path, end_id), strict=True):
                for piece, (start, length) in enumerate(cut(ids, capacity)):
                    content = ids[start : start + length].astype("<u4").tobytes()
                    rows.append((doc_id, piece, start, length, content, task, seen[length]))
                    seen[length] += 1
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    pieces = stash(keyed_text(docs, id_col, text_col).mapInArrow(pieces_of, _PIECE + ", task int, nr long"))
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stash(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    histogram = [0] * (capacity + 1)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # `capacity` rows at most
        histogram[row["length"]] = row["n"]
    slots = spark.sparkContext.broadcast(_slots(best_two_fit(histogram, capacity)))

    def place(batches):
        table = slots.value
        # Lengths are under 2**20 and ranks under 2**43: one number orders both.
        keys = (table["length"] << 43) + table["first"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 43) + rank, side="right") - 1
            k = rank - table["first"][at]
            each = table["each"][at]
            sequence, offset = table["sequence"][at] + k // each, table["offset"][at] + k % each * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    # Larger tables of offsets go through a shuffle join with the same result.
    side = F.broadcast(offsets) if offsets.count() <= BROADCAST_ROWS else offsets
    ranked = pieces.join(side, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("nr")).alias("rank")
    )
    return ranked.mapInArrow(place, _PIECE + ", sequence_id long, offset long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids", "task", "nr"])
