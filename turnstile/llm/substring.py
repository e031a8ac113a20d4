"""Removal of repeated passages, found through difference-cover anchors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm import hashing
from turnstile.llm.common import by_size, keyed_text, stash, text_bytes

# {0, 1, 3} is a perfect difference cover modulo 7: every difference modulo 7 is one between two of its members.
PERIOD, COVER = 7, (0, 1, 3)
_SECOND = 0xC2B2AE3D27D4EB4F & ~7 | 5
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


class _Words:
    """Word hashes of a few megabytes of texts, with the row and place of each word."""

    def __init__(self, first: int, words: np.ndarray, counts: np.ndarray):
        self.words, self.counts = words, counts
        self.ends = np.cumsum(counts)
        self.row = np.repeat(np.arange(first, first + len(counts)), counts)
        self.place = np.arange(len(words)) - np.repeat(self.ends - counts, counts)

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Position and hash of the anchors: runs that begin at a cover place of their text."""
        at = np.flatnonzero(hashing.run_starts(self.counts, width) & _IN_COVER[self.place % PERIOD])
        # Anchors only choose what is compared, so 48 bits do.
        return at, hashing.runs(self.words, width)[at] >> np.uint64(16)

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """96-bit hash of every run of `window` words, by first position, in two numbers."""
        second = hashing.runs(hashing.mix(self.words), window, _SECOND)
        return hashing.runs(self.words, window), second >> np.uint64(32)


def _read(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Texts and ids."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in text_bytes(table, "packed")], table.column("doc_id").to_numpy()


def _pack(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = pa.array([pack(t) for t in text_bytes(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("doc_id"), packed], ["block", "doc_id", "packed"]
        )


def _words(texts: list[bytes]):
    for first, _, words, counts in hashing.chunks(texts):
        yield _Words(first, words, counts)


def _untouched(batches):
    """Result rows of texts that keep all their words."""
    for batch in batches:
        texts = text_bytes(batch)
        for a, b in by_size(texts):
            split = [t.split() for t in texts[a:b]]
            kept = [b" ".join(words) for words in split]
            yield _results(
                batch.column("doc_id")[a:b], list(map(len, split)), [0] * (b - a), kept,
                [hashlib.sha256(k).hexdigest() for k in kept],
            ).to_batches()[0]


def _results(ids, n: list[int], removed: list[int], kept: list[bytes], digests: list[str]) -> pa.Table:
    kept = pa.array(kept, pa.binary()).cast(pa.string())
    columns = [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), kept, pa.array(digests, pa.string())]
    return pa.table(columns, names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def _least_and_largest(keys: tuple[np.ndarray, ...], ids: np.ndarray):
    """Distinct keys with their smallest and largest id, ordered by the smallest (this compresses better)."""
    order = np.lexsort((ids, *reversed(keys)))
    keys, ids = tuple(k[order] for k in keys), ids[order]
    new = np.ones(len(ids), bool)
    if len(ids):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1 if len(first) else first
    first, last = (x[np.argsort(ids[first], kind="stable")] for x in (first, last))
    return tuple(k[first] for k in keys), ids[first], ids[last]


def _table(names: list[str], columns: list[np.ndarray]) -> pa.Table:
    return pa.table([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def _concat(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def remove_repeated(
    docs: DataFrame,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_block: int = 1024,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) for every row of docs.

    A word goes if some run of `window` words over it also starts in a document with a smaller id. Runs are
    judged on the input. `kept` is what is left, joined by single spaces.

    Two equal runs have their starts shifted against each other by some amount modulo 7; the cover holds both
    aligned places for every such amount, so an anchor of window - 6 words inside both runs begins at cover
    places of both documents. Only the 3/7 of positions in the cover are hashed and shuffled; anchors known in
    two documents are then extended to whole runs, compared by 96-bit hashes of all their words.

    A later exact copy of a whole text loses all its words (if it has `window` of them) and takes no part in the
    search. Documents are dealt into blocks. What leaves a block has each anchor or run once, with its smallest and
    largest id, so a passage found in a third of all documents gives one row a block.

    Null texts count as empty. A row without an id keeps all its words and takes none from others. Rows with
    the same id count as one document. An empty table gives an empty result; other columns are ignored.
    """
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD}")
    width = window - PERIOD + 1
    texts = keyed_text(docs, id_col, text_col)
    blocks = max(1, math.ceil(texts.count() / docs_per_block))

    def block_of(doc_id: str) -> Column:
        return F.pmod(F.xxhash64(doc_id), F.lit(blocks)).cast("int")

    # Rows without an id are in no block: any number of them may have the same text.
    searched = texts.where("doc_id is not null")
    # The texts are shuffled once, compressed, and read by all three passes.
    dealt = searched.select(block_of("doc_id").alias("block"), "doc_id", "text").mapInArrow(
        _pack, "block int, doc_id long, packed binary"
    )
    digests = searched.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    # As a table of its own, so that the join can split a text that very many documents share.
    first = stash(
        digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").drop("last")
    )
    # By id and text: other rows may have the id of a copy and a text of their own.
    copies = (
        digests.join(first, "digest").where("doc_id > first")
        .select(block_of("doc_id").alias("block"), F.col("doc_id").alias("copy"), "digest")
    )

    def originals(table: pa.Table, others: pa.Table):
        """Texts, ids, which rows take part in the search, and which do not as they are later exact copies."""
        texts, ids = _read(table)
        listed = others.column("copy").drop_null(), others.column("digest").drop_null()
        pairs = set(zip(*(x.to_pylist() for x in listed), strict=True))
        copy = np.isin(ids, listed[0].to_numpy())
        for k in np.flatnonzero(copy):
            copy[k] = (int(ids[k]), hashlib.sha256(texts[k]).digest()) in pairs
        return texts, ids, ~copy, copy

    def find_anchors(table: pa.Table, others: pa.Table) -> pa.Table:
        texts, ids, known, _ = originals(table, others)
        hashes, owners = [], []
        for w in _words(texts):
            at, h = w.anchors(width)
            use = known[w.row[at]]
            hashes.append(h[use])
            owners.append(ids[w.row[at[use]]])
        (h,), lo, hi = _least_and_largest((_concat(hashes, np.uint64),), _concat(owners, np.int64))
        return _table(["h", "lo", "more"], [h, lo, hi - lo])

    def extend(table: pa.Table, others: pa.Table) -> pa.Table:
        wanted = np.sort(others.column("h").drop_null().to_numpy().view(np.uint64))
        first, second, owners = [], [], []
        texts, ids, known, _ = originals(table, others) if len(wanted) else ([], None, None, None)
        for w in _words(texts):
            at, h = w.anchors(width)
            at = at[_found(wanted, h) & known[w.row[at]]]
            starts = np.unique((at[:, None] - np.arange(PERIOD)[None, :]).ravel())
            starts = starts[starts >= 0]
            starts = starts[hashing.run_starts(w.counts, window)[starts]]
            a, b = w.windows(window)
            first.append(a[starts])
            second.append(b[starts])
            owners.append(ids[w.row[starts]])
        keys = (_concat(first, np.uint64), _concat(second, np.uint64))
        (a, b), lo, hi = _least_and_largest(keys, _concat(owners, np.int64))
        return _table(["a", "b", "lo", "more"], [a, b, lo, hi - lo])

    def remove(table: pa.Table, others: pa.Table) -> pa.Table:
        texts, ids, known, copy = originals(table, others)
        a, b, lo = (others.column(c).drop_null().to_numpy() for c in ("a", "b", "lo"))
        order = np.lexsort((b, a))  # signed, as both sides are compared
        a, b, lo = a[order], b[order], lo[order]
        out = []
        for w in _words(texts):
            gone = np.zeros(len(w.words) + 1, np.int64)
            if len(a):
                starts = np.flatnonzero(hashing.run_starts(w.counts, window) & known[w.row])
                x, y = (v.view(np.int64)[starts] for v in w.windows(window))
                hit = _match(a, b, x, y)
                earlier = (hit >= 0) & (lo[hit] < ids[w.row[starts]])
                starts = starts[earlier]
                gone[starts] += 1
                np.subtract.at(gone, starts + window, 1)
            gone = np.cumsum(gone)[:-1] > 0
            for end, n in zip(w.ends, w.counts, strict=True):
                row = len(out)
                words = texts[row].split()
                drop = np.full(n, n >= window) if copy[row] else gone[end - n : end]
                if drop.any():
                    words = [x for x, d in zip(words, drop.tolist(), strict=True) if not d]
                kept = b" ".join(words)
                out.append((int(n), int(drop.sum()), kept, hashlib.sha256(kept).hexdigest()))
        return _results(table.column("doc_id"), *(zip(*out, strict=True) if out else ((), (), (), ())))

    def with_copies(found: DataFrame) -> DataFrame:
        return found.unionByName(copies, allowMissingColumns=True).groupBy("block")

    by_block = dealt.groupBy("block")
    anchors = by_block.cogroup(copies.groupBy("block")).applyInArrow(find_anchors, "h long, lo long, more long")
    # At most one row a block shares a key, however often its passage occurs.
    by_anchor = Window.partitionBy("h")
    shared = (
        anchors.withColumns({"first": F.min("lo").over(by_anchor), "last": F.max(F.expr("lo + more")).over(by_anchor)})
        .where("first < last")
        .select(block_of("lo").alias("block"), "h")
    )
    runs = by_block.cogroup(with_copies(shared)).applyInArrow(extend, "a long, b long, lo long, more long")
    repeated = (
        runs.withColumn("first", F.min("lo").over(Window.partitionBy("a", "b")))
        .where("lo + more > first")
        .select(block_of("lo").alias("block"), "a", "b", F.col("first").alias("lo"))
    )
    schema = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    rest = texts.where("doc_id is null").mapInArrow(_untouched, schema)
    return by_block.cogroup(with_copies(repeated)).applyInArrow(remove, schema).unionByName(rest)


def _found(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _match(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Index of the pair (x, y) in the pairs (a, b), sorted and distinct; -1 where there is none."""
    at = np.searchsorted(a, x)
    hit = np.full(len(x), -1)
    while True:  # pairs that share the first half are next to each other, and very rare
        open_ = (hit < 0) & (at < len(a))
        open_[open_] = a[at[open_]] == x[open_]
        if not open_.any():
            return hit
        same = open_.copy()
        same[open_] = b[at[open_]] == y[open_]
        hit[same] = at[same]
        at = np.where(open_ & ~same, at + 1, len(a))
