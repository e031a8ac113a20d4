"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import keyed_text, numbered, row_column, stash, text_bytes
from turnstile.llm.components import components

BITS = 64
SMALL_BUCKET = 64  # buckets up to this size are compared inside one row


# --- fingerprints ------------------------------------------------------------


def shingle_hashes(text: bytes, length: int) -> list[int]:
    """XXH64 (seed 42) of each shingle of the lower-cased text; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate(map(len, words), lambda end, size: end + size + 1))
    starts = [0, *(e + 1 for e in ends)]
    if len(words) <= length:
        return [digest(joined, 42)]
    return [digest(joined[s:e], 42) for s, e in zip(starts, ends[length - 1 :], strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """Bit set where over half the hashes have it; 0 without hashes."""
    if not hashes:
        return 0
    array = np.array(hashes, dtype=">u8")
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(array), 1 << 16):
        part = array[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of every row as a signed long."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, shingle)) for t in text_bytes(batch)]
            fps = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# --- partitions and thresholds -----------------------------------------------


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set (64 x 64), over all rows."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column("fp").to_numpy(zero_copy_only=False)).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        counts = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["cell", "n"])

    rows = prints.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for row in rows:  # 64 * 64 + 1 numbers at most
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    """Row by row the 64 bits, lowest first."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def partition_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of even size, each grown by the bit most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(deviation, deviation))
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = (BITS * (k + 1)) // parts - (BITS * k) // parts
        seed = max(left, key=lambda i: (correlation[i, left].sum(), -i))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            best = max(left, key=lambda i: (correlation[i, group].sum(), -i))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def estimated_pairs(n: int, both: np.ndarray, bits: list[int], radius: int) -> float:
    """Expected pairs that differ in at most `radius` of the bits, from how often each bit is set.

    Correlated bits carry less: the exponent shrinks the information of a group to the effective number of
    independent bits (participation ratio of its correlation matrix).
    """
    p = np.diag(both)[bits] / max(n, 1)
    differ = 2 * p * (1 - p)
    distance = np.zeros(len(bits) + 1)
    distance[0] = 1.0
    for d in differ:
        distance[1:] = distance[1:] * (1 - d) + distance[:-1] * d
        distance[0] *= 1 - d
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    matrix = (both[np.ix_(bits, bits)] / max(n, 1) - np.outer(p, p)) / np.outer(deviation, deviation)
    np.fill_diagonal(matrix, 1.0)
    effective = len(bits) ** 2 / float((matrix**2).sum())
    share = max(float(distance[: radius + 1].sum()), 1e-300) ** (effective / len(bits))
    return n * (n - 1) / 2 * share


def probes(width: int, radius: int) -> int:
    """Bucket keys of a fingerprint in a partition that tolerates `radius` differing bits."""
    return 0 if radius < 0 else len(_flips(width, (radius + 1) // 2))


def allocate(n: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """Partitions with thresholds of least estimated cost.

    General pigeonhole principle: if thresholds add up to max_bits - m + 1, any two fingerprints within max_bits
    are within its threshold in one of the m partitions. A threshold of -1 leaves a partition out. For each m,
    dynamic programming over the partitions splits the sum; the cost counts bucket keys and estimated candidates.
    """
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(1, max_bits + 3):
        groups, target = partition_bits(n, both, m), max_bits - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            cost = {-1: 0.0} | {
                e: n * probes(len(group), e) + estimated_pairs(n, both, group, e) for e in range(max_bits + 1)
            }
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (spent, chosen) in table.items():
                for e, c in cost.items():
                    if total + e not in step or spent + c < step[total + e][0]:
                        step[total + e] = (spent + c, [*chosen, e])
            table = step
        if table[target][0] < best[0]:
            best = (table[target][0], list(zip(groups, table[target][1], strict=True)))
    return [(group, e) for group, e in best[1] if e >= 0]


def _flips(width: int, radius: int) -> np.ndarray:
    """Masks over `width` bits with at most `radius` bits set."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(width), r)]
    return np.array(masks, np.uint64)


# --- links -------------------------------------------------------------------


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that join exactly the distinct fingerprints within max_bits of each other, directly or in turn.

    `prints` has distinct fingerprints in `fp`. Small buckets are compared pair by pair inside a row and give a
    spanning forest. Fingerprints of larger buckets are linked through the patterns around them: two are within
    max_bits if and only if their balls of half that radius meet, so no bucket is ever expanded into pairs.
    """
    n, both = bit_statistics(prints)
    plan = allocate(n, both, max_bits)

    def keys(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = _bits(fps).astype(np.uint64)
            for part, (group, radius) in enumerate(plan):
                value = (bits[:, group] << np.arange(len(group), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                for mask in _flips(len(group), (radius + 1) // 2):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fps), part, np.int32)), pa.array((value ^ mask).view(np.int64)), pa.array(fps)],
                        ["part", "key", "fp"],
                    )

    def forest(batches):
        for batch in batches:
            edges = [e for fps in batch.column("fps").to_pylist() for e in _spanning_forest(fps, max_bits)]
            yield _edge_batch(edges)

    probed = prints.select("fp").mapInArrow(keys, "part int, key long, fp long")
    sizes = probed.groupBy("part", "key").agg(F.count("*").alias("size")).where("size > 1")
    sized = probed.join(sizes, ["part", "key"])
    small = (
        sized.where(F.col("size") <= SMALL_BUCKET)
        .groupBy("part", "key")
        .agg(F.collect_list("fp").alias("fps"))  # SMALL_BUCKET at most
        .select("fps")
        .mapInArrow(forest, "a long, b long")
    )
    large = sized.where(F.col("size") > SMALL_BUCKET).select("fp").distinct()
    return small.union(_ball_links(large, max_bits)).distinct()


def _spanning_forest(fps: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Edges from each fingerprint to the smallest one that it reaches among these."""
    array = np.array(sorted(set(fps)), np.int64)
    bits = array.view(np.uint64)  # of signed numbers numpy counts the bits of the absolute value
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= max_bits
    label = np.arange(len(array))
    while True:
        lower = np.where(near, label[None, :], len(array)).min(axis=1)
        if (lower == label).all():
            return [(int(a), int(array[k])) for a, k, i in zip(array, label, range(len(array)), strict=True) if k != i]
        label = lower


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _ball_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Star links between fingerprints with a common pattern within half of max_bits of both."""
    low, high = max_bits // 2, (max_bits + 1) // 2
    masks = _flips(BITS, high)
    near = np.bitwise_count(masks) <= low

    def balls(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 1024):
                part = fps[at : at + 1024]
                around = (part.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(around.ravel()), pa.array(np.repeat(part, len(masks))), pa.array(np.tile(near, len(part)))],
                    ["pattern", "fp", "near"],
                )

    members = prints.mapInArrow(balls, "pattern long, fp long, near boolean")
    # A pattern has as many members as its ball has patterns, at most.
    stars = members.groupBy("pattern").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_set("fp").alias("fps")
    )
    return stars.where(F.size("fps") > 1).select(F.explode("fps").alias("a"), "b").where("a <> b")


# --- operator ----------------------------------------------------------------


def simhash_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    component_id is the smallest id among the documents reachable by links of at most `max_bits` differing bits.
    Null texts count as empty; texts without words have fingerprint 0 and link like any other. A null id never
    becomes a component id unless its whole component has none. Repeated rows give repeated result rows.
    An empty table gives an empty result. Columns other than id and text are ignored.
    """
    prints = stash(fingerprints(docs, shingle, id_col, text_col))
    distinct = stash(prints.select("fp").distinct())
    roots = components(links(distinct, max_bits))
    # A third of all rows may share a fingerprint: reduce to one row each before any join by it.
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    rooted = first.join(roots, first.fp == roots.node, "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, keep_null_ids: bool = True) -> DataFrame:
    """Of each group one row with the smallest id (null last), with all its columns; all rows without an id if wanted."""
    row = row_column(docs)
    rows = numbered(docs, row)
    groups = simhash_groups(rows, shingle, max_bits, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("row"))
    first = (
        rows.select("doc_id", row).join(groups, row).groupBy("component_id").agg(F.min(order).alias("first"))
        .select(F.col("first.row").alias(row))
    )
    if not keep_null_ids:
        return rows.join(first, row, "left_semi").select(*docs.columns)
    kept = rows.where("doc_id is not null").join(first, row, "left_semi")
    return kept.unionByName(rows.where("doc_id is null")).select(*docs.columns)
