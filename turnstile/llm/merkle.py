"""Merkle manifest of a document table by cogrouped subtree exchange.

H is the lowercase hex sha256 of its inputs concatenated; digests enter as their hex text.

- A leaf is H of doc_id, source, lang, n_chars and text, each `-` if null, else its UTF-8 byte count, `:` and
  the value (integers in decimal).
- Per lang, leaves ascend by doc_id (nulls first; equal ids by leaf). While more than one node remains, every
  FANOUT consecutive nodes (the last run may be shorter, even one) become their H. What remains is the
  subroot; a lone leaf is its own subroot.
- Subroots ordered by lang (null first, then UTF-8 bytewise) give the root the same way.
- A proof lists, level by level from the leaf through its subroot to the root, the other members of the
  node's run, left to right.

At scale no group meets one task whole. Leaves get their place by a range-partitioned sort and per-partition
counts. Places are cut into superblocks of FANOUT ** block_levels: complete subtrees, reduced by
applyInPandas to one node each. The superblock roots form a smaller table of the same shape, reduced by the
same exchange, recursively, until every group fits one block. Each superblock's leaves are then cogrouped with
its outer proof (its root's siblings up to the root): one task finishes the local reduction, joins local and
outer proof, and folds a leaf again from its siblings.

Tampering (a test of the proofs): where 3 divides the unsigned crc32 of the decimal doc_id, the text's A-Z
are lower-cased; null texts and null ids stay. folded_root is the root recomputed from the tampered (else the
original) leaf and the original siblings; verified says whether it equals the root. Repeated rows are leaves
of their own and get equal results; other columns of docs are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import ascii_lower, stash

FANOUT = 8
BLOCK_LEVELS = 4  # a superblock: 4,096 nodes of one level
BROADCAST_ROWS = 1_000_000  # small tables (groups, partitions) are broadcast up to this many rows, else joined

UPPER = "grp string, pos long, proof string, lefts array<string>, rights array<string>, top string"
FINAL = (
    "doc_id string, lang string, pos long, leaf string, subroot string, root string, "
    "proof_sha256 string, folded_root string, verified boolean"
)


def H(*parts: str) -> str:  # noqa: N802
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """`-` for null, else byte count, `:` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, ascii_lower(text)).otherwise(text)


def levels_of(nodes: list[str], levels: int | None) -> list[list[str]]:
    """Bottom-up levels of one block: a given number of reductions, or (None) until one node remains."""
    out = [nodes]
    while (len(out[-1]) > 1) if levels is None else (len(out) <= levels):
        cur = out[-1]
        out.append([H(*cur[i : i + FANOUT]) for i in range(0, len(cur), FANOUT)])
    return out


def siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """Left and right members of node i's run on each level below the block's top."""
    lefts, rights = [], []
    for j, level in enumerate(levels[:-1]):
        idx = i // FANOUT**j
        start = idx - idx % FANOUT
        lefts.append("".join(level[start:idx]))
        rights.append("".join(level[idx + 1 : start + FANOUT]))
    return lefts, rights


def fold(node: str, lefts, rights) -> str:
    for left, right in zip(lefts, rights, strict=True):
        node = H(left, node, right)
    return node


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table of groups or partitions only when its size is checked."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """df with `pos`, its place in `grp` by the order columns, from 0.

    A range-partitioned sort (a row sequence number breaks ties, so even equal rows spread over ranges),
    written down; then counts per group and partition give each partition's offset.
    """
    cols = ["grp", *order, "_seq"]
    sorted_rows = df.withColumn("_seq", F.monotonically_increasing_id()).repartitionByRange(*cols).sortWithinPartitions(*cols)
    marked = stash(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = marked.groupBy("grp", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("grp", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"))
    placed = marked.withColumn("_part", part).join(_small(offsets), ["grp", "_part"])
    return placed.withColumn("pos", F.col("_offset") + F.col("_at")).drop("_seq", "_at", "_part", "_offset")


def _placed(nodes: DataFrame, block: int) -> tuple[DataFrame, bool]:
    """Nodes with their group's size n and superblock sb (0 for groups that fit one block)."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    big = sizes.where(F.col("n") > block).limit(1).count() > 0
    sb = F.when(F.col("n") > block, F.floor(F.col("pos") / block)).otherwise(0).cast("long")
    return nodes.join(_small(sizes), "grp").withColumn("sb", sb), big


def _block_levels(pdf: pd.DataFrame, k: int) -> tuple[pd.DataFrame, list[list[str]]]:
    pdf = pdf.sort_values("pos", kind="stable")
    n, block = int(pdf["n"].iloc[0]), FANOUT**k
    return pdf, levels_of(pdf["h"].tolist(), k if n > block else None)


def _roots(k: int):
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, levels = _block_levels(pdf, k)
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "pos": [int(pdf["sb"].iloc[0])], "h": [levels[-1][0]]})

    return reduce


def _outer(outer: pd.DataFrame | None) -> tuple[str, list, list, str | None]:
    if outer is None or outer.empty:
        return "", [], [], None
    row = outer.iloc[0]
    return row["proof"], list(row["lefts"]), list(row["rights"]), row["top"]


def _inner(k: int):
    """Per node of a block: siblings up to the top of its group, joined with the block's outer proof."""

    def finish(pdf: pd.DataFrame, outer: pd.DataFrame | None = None) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=["grp", "pos", "proof", "lefts", "rights", "top"])
        pdf, levels = _block_levels(pdf, k)
        o_proof, o_lefts, o_rights, o_top = _outer(outer)
        base = int(pdf["sb"].iloc[0]) * FANOUT**k
        rows = []
        for pos in pdf["pos"].tolist():
            lefts, rights = siblings(levels, pos - base)
            proof = "".join(left + right for left, right in zip(lefts, rights, strict=True)) + o_proof
            rows.append((proof, lefts + o_lefts, rights + o_rights))
        out = pd.DataFrame(rows, columns=["proof", "lefts", "rights"])
        out.insert(0, "pos", pdf["pos"].to_numpy())
        out.insert(0, "grp", pdf["grp"].iloc[0])
        out["top"] = o_top or levels[-1][0]
        return out

    return finish


def _exchange(nodes: DataFrame, k: int) -> DataFrame:
    """Per node (grp, pos, h): its siblings level by level up to the top of its group, and that top."""
    placed, big = _placed(nodes, FANOUT**k)
    if not big:
        whole = _inner(k)
        return placed.groupBy("grp").applyInPandas(lambda pdf: whole(pdf), UPPER)
    roots = stash(placed.groupBy("grp", "sb").applyInPandas(_roots(k), "grp string, pos long, h string"))
    outer = _exchange(roots, k).withColumnRenamed("pos", "sb")
    return placed.groupBy("grp", "sb").cogroup(outer.groupBy("grp", "sb")).applyInPandas(_inner(k), UPPER)


def _final(k: int):
    def finish(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if leaves.empty:
            return pd.DataFrame(columns=FINAL_COLUMNS)
        leaves, levels = _block_levels(leaves, k)
        o_proof, o_lefts, o_rights, _ = _outer(outer)
        subroot, root = outer["subroot"].iloc[0], outer["root"].iloc[0]
        base = int(leaves["sb"].iloc[0]) * FANOUT**k
        proofs, folded = [], []
        for pos, changed in zip(leaves["pos"].tolist(), leaves["t"].tolist(), strict=True):
            lefts, rights = siblings(levels, pos - base)
            digest = hashlib.sha256()
            for part in (*(left + right for left, right in zip(lefts, rights, strict=True)), o_proof):
                digest.update(part.encode())
            proofs.append(digest.hexdigest())
            folded.append(fold(fold(changed, lefts, rights), o_lefts, o_rights))
        out = pd.DataFrame({
            "doc_id": leaves["doc_id"].to_numpy(), "lang": leaves["lang"].to_numpy(), "pos": leaves["pos"].to_numpy(),
            "leaf": leaves["h"].to_numpy(), "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": folded,
        })
        out["verified"] = out["folded_root"] == root
        return out[FINAL_COLUMNS]

    return finish


FINAL_COLUMNS = [c.split()[0] for c in FINAL.split(", ")]


def manifest(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(doc_id, lang, pos, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of docs.

    docs needs doc_id, source, lang, n_chars and text. pos is the leaf's place within its lang.
    """
    k = block_levels
    # the group key keeps the order of langs: null first, then bytewise
    key = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang").cast("string")))
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaves = docs.select(
        key.alias("grp"), F.col("doc_id").cast("long").alias("order_id"),
        F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf_of(*cols).alias("h"), leaf_of(*cols[:4], tampered(cols[0], cols[4])).alias("t"),
    )
    placed, _ = _placed(ranked(leaves, ["order_id", "h"]).drop("order_id"), FANOUT**k)
    placed = stash(placed)
    # one node per superblock; its siblings up to the subroot of its lang
    roots = stash(placed.groupBy("grp", "sb").applyInPandas(_roots(k), "grp string, pos long, h string"))
    upper = stash(_exchange(roots, k))
    # subroots by lang give the root
    subroots = upper.select(F.lit("").alias("grp"), F.col("grp").alias("lang_key"), F.col("top").alias("h")).distinct()
    top = ranked(subroots, ["lang_key"])
    langs = _exchange(top.select("grp", "pos", "h"), k).join(top.select("pos", "lang_key"), "pos")
    langs = langs.select(
        F.col("lang_key").alias("grp"), F.col("proof").alias("l_proof"), F.col("lefts").alias("l_lefts"),
        F.col("rights").alias("l_rights"), F.col("top").alias("root"),
    )
    outer = upper.join(_small(langs), "grp").select(
        "grp", F.col("pos").alias("sb"), F.concat("proof", "l_proof").alias("proof"),
        F.concat("lefts", "l_lefts").alias("lefts"), F.concat("rights", "l_rights").alias("rights"),
        F.col("top").alias("subroot"), "root", F.lit(None).cast("string").alias("top"),
    )
    # ids travel as text through pandas, which would turn a nullable long into a float
    done = placed.groupBy("grp", "sb").cogroup(outer.groupBy("grp", "sb")).applyInPandas(_final(k), FINAL)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))
