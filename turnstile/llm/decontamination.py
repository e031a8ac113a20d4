"""Benchmark items inside documents, by MinHash containment and exact shingles. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import ascii_lower, keyed_text, numbered, row_column, stash

BROADCAST_ROWS = 500_000  # sides up to this many rows (two numbers, or a number and a shingle) are broadcast


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "")


def _runs(words: Column, length: int, shingle) -> Column:
    """shingle(words, i) for each run of `length` words from the i-th on; of all words if they are fewer."""
    # As the variable of an outer function the list is made once for a text, not once for each run.
    return F.flatten(F.transform(F.array(words), lambda w: _runs_of(w, length, shingle)))


def _runs_of(words: Column, length: int, shingle) -> Column:
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), n - (length - 1)), lambda i: shingle(words, i, length))
    none = F.slice(F.array(shingle(words, F.lit(1), length)), 1, 0)
    few = F.when(n > 0, F.array(shingle(words, F.lit(1), length))).otherwise(none)
    return F.when(n >= length, many).otherwise(few)


def _text_of(words: Column, i: Column, length: int) -> Column:
    return F.array_join(F.slice(words, i, length), " ")


def _hash_of(words: Column, i: Column, length: int) -> Column:
    """Null words past the end leave a hash as it is."""
    return F.xxhash64(*(F.get(words, i - 1 + k) for k in range(length)))


def sketch_size(shingles: Column, containment: float) -> Column:
    """Smallest hashes to keep of an item, by its size class (powers of two).

    A document that holds the given share of an item lacks so few of its shingles that one of these must be in it.
    """
    largest = F.pow(F.lit(2), F.floor(F.log2(shingles)) + 1) - 1
    return (F.floor(largest * (1 - containment) + 1e-9) + 1).cast("int")


def _small(side: DataFrame) -> DataFrame:
    """Broadcast a side only after counting it; larger ones go through a shuffle join with the same result."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    containment: float = 0.8,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): every document that holds an item.

    Texts are lower-cased (A-Z), and shingles are runs of `shingle` words (of all words where there are fewer; such
    an item is only found in documents of the same few words). containment is the share of the item's distinct
    shingles that the document has; pairs from the given share on are returned.

    Items are partitioned by size. Of an item with at most n shingles in its class the (1 - containment) * n + 1
    smallest hashes (bottom-k MinHash) are kept, so a document with the wanted share has at least one of them: no
    pair is lost, however long the document. Candidates are then verified by their shingles as text.

    Rows and items without an id are not searched; null texts and texts without words have no shingles; rows with the
    same id count as one document, as do items. Empty tables give an empty result. Other columns are ignored.
    """
    texts = keyed_text(docs, id_col, text_col).where("doc_id is not null")
    item_words = (
        keyed_text(items, item_col, text_col).where("doc_id is not null").select(F.col("doc_id").alias("item_id"), word_list(F.col("text")).alias("w"))
    )
    item_shingles = stash(
        item_words.select("item_id", F.explode(_runs(F.col("w"), shingle, _text_of)).alias("shingle")).distinct()
    )
    sizes = item_shingles.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    # The bottom-k per item: hashes of the same words as on the side of the documents.
    hashes = item_words.select("item_id", F.explode(_runs(F.col("w"), shingle, _hash_of)).alias("h")).distinct()
    sketch = (
        hashes.groupBy("item_id").agg(F.sort_array(F.collect_list("h")).alias("hs"))
        .select("item_id", F.explode(F.slice("hs", 1, sketch_size(F.size("hs"), containment))).alias("h"))
    )
    probes = texts.select("doc_id", F.explode(_runs(word_list(F.col("text")), shingle, _hash_of)).alias("h"))
    candidates = stash(probes.join(_small(stash(sketch)), "h").select("doc_id", "item_id").distinct())

    chosen = candidates.select("doc_id").distinct()
    held = (
        texts.join(_small(chosen), "doc_id", "left_semi")
        .select("doc_id", F.explode(F.array_distinct(_runs(word_list(F.col("text")), shingle, _text_of))).alias("shingle"))
    )
    shared = (
        held.join(_small(item_shingles), "shingle").distinct()
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    )
    share = F.col("n_shared") / F.col("n_shingles")
    return (
        shared.join(candidates, ["doc_id", "item_id"]).join(_small(sizes), "item_id")
        .where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * containment - 1e-9))
        .select("doc_id", "item_id", "n_shingles", "n_shared", share.alias("containment"))
    )


def without_leaks(docs: DataFrame, items: DataFrame, keep_null_ids: bool = True, **limits) -> DataFrame:
    """The rows that hold no item, each searched for itself, with all their columns; all rows without an id if wanted."""
    row = row_column(docs)
    rows = numbered(docs, row)
    searched = rows.where("doc_id is not null") if keep_null_ids else rows
    leaking = find_leaks(searched, items, id_col=row, **limits).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(leaking, row, "left_anti").select(*docs.columns)
