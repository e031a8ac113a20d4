"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir

# The separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
# bytes.split() without arguments splits at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stash(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_column(docs: DataFrame) -> str:
    """A column name for row numbers that docs does not use: `_row`, with more leading underscores if taken."""
    name = "_row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """docs with a number of each row in `name` (see row_column), written down: every later read finds the same numbers."""
    return stash(docs.withColumn(name, F.monotonically_increasing_id()))


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text, a null text as the empty one. Other columns play no part."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def text_bytes(batch: pa.RecordBatch | pa.Table, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column."""
    values = batch.column(column)
    return values.cast(pa.large_binary() if values.type == pa.large_string() else pa.binary()).to_pylist()


def by_size(texts: list[bytes], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
