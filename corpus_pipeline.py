"""From raw documents to packed training sequences. Counted as part of the subpackage turnstile.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import decontamination, packing, pii, pu_quality, simhash
from turnstile.llm.common import read, stash, tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects go, also those without an id."""
    return pu_quality.keep_good(docs, read(spark, sf_dir, "labels"), threshold=0.3, keep_null_ids=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays, whatever the ids."""
    return simhash.keep_one(docs, shingle=3, max_bits=2, keep_null_ids=False)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, also those without an id."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark"), keep_null_ids=False)


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their places in sequences of 1024 tokens."""
    pieces = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("pu_quality", good_quality),
    ("simhash_dedup", near_duplicates),
    ("decontamination", no_benchmark),
    ("personal_data", no_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None  # the classifier and the tokenizer cannot be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
