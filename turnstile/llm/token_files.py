"""Files of token ids: documents compressed one by one with a shared zstandard dictionary.

A shard is
    magic, format version, bytes of an id (2 or 4), SHA-256 of the dictionary;
    one zstandard frame for each document;
    the index: ids of the documents, which of them are not null, starts of the frames and end of the last, numbers of tokens;
    the number of documents, magic.
All numbers are little-endian. The dictionary is a file beside the shards.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import keyed_text, shared_folder, stash
from turnstile.llm.tokens import encode, vocabulary_size

MAGIC = b"TOKSHARD"
_HEAD, _TAIL = struct.Struct("<8sHH32s"), struct.Struct("<Q8s")
DICTIONARY_BYTES = 64 * 1024
TRAINING_DOCUMENTS = 2000  # bound of the sample that the dictionary is trained on
DOCUMENTS_PER_SHARD = 4096


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


# --- dictionary ---------------------------------------------------------------


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary from serialised ids; where they are too few to train on, these themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    # Empty: nothing to share. Otherwise trained dictionaries are recognised by their own magic number.
    return zstandard.ZstdCompressionDict(content) if content else None


# --- one shard ---------------------------------------------------------------


class ShardWriter:
    """Writes documents one after the other to a shard."""

    def __init__(self, out, width: str, dictionary: bytes, level: int = 3):
        self.out, self.width, self.at = out, width, _HEAD.size
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary))
        self.ids, self.known, self.starts, self.counts = [], [], [], []
        out.write(_HEAD.pack(MAGIC, 1, int(width[-1]), hashlib.sha256(dictionary).digest()))

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        frame = self.compressor.compress(tokens.astype(self.width).tobytes())
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.starts.append(self.at)
        self.counts.append(len(tokens))
        self.out.write(frame)
        self.at += len(frame)

    def finish(self) -> None:
        for values, kind in ((self.ids, "<i8"), (self.known, "<u1"), ([*self.starts, self.at], "<u8"), (self.counts, "<u4")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(_TAIL.pack(len(self.ids), MAGIC))


class Shard:
    """A shard opened for reading: shard[k] reads and decompresses the k-th document alone."""

    def __init__(self, file, dictionary: bytes):
        self.file = file
        size = file.size()
        magic, version, width, digest = _HEAD.unpack(file.read_at(_HEAD.size, 0))
        n, end = _TAIL.unpack(file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or end != MAGIC or version != 1:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("written with another dictionary")
        self.width = f"<u{width}"
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        index = 8 * n + n + 8 * (n + 1) + 4 * n
        data = file.read_at(index, size - _TAIL.size - index)
        parts, at = [], 0
        for kind, length in (("<i8", n), ("<u1", n), ("<u8", n + 1), ("<u4", n)):
            parts.append(np.frombuffer(data, kind, length, at))
            at += parts[-1].nbytes
        self.ids, self.known, self.starts, self.counts = parts

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, k: int) -> np.ndarray:
        start, end = int(self.starts[k]), int(self.starts[k + 1])
        size = int(self.counts[k]) * int(self.width[-1])
        frame = self.file.read_at(end - start, start)
        return np.frombuffer(self.decompressor.decompress(frame, max_output_size=size), self.width)

    def find(self, doc_id: int) -> list[int]:
        """Places of a document; ids ascend after those that are null."""
        first = int((self.known == 0).sum())
        a, b = np.searchsorted(self.ids[first:], [doc_id, doc_id + 1]) + first
        return list(range(a, b))


# --- tables of documents ------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    documents_per_shard: int = DOCUMENTS_PER_SHARD,
) -> DataFrame:
    """Write the ids of all rows in ascending order of their id to shards; returns (nr, file, documents, tokens).

    The folder must be one that the driver and all executors reach. A shard is a range of ids, written by one task
    under a name of its own; the returned table names those of successful tasks, so a task that is lost or runs twice
    leaves at most a file that nothing refers to. The dictionary is trained on the ids of the TRAINING_DOCUMENTS rows
    with the smallest hash of their id (the smallest text of each id); it changes sizes only, never contents.

    Null texts count as empty (the end id alone); null ids come first; repeated rows are written as often as they
    come. An empty table gives a dictionary and no shard.
    """
    texts = keyed_text(docs, id_col, text_col)
    spark = docs.sparkSession
    width = id_type(max(vocabulary_size(tokenizer_path), end_id + 1))

    def serialise(batches):
        for batch in batches:
            ids = encode(batch.column("text").to_pylist(), tokenizer_path, end_id)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(width).tobytes() for x in ids], pa.binary())], ["ids"])

    chosen = texts.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = chosen.limit(TRAINING_DOCUMENTS).distinct()
    # One text an id, however often the id is repeated: their ids reach the driver.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    dictionary = train_dictionary([r["ids"] for r in sample.mapInArrow(serialise, "ids binary").collect() if r["ids"]])
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches):
        target, where = open_folder(folder)
        nr = TaskContext.get().partitionId()
        name = f"shard-{nr:06d}-{uuid.uuid4().hex[:12]}.tok"
        out = writer = None
        for batch in batches:
            if batch.num_rows and writer is None:
                out = target.open_output_stream(f"{where}/{name}")
                writer = ShardWriter(out, width, shared.value)
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts, tokenizer_path, end_id), strict=True):
                writer.add(doc_id, ids)
        if writer is not None:
            writer.finish()
            out.close()
            row = [nr], [name], [len(writer.ids)], [sum(writer.counts)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["nr", "file", "documents", "tokens"])

    shards = max(1, -(-texts.count() // documents_per_shard))
    ordered = texts.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    return stash(ordered.mapInArrow(write, "nr long, file string, documents long, tokens long"))


def read_tokens(written: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the shards that `written` names.

    start is the number of tokens of all documents before it. ids are little-endian unsigned 32-bit integers.
    """
    before = Window.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    files = written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("file", "start")

    def read(batches):
        source, path = open_folder(folder)
        with source.open_input_stream(f"{path}/dictionary") as file:
            dictionary = file.read()
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with source.open_input_file(f"{path}/{name}") as file:
                    shard = Shard(file, dictionary)
                    starts = start + np.cumsum(shard.counts, dtype=np.int64) - shard.counts
                    for a in range(0, len(shard), 512):
                        b = min(a + 512, len(shard))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(shard.ids[a:b].astype(np.int64), mask=shard.known[a:b] == 0),
                                pa.array(starts[a:b]),
                                pa.array(shard.counts[a:b].astype(np.int64)),
                                pa.array([shard[k].astype("<u4").tobytes() for k in range(a, b)], pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    # The rows are few but stand for much: a number that Spark does not merge into fewer tasks.
    return files.repartition(max(1, written.count()), "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write all rows to a new folder in the shared one and read them back."""
    folder = shared_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, folder, tokenizer_path, end_id), folder)
