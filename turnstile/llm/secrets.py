"""Secret scans: base patterns, then dictionary-primed zstandard novelty for strings in sensitive context.

Base spans, leftmost and non-overlapping per kind, failing matches dropped without a retry:
- assign: a keyword (ASCII letters in either case), an optional quote, `:` or `=` between spaces, an optional
  quote, and a value of 8 or more characters of `[A-Za-z0-9+/_.=-]`; the span is the whole match;
- access: `AKIA[A-Z0-9]+` of 16 or more characters;
- hex: `[0-9a-f]+` of 32 or more characters.

The method adds spans of kind "novel": runs of 20 or more characters of `[A-Za-z0-9+/_-]` (with up to two
`=` of padding) that follow a sensitive word within 48 characters, overlap no base span, and cost at
least NOVELTY compressed bytes a byte when appended to the 512 characters before them. The cost is the
smaller one of two zstandard compressors primed with raw-content dictionaries: one of the most frequent
lines ("code") and one of the most frequent identifiers, both counted over all texts, whole. Lines of
under LINE_BYTES bytes, and lines with a run as long as a candidate, are left out of the first, so that
a copied secret does not become familiar by its line.

Offsets are code points, end exclusive. Null texts are empty (no spans); null ids are kept; repeated
rows give repeated results; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import collections
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import keyed_text, stash

# The base patterns and their kinds in the order of the output.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Maximal runs of [0-9a-f]; those of 32 or more are exactly the kept matches of `[0-9a-f]+`.
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"key|secret|token|auth|bearer|credential|passw|pwd|private|signature|session|cookie", re.A | re.I)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
LOOK_BACK = 48  # characters before a candidate searched for a sensitive word
CONTEXT = 512  # characters before a candidate that it is compressed after
LEVEL = 19  # finds matches of three bytes in the dictionaries
NOVELTY = 0.6  # compressed bytes a byte at or above which a candidate is reported (6 bits a character of random base64 give 0.75)
LINE_BYTES = 20  # shorter lines are no part of the dictionary of lines
CODE_BYTES = 65_536
IDENTIFIER_BYTES = 32_768

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
OUTPUT = "doc_id long, base array<struct<kind string, start long, end long>>, spans array<struct<kind string, start long, end long>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def dictionaries(lines: list[str], identifiers: list[str] | None = None) -> tuple[bytes, bytes]:
    """Raw-content dictionaries: the lines, and the identifiers, both by falling frequency; without identifiers,
    those of the lines."""
    if identifiers is None:
        counts = collections.Counter(m for line in lines for m in IDENTIFIER.findall(line))
        identifiers = sorted(counts, key=lambda w: (-counts[w], w))
    return "\n".join(lines).encode()[:CODE_BYTES], " ".join(identifiers).encode()[:IDENTIFIER_BYTES]


class Novelty:
    """Marginal compressed bytes a byte of a string after its context, the smaller of the two dictionaries."""

    def __init__(self, code: bytes, identifiers: bytes):
        def compressor(content: bytes) -> zstd.ZstdCompressor:
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if content:
                primed = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                primed.precompute_compress(level=LEVEL)
                options["dict_data"] = primed
            return zstd.ZstdCompressor(**options)

        self.compressors = [compressor(code), compressor(identifiers)]

    def __call__(self, context: str, candidate: str) -> float:
        before, after = context.encode(), (context + candidate).encode()
        cost = min(len(c.compress(after)) - len(c.compress(before)) for c in self.compressors)
        return cost / len(candidate.encode())


def _covered(base: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of the base spans, disjoint and ascending."""
    starts: list[int] = []
    ends: list[int] = []
    for _, s, e in sorted(base, key=lambda b: b[1]):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    found = []
    starts, ends = _covered(base)
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        i = bisect.bisect_left(starts, e) - 1  # the last covered stretch that starts before the candidate ends
        if i >= 0 and ends[i] > s:
            continue
        if SENSITIVE.search(text, max(0, s - LOOK_BACK), s) and novelty(text[max(0, s - CONTEXT) : s], m.group()) >= NOVELTY:
            found.append(("novel", s, e))
    return found


def scan(text: str, novelty: Novelty) -> tuple[list, list]:
    """(base spans, all spans) of one text, each by start, then kind as listed."""
    base = base_spans(text)
    spans = sorted(base + novel_spans(text, base, novelty), key=lambda s: (s[1], KINDS.index(s[0])))
    return base, spans


def _tokens(keyed: DataFrame) -> DataFrame:
    """Every line (kind 0) and identifier (kind 1) of every text, with its hash and its bytes in a dictionary."""
    lines = keyed.select(F.lit(0).alias("kind"), F.explode(F.split("text", "\n")).alias("token"))
    lines = lines.where((F.octet_length("token") >= LINE_BYTES) & ~F.col("token").rlike(CANDIDATE.pattern))
    names = F.regexp_extract_all("text", F.lit(IDENTIFIER.pattern), F.lit(0))
    tokens = lines.union(keyed.select(F.lit(1).alias("kind"), F.explode(names).alias("token")))
    return tokens.withColumns({"h": F.xxhash64("token"), "size": F.octet_length("token") + 1})


def _leading(counts: DataFrame, limit: int, least: int) -> list[int]:
    """Hashes by falling count, ties by hash, until the sizes (each `least` or more) reach limit bytes.

    Counts are first summed up by powers of two, so that only the rows of the powers needed are sorted.
    """
    power = F.floor(F.log2("n"))
    total, lowest = 0, 0
    for lowest, size in sorted(counts.groupBy(power).agg(F.sum("size")).collect(), reverse=True):  # at most 63 rows
        total += size
        if total >= limit:
            break
    chosen, total = [], 0
    for h, size in counts.where(power >= lowest).orderBy(F.desc("n"), "h").limit(limit // least + 1).select("h", "size").collect():
        if total >= limit:
            break
        chosen.append(h)
        total += size
    return chosen


def corpus_dictionaries(keyed: DataFrame) -> tuple[bytes, bytes]:
    """The dictionaries of all texts: exact counts of every line and identifier, by hash; then the text of those that
    fill the dictionaries. What reaches the driver is bounded by the sizes of the dictionaries."""
    tokens = _tokens(keyed)
    counts = stash(tokens.groupBy("kind", "h").agg(F.count("*").alias("n"), F.min("size").alias("size")))
    limits = ((CODE_BYTES, LINE_BYTES + 1), (IDENTIFIER_BYTES, 4))
    places = {(kind, h): i for kind, (limit, least) in enumerate(limits) for i, h in enumerate(_leading(counts.where(F.col("kind") == kind), limit, least))}
    wanted = keyed.sparkSession.createDataFrame([(*key, i) for key, i in places.items()], "kind int, h long, place int")
    found = tokens.join(F.broadcast(wanted), ["kind", "h"]).select("kind", "place", F.substring("token", 1, CODE_BYTES).alias("token")).distinct()
    texts = sorted(map(tuple, found.collect()))
    return dictionaries(*([t for kind, _, t in texts if kind == k] for k in (0, 1)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) for every row of docs; spans are structs (kind, start, end). Only counts are shuffled."""
    keyed = keyed_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(corpus_dictionaries(keyed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(*shared.value)
        for batch in batches:
            found = [scan(t, novelty) for t in batch.column("text").to_pylist()]
            as_structs = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([as_structs(b) for b, _ in found], pa.list_(SPAN)),
                 pa.array([as_structs(a) for _, a in found], pa.list_(SPAN))],
                names=["doc_id", "base", "spans"],
            )

    return keyed.mapInArrow(run, OUTPUT)
