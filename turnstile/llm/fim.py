"""Fill-in-the-middle: cut each text at two token boundaries and move the middle to the end.

Token ends of a text are kept in a Roaring-style BoundarySet (`boundaries.py`); the two cut offsets
come from its rank select, so a text is never walked token by token after the boundaries are known.

Per document (doc_id, text):
- tokens are `[A-Za-z]+|[^A-Za-z]` over code points; n is their number (0 for null or empty text);
- h1..h4 are the first four 8-digit groups of the hex sha256 of "1:" and the decimal doc_id;
- the prefix ends after min(h1, h2) % (n + 1) tokens, the middle after the larger one;
- form "plain" (text unchanged) for empty texts, texts that hold a sentinel, h3 % 100 >= 90, and rows
  with a null doc_id (no digest to draw from); else "spm" when h4 % 100 < 20, otherwise "psm";
- psm: <P>prefix<S>suffix<M>middle; spm: <S>suffix<P>prefix<M>middle.

A null text is the empty text. Repeated rows give repeated results (the cut depends on doc_id and
text only); other columns are ignored and their names cannot clash with the output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.boundaries import BoundarySet
from turnstile.llm.common import keyed_text

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # h3 % 100 at or above this: plain
SPM_BELOW = 20  # h4 % 100 below this: spm

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def token_ends(text: str) -> BoundarySet:
    """Code point offsets where a token ends: after every non-letter and after the last letter of a run."""
    if not text:
        return BoundarySet(np.array([], dtype=np.int64))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122))
    # a token ends after i unless i and i + 1 are both letters
    ends = np.flatnonzero(~(letter[:-1] & letter[1:])) + 1
    return BoundarySet(np.append(ends, points.size))


def cut(text: str, h: tuple[int, int, int, int] | None) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    bounds = token_ends(text)
    n = len(bounds)
    if h is None or not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a = bounds.select(first - 1) if first else 0
    b = bounds.select(second - 1) if second else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SPM_BELOW:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def _digests(doc_id: Column) -> list[Column]:
    hexed = F.sha2(F.concat(F.lit("1:"), doc_id.cast("string")), 256)
    return [F.conv(F.substring(hexed, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text_type = batch.column("text").type
        cols = {name: batch.column(name).to_pylist() for name in ("doc_id", "text", "h1", "h2", "h3", "h4")}
        rows = [
            cut(text, None if h1 is None else (h1, h2, h3, h4))
            for text, h1, h2, h3, h4 in zip(cols["text"], cols["h1"], cols["h2"], cols["h3"], cols["h4"], strict=True)
        ]
        n, form, pre, mid, out = (list(c) for c in zip(*rows, strict=True)) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["doc_id"], pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
             pa.array(pre, pa.int64()), pa.array(mid, pa.int64()), pa.array(out, text_type)],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs as (doc_id, n, form, prefix_chars, middle_chars, output); no shuffle."""
    keyed = keyed_text(docs, id_col, text_col)
    prepared = keyed.select("doc_id", "text", *_digests(F.col("doc_id")))
    return prepared.mapInArrow(_cut_batches, OUTPUT)


def restore(output: Column, form: Column) -> Column:
    """The original text from an output and its form (plain: unchanged)."""
    parts = {
        "psm": [F.regexp_extract(output, r"(?s)^<P>(.*?)<S>(.*?)<M>(.*)$", k) for k in (1, 3, 2)],
        "spm": [F.regexp_extract(output, r"(?s)^<S>(.*?)<P>(.*?)<M>(.*)$", k) for k in (2, 3, 1)],
    }
    return (
        F.when(form == "psm", F.concat(*parts["psm"]))
        .when(form == "spm", F.concat(*parts["spm"]))
        .otherwise(output)
    )
