"""Fill-in-the-middle against a plain regex cut, and the boundary set against sorted lists."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.llm import fim
from turnstile.llm.boundaries import BoundarySet

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    toks = TOKEN.findall(text)
    n = len(toks)
    if doc_id is None:
        return n, "plain", None, None, text
    hx = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(hx[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    k1, k2 = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(toks[:k1]), "".join(toks[k1:k2]), "".join(toks[k2:])
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", len(pre), len(mid), "<P>" + pre + "<S>" + suf + "<M>" + mid


@pytest.mark.parametrize("seed", [1, 2])
def test_boundary_set_against_sorted_list(seed):
    rng = np.random.default_rng(seed)
    parts = [
        rng.choice(1 << 16, 300, replace=False),  # array
        (1 << 16) + rng.choice(1 << 16, 30_000, replace=False),  # bitmap
        (2 << 16) + np.arange(100, 50_000),  # run
        (5 << 16) + np.array([0, 65535]),
    ]
    values = np.unique(np.concatenate(parts))
    bounds = BoundarySet(rng.permutation(values))
    assert set(bounds.kinds) == {"array", "bitmap", "run"}
    assert len(bounds) == values.size
    assert np.array_equal(bounds.to_array(), values)
    for rank in rng.choice(values.size, 2000, replace=False).tolist() + [0, values.size - 1]:
        assert bounds.select(rank) == values[rank]
    with pytest.raises(IndexError):
        bounds.select(values.size)
    empty = BoundarySet(np.array([], dtype=np.int64))
    assert len(empty) == 0
    with pytest.raises(IndexError):
        empty.select(0)


def random_text(rng):
    words = ["alpha", "Beta", "x", "éclair", "naïve", "数据", "<P>", "<", "S>", "M", "\n", "  ", "42", "🙂", "a-b"]
    return "".join(rng.choice(words) + rng.choice(["", " ", ",", "\t"]) for _ in range(rng.randrange(0, 40)))


def test_fill_in_middle_against_plain_cut(spark, docs_of):
    rng = random.Random(7)
    rows = [(i, random_text(rng)) for i in range(400)]
    rows += [(None, "no id here"), (5, None), (6, ""), (7, "x" * 70_000 + " end " + "y" * 70_000), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(8, "<S> holds a sentinel"), (9, "日本語のテキスト" * 9000)]
    got = fim.fill_in_middle(docs_of(rows)).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[5] or "")
    want = sorted(((d, *brute(d, t)) for d, t in rows), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert got == want
    forms = {r[2] for r in got}
    assert forms == {"plain", "psm", "spm"}


def test_restore_gives_the_text_back(spark, docs_of):
    rng = random.Random(3)
    rows = [(i, random_text(rng)) for i in range(300)] + [(1000, None), (1001, "<<P>"), (1002, "ab<c")]
    out = fim.fill_in_middle(docs_of(rows))
    back = out.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted((r[0], r[1]) for r in back) == sorted((d, t or "") for d, t in rows)


def test_empty_table(spark, docs_of):
    assert fim.fill_in_middle(docs_of([])).count() == 0
