"""Repeated passages against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from turnstile.llm import hashing, substring


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("window", [7, 13, 16])
@pytest.mark.parametrize("per_block", [1, 3, 1000])
def test_random_passages(docs_of, window, per_block):
    rng = random.Random(window * 10 + per_block)
    passages = [[f"p{rng.randint(0, 9)}é" for _ in range(rng.randint(window - 2, 40))] for _ in range(4)]
    rows = []
    for i in range(14):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 20))]
        rows.append((rng.randint(0, 20), rng.choice([" ", "\n", "\t "]).join(words)))
    rows += rows[:3] + [(40, rows[4][1]), (41, rows[4][1])]
    assert got(substring.remove_repeated(docs_of(rows), window, docs_per_block=per_block)) == brute(rows, window)


def test_awkward_rows(docs_of):
    long = " ".join(str(k % 1000) for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a b"), (None, long), (None, long), (7, long), (8, long), (6, "a " * 50)]
    assert got(substring.remove_repeated(docs_of(rows), 13)) == brute(rows, 13)
    assert substring.remove_repeated(docs_of([]), 13).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeated(docs_of([]), 6)


@pytest.mark.parametrize("per_block", [1, 1000])
def test_copy_and_other_text_under_one_id(docs_of, per_block):
    x, y = (" ".join(f"{c}{k}" for k in range(15)) for c in "xy")
    rows = [(3, x), (7, x), (7, y), (9, "before " + y + " after")]
    found = got(substring.remove_repeated(docs_of(rows), 13, docs_per_block=per_block))
    assert found == brute(rows, 13)
    assert [(r[0], r[2]) for r in found] == [(3, 0), (7, 0), (7, 15), (9, 15)]


def test_rows_without_id_are_in_no_block(docs_of, monkeypatch):
    def pack(batches, pack=substring._pack):
        for batch in batches:
            assert not batch.column("doc_id").null_count
            yield from pack([batch])

    monkeypatch.setattr(substring, "_pack", pack)
    rows = [(None, "the  same text"), (None, "the  same text"), (None, None), (1, "a b"), (2, "c")]
    assert got(substring.remove_repeated(docs_of(rows), 13)) == brute(rows, 13)


def test_cover_has_every_difference():
    members = substring.COVER
    assert {(a - b) % substring.PERIOD for a in members for b in members} == set(range(substring.PERIOD))


def test_hash_words():
    texts = [b"", b" a  b\tc ", "é è\n ñ a".encode(), b"a" * 700_000 + b" b", b"\n\n", b"b a"]
    hashes, counts = hashing.hash_words(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    by_word = dict(zip(words, hashes.tolist(), strict=True))
    assert [by_word[w] for w in words] == hashes.tolist() and len(set(by_word.values())) == len(by_word)
    runs = hashing.runs(np.array([1, 2, 3, 1, 2, 3], np.uint64), 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 3
