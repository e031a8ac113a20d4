"""Benchmark items in documents against a plain loop."""

import random

import pytest

from turnstile.llm import decontamination


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(docs, items, containment=0.8):
    out, have, want = [], {}, {}
    for i, t in docs:
        have.setdefault(i, set()).update(shingles(t))
    for i, t in items:
        want.setdefault(i, set()).update(shingles(t))
    for d, a in have.items():
        for i, b in want.items():
            if d is not None and i is not None and b and len(a & b) >= containment * len(b) - 1e-9:
                out.append((d, i, len(b), len(a & b)))
    return sorted(out)


def got(df):
    return sorted(tuple(r)[:4] for r in df.collect())


@pytest.fixture
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("small", [0, 10**6])
def test_random_texts(docs_of, items_of, monkeypatch, small):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", small)  # both kinds of join
    rng = random.Random(small)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(25)]
    docs = []
    for d in range(40):
        words = [word() for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.7:
            leak = rng.choice(items)[1].upper().split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                leak[rng.randrange(len(leak))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = leak
        docs.append((d, "\n".join(words)))
    found = got(decontamination.find_leaks(docs_of(docs), items_of(items)))
    assert found and found == brute(docs, items)


def test_awkward_rows(docs_of, items_of):
    item = "one two three four five six seven eight"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "x " * 20_000 + item.upper()), (5, "four"), (6, "four four")]
    items = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "four")]
    assert got(decontamination.find_leaks(docs_of(docs), items_of(items))) == brute(docs, items)
    assert decontamination.find_leaks(docs_of([]), items_of(items)).count() == 0
    assert decontamination.find_leaks(docs_of(docs), items_of([])).count() == 0
    kept = decontamination.without_leaks(docs_of(docs), items_of(items))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "None"]
    assert kept.columns == docs_of(docs).columns


def test_no_python_in_the_plan(docs_of, items_of):
    plan = decontamination.find_leaks(docs_of([(1, "a")]), items_of([(1, "a")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
