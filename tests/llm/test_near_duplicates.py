"""SimHash groups and components against plain loops."""

import random

import numpy as np
import pytest

from turnstile.llm import simhash
from turnstile.llm.components import components


def brute_groups(rows, shingle, max_bits):
    prints = [simhash.fingerprint(simhash.shingle_hashes((t or "").encode(), shingle)) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= max_bits and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for k, (i, _) in zip(label, rows, strict=True):
        least[k] = min([x for x in (least.get(k), i) if x is not None], default=None)
    return sorted(((i, f"{p:016x}", least[k]) for (i, _), p, k in zip(rows, prints, label, strict=True)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (4, "one two"), (None, "one two"), (9, "a b c d e f"),
            (8, "z " * 3000)]
    found = simhash.simhash_groups(docs_of(rows))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert got(found) == brute_groups(rows, 3, 2)


def test_empty(docs_of):
    assert simhash.simhash_groups(docs_of([])).count() == 0


def test_keep_one(docs_of):
    docs = docs_of([(3, "a b c"), (1, "A b C"), (2, "x y z w"), (None, "a b c")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("small", [1, 64])
def test_links_join_all_within_distance(spark, monkeypatch, max_bits, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = random.Random(max_bits)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(12):  # random walks away from the seed
            for b in rng.sample(range(64), rng.randint(1, 3)):
                s ^= 1 << b
            prints.add(s)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), max_bits)
    roots = {r.node: r.root for r in components(links).collect()}
    label = {p: p for p in signed}
    for _ in signed:
        for a in signed:
            for b in signed:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits:
                    label[a] = min(label[a], label[b])
    assert {p: roots.get(p, p) for p in signed} == label


def test_components_of_long_paths(spark):
    rng = random.Random(1)
    nodes = list(range(60))
    rng.shuffle(nodes)
    edges = [(nodes[i], nodes[i + 1]) for i in range(39)] + [(nodes[50], nodes[51]), (nodes[50], nodes[51]), (nodes[52], nodes[52])]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {n: min(nodes[:40]) for n in nodes[:40]} | {n: min(nodes[50:52]) for n in nodes[50:52]}


def test_thresholds_follow_the_pigeonhole():
    rng = np.random.default_rng(0)
    bits = rng.random((4000, 64)) < rng.random(64)
    both = bits.T.astype(float) @ bits
    for max_bits in range(4):
        plan = simhash.allocate(4000, both, max_bits)
        used = [b for group, _ in plan for b in group]
        assert len(used) == len(set(used))
        # Any way to spread max_bits differences leaves one partition within its threshold.
        assert sum(e + 1 for _, e in plan) == max_bits + 1
