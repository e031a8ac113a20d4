"""Merkle manifest against a plain recursive build, on small superblocks so that the exchange recurses."""

import hashlib
import random
import zlib

import pytest

from turnstile.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, source, lang, n_chars, text):
    return H(*(enc(v) for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        cur = out[-1]
        out.append([H(*cur[i : i + 8]) for i in range(0, len(cur), 8)])
    return out


def path(lv, i):
    """(left, right) of node i on each level below the top."""
    steps = []
    for level in lv[:-1]:
        start = i - i % 8
        steps.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
        i //= 8
    return steps


def brute(rows):
    """rows of (doc_id, source, lang, n_chars, text) -> {(doc_id, leaf): result tuple}."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf(*r)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sub = {}
    for g in langs:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        sub[g] = levels([h for _, h in groups[g]])
    top = levels([sub[g][-1][0] for g in langs])
    root = top[-1][0]
    out = {}
    for gi, g in enumerate(langs):
        for i, (r, h) in enumerate(groups[g]):
            steps = path(sub[g], i) + path(top, gi)
            proof = H(*(a + b for a, b in steps))
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r[0], r[1], r[2], r[3], text)
            for a, b in steps:
                node = H(a, node, b)
            out.setdefault((r[0], h), set()).add((r[2], i, sub[g][-1][0], root, proof, node, node == root))
    return out


def rows_of(rng, n):
    langs = ["en", "de", None, "ñ", "z"]
    rows = []
    for _ in range(n):
        doc_id = rng.choice([None, *range(60)]) if rng.random() < 0.3 else rng.randrange(10**6)
        text = rng.choice([None, "", "Hello World", "ÄBC abc", "x" * rng.randrange(50)])
        rows.append((doc_id, rng.choice([None, "web", "code"]), rng.choice(langs), rng.choice([None, 0, 12]), text))
    rows += [rows[0], rows[0], rows[1]]
    return rows


@pytest.mark.parametrize("block_levels", [1, 2, 5])
def test_manifest_against_plain_build(spark, block_levels):
    rng = random.Random(block_levels)
    rows = rows_of(rng, 700) + [(7, "only", "solo", 1, "Lone Leaf")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(docs.withColumn("h", docs.text).withColumn("grp", docs.lang), block_levels=block_levels).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        positions = want[(r["doc_id"], r["leaf"])]
        assert any(
            (r["lang"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) == (w[0], *w[2:])
            for w in positions
        ), r
    assert {r["verified"] for r in got} == {True, False}


def test_single_row_and_empty(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = merkle.manifest(spark.createDataFrame([(1, None, "en", 3, "ABC")], schema)).collect()
    h = leaf(1, None, "en", 3, "ABC")
    assert [(r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in one] == [(h, h, h, H())]
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0


def test_ranked_spreads_equal_rows(spark):
    """A group of equal rows still gets places 0..n-1 across several partitions."""
    df = spark.range(5000).selectExpr("'g' AS grp", "1 AS doc_id", "'x' AS h").repartition(7)
    got = merkle.ranked(df, ["doc_id", "h"]).select("pos").collect()
    assert sorted(r[0] for r in got) == list(range(5000))
