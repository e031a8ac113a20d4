"""Quality operators: text statistics against loops, models by accuracy on rows held out."""

import random
import zlib

import numpy as np
import pytest

from turnstile.llm import features, pu_quality, quality_rules

SPACE = " \t\n\v\f\r"


def counted(text):
    words = (text or "").encode().split()
    spots = {}
    for k in range(len(words) - 4):
        spots.setdefault(tuple(words[k : k + 5]), []).append(k)
    cover = set()
    for starts in spots.values():
        if len(starts) > 1:
            cover.update(k + j for k in starts for j in range(5))
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(SPACE):
            repeated += line in seen
            seen.add(line)
    chars = sum(c not in SPACE for c in text or "")
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), repeated, len(cover)


TEXTS = [None, "", " \n\t", "a b\na b\n\na b \n a b\na b", "é ñ 日本 😀 #*$%&|<>", "x " * 3000, "a b c d e f " * 2, "one\xa0two\x85three\x1ffour",
         "q" * 100_000, "\n".join(["the same line of words"] * 50), " ".join(str(k % 50) for k in range(20_000)), "a b c d e a b c d e"]


def test_statistics(docs_of, spark):
    rows = [*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3])]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality_rules.apply_rules(docs_of(rows), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        text = TEXTS[3 if r.doc_id is None else r.doc_id]
        want = counted(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert (r.base_failed, r.kept) == (failed, not failed)  # without labels only the rules decide


def corpus(n=2400):
    """Clean texts, and bad ones full of signs or repetition, of which a part is labelled."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        words, bad = [word() for _ in range(rng.randint(20, 80))], rng.random() < 0.25
        if bad:
            words = [w + rng.choice(["***", "$$$"]) for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, int(not bad), 0))
    labels += [(labels[0][0], labels[0][1], 1), (None, 1, 0), (10**6, 1, 0), (3, None, None)]
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (None, "lost words here"), (10**7, None), (10**7 + 1, "")], "doc_id long, text string")
    return rows, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def bad(text):
    return "*" in text or "$" in text or len(set(text.split())) == 1


def test_positive_unlabelled(learned):
    rows, docs, labels = learned
    found = {r.doc_id: r for r in pu_quality.score_quality(docs, labels).collect()}
    assert len(found) == docs.count()
    held = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    good_scores, bad_scores = ([found[i].score for i, t in held if bad(t) == b] for b in (False, True))
    ordered = np.mean([g > b for g in good_scores for b in bad_scores])
    assert ordered >= 0.97 and np.mean(np.array(good_scores) >= 0.3) >= 0.98 and np.mean(np.array(bad_scores) < 0.3) >= 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    assert not found[None].held_out and found[10**7].score == found[10**7 + 1].score
    kept = pu_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if i is None or r.predicted}


def test_positive_unlabelled_where_all_are_labelled(spark):
    rows, _ = corpus(1500)
    labels = spark.createDataFrame([(i, int(not bad(t))) for i, t in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = [(r.score, bad(dict(rows)[r.doc_id])) for r in pu_quality.score_quality(docs, labels).collect() if r.held_out]
    good_scores, bad_scores = ([s for s, b in held if b == kind] for kind in (False, True))
    assert np.mean([g > b for g in good_scores for b in bad_scores]) >= 0.97
    assert np.mean(np.array(good_scores) >= 0.3) >= 0.98 and np.mean(np.array(bad_scores) < 0.3) >= 0.5


def test_calibrated_rules(learned):
    rows, docs, labels = learned
    found = {r.doc_id: r for r in quality_rules.apply_rules(docs, labels).collect()}
    held = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(found[i].kept == (not bad(t)) for i, t in held)
    assert right >= 0.95 * len(held)


def test_tables_without_rows_or_labels(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert pu_quality.score_quality(docs_of([]), none).count() == 0
    assert quality_rules.apply_rules(docs_of([]), none).count() == 0
    assert [r.score for r in pu_quality.score_quality(docs_of([(1, "a")]), none).collect()] == [0.5]


def test_sparse_rows_score_like_texts():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=features.SIZE).astype(np.float32)
    texts = [b"", b"a", b"ab", b"abc", "é ñ a a a b".encode(), b"word word other " * 50, b" \n "]
    scores = features.linear_scores(texts, weights, 0.5)
    for text, score in zip(texts, scores, strict=True):
        places, values = features.sparse_row(text)
        assert score == pytest.approx(0.5 + float((weights[places].astype(float) * values).sum()), abs=1e-4)
        alone = features.linear_scores([text], weights, 0.5)[0]
        assert score == pytest.approx(alone, abs=1e-6)


def test_sample_has_one_row_an_id(docs_of, spark, monkeypatch):
    collected = []
    monkeypatch.setattr(features, "Sparse", lambda rows: collected.append(rows.num_rows))
    chosen = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id long, label int")
    features.collect_sample(docs_of([(1, "a b")] * 50 + [(2, "c"), (2, "b"), (3, "d")]), chosen)
    assert collected == [3]


def test_prior():
    rng = np.random.default_rng(2)
    positive = rng.normal(2, 1, 4000)
    mixed = np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert pu_quality.estimate_prior(positive, mixed) == pytest.approx(0.7, abs=0.06)
    assert pu_quality.estimate_prior(positive[:0], mixed) == 0.5


def test_sparse_sample_reads_buffers_in_place():
    import pyarrow as pa

    from turnstile.llm.features import Sparse

    rng = np.random.default_rng(4)
    rows = []
    for i in rng.permutation(60):
        n = int(rng.integers(0, 9))
        rows.append((int(i) // 2, int(i) % 2, rng.integers(0, 1000, n).astype(np.int32), rng.random(n).astype(np.float32)))
    table = pa.table({
        "doc_id": [r[0] for r in rows], "label": pa.array([r[1] for r in rows], pa.int32()),
        "places": pa.array([r[2].tobytes() for r in rows], pa.binary()), "vals": pa.array([r[3].tobytes() for r in rows], pa.binary()),
    })
    table = pa.concat_tables([table.slice(0, 25), table.slice(25)])  # two chunks, the second one sliced
    sample = Sparse(table)
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    assert sample.ids.tolist() == [r[0] for r in want] and sample.labels.tolist() == [r[1] for r in want]
    chosen = np.array([5, 0, 59, 17])
    places, values, counts = sample.part(chosen)
    assert counts.tolist() == [len(want[k][2]) for k in chosen]
    assert places.tolist() == np.concatenate([want[k][2] for k in chosen]).tolist()
    assert values.tolist() == np.concatenate([want[k][3] for k in chosen]).tolist()


def test_rules_fit_with_few_labelled_rows(docs_of, spark):
    """Three rows of each class still give a model: calibration is cross-fitted, not skipped."""
    good = "the committee met on tuesday and agreed on the plan for the new library building downtown"
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5 != 0][:6]
    rows = [(i, good + f" item {i}") if k < 3 else (i, "$$$ buy now $$$ click ### free ### win $$$ now now now") for k, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, int(k < 3), 0) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    weights, bias, slope, offset = quality_rules.train(docs_of(rows), labels)
    assert np.abs(weights).sum() > 0 and slope > 0
    one_class = labels.where("quality = 1")
    assert quality_rules.train(docs_of(rows), one_class)[2:] == (0.0, 40.0)
