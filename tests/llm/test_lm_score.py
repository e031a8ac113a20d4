"""Lattice likelihood and word model against plain loops."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from turnstile.llm import lattice, lm_score
from turnstile.llm.common import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
WORDS = ["the", "a", "internationalisation", "日本語テキスト", "ééè", "x" * 40, "\U0001f600z", "<0x41>", "▁", "don't", "́"]


def costs():
    pieces, logp = lm_score.vocabulary(PATH)
    return pieces, logp, dict(zip(pieces, logp, strict=False))


def arcs(text, cost, pieces, logp):
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 16), j):
            part = text[i:j]
            if part in cost:
                yield i, j, cost[part], [pieces.index(part)]
            elif j - i == 1:
                spelled = [len(pieces) + b for b in part.encode()]
                yield i, j, sum(logp[k] for k in spelled), spelled


def forward(text, cost, pieces, logp):
    a = [0.0] + [-math.inf] * len(text)
    for i, j, p, _ in arcs(text, cost, pieces, logp):
        a[j] = np.logaddexp(a[j], a[i] + p)
    return a


def test_likelihood_and_expected_counts():
    pieces, logp, cost = costs()
    table = lattice.Pieces(pieces, logp)
    got = lattice.log_likelihood(table, [w.encode() for w in WORDS])
    counts = np.zeros(len(logp))
    for w, g in zip(WORDS, got, strict=True):
        text = "▁" + w
        a = forward(text, cost, pieces, logp)
        assert g == pytest.approx(a[-1])
        back = [-math.inf] * len(text) + [0.0]
        every = sorted(arcs(text, cost, pieces, logp), key=lambda x: -x[0])
        for i, j, p, _ in every:
            back[i] = np.logaddexp(back[i], p + back[j])
        for i, j, p, used in every:
            for k in used:
                counts[k] += math.exp(a[i] + p + back[j] - a[-1])
    found = lattice.expected_counts(table, [w.encode() for w in WORDS], np.ones(len(WORDS)))
    assert np.allclose(found, counts)
    assert len(lattice.log_likelihood(table, [])) == 0


@pytest.mark.parametrize("frequent", [0, 5, 10**6])
def test_scores(docs_of, frequent):
    rows = [(i, f"word w{i % 7} É the the {'x' * (i % 5)}\n") for i in range(40)]
    rows += [(41, None), (42, ""), (None, "the lost"), (3, rows[3][1]), (43, "q" * 5000), (44, "the " * 20_000)]
    found = lm_score.score_texts(docs_of(rows), PATH, rounds=1, frequent=frequent).collect()
    assert len(found) == len(rows)
    learn = [(t or "").encode().lower().split() for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for ws in learn for w in ws)
    n, v, ends = sum(c.values()) + len(learn), len(c) + 1, len(learn)
    texts = {i: (t or "").encode().lower().split() for i, t in rows}
    prob = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    for r in found:
        ws = texts[r.doc_id]
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n)
        assert r.base_score == pytest.approx(sum(prob(c[w]) for w in ws) + prob(ends))
    by_text = {r.doc_id: r.score for r in found}
    # Words and the end are independent: the score of a text is a sum.
    assert by_text[41] == by_text[42] < 0
    assert all(s < 0 for s in by_text.values())
    # The same whatever words are joined or given to every task.
    if frequent:
        other = lm_score.score_texts(docs_of(rows), PATH, rounds=1, frequent=0).collect()
        assert {r.doc_id: r.score for r in other} == pytest.approx(by_text)


def test_nothing_to_learn_from(docs_of):
    assert lm_score.score_texts(docs_of([]), PATH, rounds=1).count() == 0
    row = lm_score.score_texts(docs_of([(None, "a b")]), PATH, rounds=1).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert math.isfinite(row.score) and math.isfinite(row.base_score)
