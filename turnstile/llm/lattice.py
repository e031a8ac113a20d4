"""Marginal likelihood of words over all their segmentations into subword pieces."""

from __future__ import annotations

import numpy as np

LONGEST = 16  # code points of a piece
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_SLOTS = 1 << 20
_START = "▁"  # stands for the border before a word


class Pieces:
    """The pieces of a vocabulary with a log-probability (base e) each, found by hash.

    `pieces` are the ordinary pieces; the 256 byte pieces come after them, and last the end of a text.
    """

    def __init__(self, pieces: list[str], logp: np.ndarray):
        self.size, self.logp = len(pieces), logp
        keys = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            keys[i] = _hash(np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64))
        # Open addressing: a slot holds the index of a piece plus one.
        self.keys, self.table = keys, np.zeros(_SLOTS, np.int32)
        for i, k in enumerate(keys):
            slot = int(k >> np.uint64(44))
            while self.table[slot]:
                slot = (slot + 1) % _SLOTS
            self.table[slot] = i + 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, -1 for none."""
        slot = (keys >> np.uint64(44)).astype(np.int64)
        found = self.table[slot] - 1
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % _SLOTS
            found[open_] = self.table[slot[open_]] - 1
            open_ = open_[(found[open_] >= 0) & (self.keys[found[open_]] != keys[open_])]
        return found


def _hash(codes: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in codes:
            h = h * _BASE + c + np.uint64(1)
        return np.uint64(_mix(np.array([h]))[0])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _by_length(words: list[bytes]):
    """(rows, code points) of the words of each length, in parts of bounded size; the start sign comes first."""
    texts = [_START + w.decode("utf-8", "replace") for w in words]
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        step = max(1, (1 << 18) // int(n))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            yield part, codes[starts[part][:, None] + np.arange(n)]


class _Lattice:
    """Arcs of words of one length. Arc l of column i is the piece of l + 1 code points from i on."""

    def __init__(self, pieces: Pieces, codes: np.ndarray):
        self.codes, self.n = codes, codes.shape[1]
        self.ids, self.logp = [], []
        h = np.zeros(codes.shape, np.uint64)
        wide = codes.astype(np.uint64) + np.uint64(1)
        for size in range(1, min(LONGEST, self.n) + 1):
            h = h[:, : self.n - size + 1] * _BASE + wide[:, size - 1 :]
            found = pieces.find(_mix(h).ravel()).reshape(h.shape)
            self.ids.append(found)
            self.logp.append(np.where(found >= 0, pieces.logp[found], -np.inf))
        # Characters without a piece of their own are spelled in bytes.
        self.spelled = self.ids[0] < 0
        if self.spelled.any():
            signs, inverse = np.unique(codes[self.spelled], return_inverse=True)
            costs = np.array([sum(pieces.logp[pieces.size + b] for b in _bytes(c)) for c in signs])
            self.logp[0][self.spelled] = costs[inverse]

    def forward(self) -> np.ndarray:
        """Log-probability of every beginning, summed over all segmentations."""
        a = np.full((self.codes.shape[0], self.n + 1), -np.inf)
        a[:, 0] = 0.0
        for j in range(1, self.n + 1):
            for size in range(1, min(LONGEST, j) + 1):
                a[:, j] = np.logaddexp(a[:, j], a[:, j - size] + self.logp[size - 1][:, j - size])
        return a

    def backward(self) -> np.ndarray:
        b = np.full((self.codes.shape[0], self.n + 1), -np.inf)
        b[:, self.n] = 0.0
        for i in range(self.n - 1, -1, -1):
            for size in range(1, min(LONGEST, self.n - i) + 1):
                b[:, i] = np.logaddexp(b[:, i], b[:, i + size] + self.logp[size - 1][:, i])
        return b


def _bytes(code: int) -> bytes:
    return chr(code).encode("utf-8", "replace")


def log_likelihood(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    """Natural logarithm of each word's probability: the sum over all its segmentations."""
    out = np.zeros(len(words))
    with np.errstate(over="ignore"):
        for rows, codes in _by_length(words):
            out[rows] = _Lattice(pieces, codes).forward()[:, -1]
    return out


def expected_counts(pieces: Pieces, words: list[bytes], times: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, each counted `times` times."""
    total = np.zeros(len(pieces.logp))
    with np.errstate(over="ignore"):
        for rows, codes in _by_length(words):
            lattice = _Lattice(pieces, codes)
            a, b, n = lattice.forward(), lattice.backward(), times[rows].astype(float)
            whole = a[:, -1:]
            for k, (ids, logp) in enumerate(zip(lattice.ids, lattice.logp, strict=True)):
                width = logp.shape[1]
                share = np.exp(a[:, :width] + logp + b[:, k + 1 : k + 1 + width] - whole) * n[:, None]
                use = ids >= 0
                total += np.bincount(ids[use], share[use], len(total))
                if k == 0 and lattice.spelled.any():
                    signs, inverse = np.unique(codes[lattice.spelled], return_inverse=True)
                    for sign, amount in zip(signs, np.bincount(inverse, share[lattice.spelled]), strict=True):
                        for byte in _bytes(sign):
                            total[pieces.size + byte] += amount
    return total
