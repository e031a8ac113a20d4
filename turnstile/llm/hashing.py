"""Vectorised hashes of words and of runs of words, over many texts at once."""

from __future__ import annotations

import numpy as np

from turnstile.llm.common import by_size

_RNG = np.random.Generator(np.random.PCG64(20_240_101))
_BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 & ~7 | 5  # 5 modulo 8: a long period modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SLICE = 1 << 19
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        factors = np.full(max(n, _SLICE + 1), base, np.uint64)
        factors[0] = 1
        table = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _slice_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word in bytes that begin and end at word borders."""
    space = _IS_SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power_table(_BASE, len(data)), out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, len(data) + 1)[starts])


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts in order, and the number of words of each text.

    Works through slices that end between words, so memory follows the number of words.
    """
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + _SLICE, len(data))
        while end < len(data) and not _IS_SPACE[data[end - 1]]:  # to the end of the word
            rest = _IS_SPACE[data[end : end + _SLICE]]
            end += int(rest.argmax()) + 1 if rest.any() else len(rest)
        s, h = _slice_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    starts, hashes = np.concatenate(starts), np.concatenate(hashes)
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def runs(words: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """Hash of each run of `length` consecutive words, by its first position."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(length):
        h = h * np.uint64(base) + words[k : k + n]
    return mix(h)


def run_starts(counts: np.ndarray, length: int) -> np.ndarray:
    """True at every word position from which `length` words of the same text follow."""
    ends = np.repeat(np.cumsum(counts), counts)
    return np.arange(len(ends)) + length <= ends


def chunks(texts: list[bytes]):
    """(first, last, word hashes, counts) of the texts, a few megabytes of text at a time."""
    for first, last in by_size(texts):
        yield first, last, *hash_words(texts[first:last])
