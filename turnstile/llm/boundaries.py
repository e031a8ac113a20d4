"""A Roaring-style set of token boundaries: select the k-th boundary without walking the text.

Offsets are split by their upper 16 bits into containers. A container keeps its lower 16 bits in the
smallest of three forms:

- array: sorted uint16 values (2 bytes a value; sparse boundaries, long words);
- bitmap: 1024 words of 64 bits (8 KiB; dense, mixed text);
- run: (start, length - 1) pairs (4 bytes a run; stretches where every code point is a token,
  white space, digits, scripts other than Latin).

Cumulative cardinalities over the containers find the container of a rank by binary search; a local
select inside that container finishes the answer.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 16
BITMAP_BYTES = CHUNK // 8
_BYTE_POP = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


class BoundarySet:
    """A sorted set of non-negative integers (each below 2**48) with rank select.

    Empty sets are allowed: `len` is 0 and `select` raises IndexError for every rank.
    """

    def __init__(self, positions: np.ndarray):
        positions = np.unique(np.asarray(positions, dtype=np.int64))
        if positions.size and positions[0] < 0:
            raise ValueError("positions must not be negative")
        highs = positions >> 16
        cuts = np.flatnonzero(np.diff(highs)) + 1
        starts = np.concatenate(([0], cuts)) if positions.size else np.array([], dtype=np.int64)
        ends = np.concatenate((cuts, [positions.size])) if positions.size else starts
        self.keys = highs[starts] if positions.size else np.array([], dtype=np.int64)
        self.kinds: list[str] = []
        self.containers: list[np.ndarray] = []
        for s, e in zip(starts, ends, strict=True):
            kind, data = _container(positions[s:e] & (CHUNK - 1))
            self.kinds.append(kind)
            self.containers.append(data)
        counts = (ends - starts).astype(np.int64)
        # cumulative[i]: values in containers before i
        self.cumulative = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, rank: int) -> int:
        """The value of the given rank (0 is the smallest)."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        i = int(np.searchsorted(self.cumulative, rank, side="right")) - 1
        local = rank - int(self.cumulative[i])
        kind, data = self.kinds[i], self.containers[i]
        if kind == "array":
            low = int(data[local])
        elif kind == "run":
            lengths = data[:, 1].astype(np.int64) + 1
            before = np.cumsum(lengths) - lengths
            r = int(np.searchsorted(before, local, side="right")) - 1
            low = int(data[r, 0]) + local - int(before[r])
        else:
            low = _bitmap_select(data, local)
        return (int(self.keys[i]) << 16) | low

    def to_array(self) -> np.ndarray:
        """All values in order (for tests)."""
        out = [np.array([], dtype=np.int64)]
        for key, kind, data in zip(self.keys, self.kinds, self.containers, strict=True):
            if kind == "array":
                low = data.astype(np.int64)
            elif kind == "run":
                low = np.concatenate([np.arange(s, s + n + 1, dtype=np.int64) for s, n in data.astype(np.int64)])
            else:
                low = np.flatnonzero(np.unpackbits(data.view(np.uint8), bitorder="little")).astype(np.int64)
            out.append((int(key) << 16) | low)
        return np.concatenate(out)


def _container(low: np.ndarray) -> tuple[str, np.ndarray]:
    """The smallest form of one container's sorted lower bits."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    run_starts = np.concatenate(([0], breaks))
    run_ends = np.concatenate((breaks, [low.size]))
    sizes = {"array": 2 * low.size, "bitmap": BITMAP_BYTES, "run": 4 * run_starts.size}
    kind = min(sizes, key=lambda k: (sizes[k], k != "run"))
    if kind == "array":
        return kind, low.astype(np.uint16)
    if kind == "run":
        return kind, np.stack([low[run_starts], run_ends - run_starts - 1], axis=1).astype(np.uint16)
    bits = np.zeros(CHUNK, dtype=np.uint8)
    bits[low] = 1
    return kind, np.packbits(bits, bitorder="little").view(np.uint64)


def _bitmap_select(words: np.ndarray, local: int) -> int:
    """Position of the set bit of the given rank: word counts first, then the bits of one word."""
    counts = _BYTE_POP[words.view(np.uint8)].reshape(-1, 8).sum(axis=1)
    before = np.cumsum(counts) - counts
    w = int(np.searchsorted(before, local, side="right")) - 1
    while counts[w] == 0:  # an empty word shares its cumulative count with the next one
        w += 1
    word, rest = int(words[w]), local - int(before[w])
    for bit in range(64):
        if word >> bit & 1:
            if rest == 0:
                return w * 64 + bit
            rest -= 1
    raise AssertionError("rank outside the word")
