"""Token ids of texts."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from turnstile.llm.common import by_size

# A run of spaces and line ends, and what follows up to the next one, or only letters if these signs follow them.
# Nothing is tried twice: no part can give back what it took.
_STRETCH = re.compile(r"[ \n]*+(?:[A-Za-zÀ-ÖØ-öø-ÿ]++(?:(?=[.,!?;:*$%&#|])|[^ \n]*+)|[^ \n]++)|[ \n]++")
# White space of any kind but these two, ASCII first.
_ASCII_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f"
_WIDE_SPACE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_REMEMBERED = 400_000  # stretches a task keeps at hand; as many older ones are looked up when they are missing there
_JOINED = 4096  # new stretches given to the tokenizer as one text


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size()


@functools.lru_cache(maxsize=2)
def _special_strings(path: str) -> tuple[str, ...] | None:
    """Strings with ids of their own, if the tokenizer works stretch by stretch; else None.

    Byte-level tokenizers of the usual pattern begin a new word at every white space that follows something else, and
    between a letter and a sign other than an apostrophe.
    """
    form = json.loads(_tokenizer(path).to_str())
    words = form.get("pre_tokenizer") or {}
    usual = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
    plain = form.get("normalizer") is None and not form["model"].get("dropout")
    return tuple(t["content"] for t in form["added_tokens"]) if usual and plain else None


class _Memory:
    """Ids of stretches met before. Many stretches of a corpus are the same, and splitting them is the costly part."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        # Bytes of text that an id stands for: a byte-level vocabulary has one letter for each.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.known: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit integers
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _REMEMBERED:
            self.known, self.older = {}, self.known
        get = self.known.get
        split = [_STRETCH.findall(t) for t in texts]
        found = [list(map(get, stretches)) for stretches in split]
        gaps = [[i for i, ids in enumerate(row) if ids is None] for row in found]
        self._learn(dict.fromkeys(stretches[i] for stretches, at in zip(split, gaps, strict=True) for i in at))
        for stretches, row, at in zip(split, found, gaps, strict=True):
            for i in at:
                row[i] = get(stretches[i])
        return [b"".join(row) for row in found]

    def _learn(self, new: Iterable[str]) -> None:
        words, others = [], []
        for s in new:
            if (ids := self.older.get(s)) is not None:
                self.known[s] = ids
            elif s[0] in " \n" and s[-1] not in " \n":
                words.append(s)
            else:
                others.append(s)
        for a in range(0, len(words), _JOINED):
            some = words[a : a + _JOINED]
            if (cut := self._joined(some)) is None:
                others += some
            else:
                self.known.update(zip(some, cut, strict=True))
        for a in range(0, len(others), 8192):
            some = others[a : a + 8192]
            for s, encoded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[s] = np.array(encoded.ids, "<u4").tobytes()

    def _joined(self, words: list[str]) -> list[bytes] | None:
        """Ids of stretches that begin with white space and end without, encoded as one text, which is much less work.

        None if they cannot be told apart by the bytes that each id stands for.
        """
        (encoded,) = self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        ends, at = np.cumsum([len(s.encode()) for s in words]), np.cumsum(self.sizes[ids])
        if not len(at) or at[-1] != ends[-1]:
            return None
        last = np.searchsorted(at, ends)
        if (at[last] != ends).any():
            return None
        data, cuts = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def _other_space(text: str) -> bool:
    return any(c in text for c in _ASCII_SPACE) or (not text.isascii() and any(c in text for c in _WIDE_SPACE))


@functools.lru_cache(maxsize=1)
def _memory(path: str) -> _Memory:
    return _Memory(path)


def encode(texts: list[str], path: str, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each whole text and an end id.

    Where the tokenizer allows it, each different stretch of text is encoded once and its ids are used again, with the
    same result as for the whole text. Texts with other white space or with special strings are encoded whole.
    """
    tokenizer, special = _tokenizer(path), _special_strings(path)
    end = np.array([end_id], "<u4").tobytes()
    for a, b in by_size(texts, 1 << 20):
        part = texts[a:b]
        whole = [special is None or _other_space(t) or any(s in t for s in special) for t in part]
        split = iter(_memory(path).encode([t for t, w in zip(part, whole, strict=True) if not w]) if special is not None else ())
        for text, w in zip(part, whole, strict=True):
            ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if w else next(split)
            yield np.frombuffer(ids + end, "<u4")
