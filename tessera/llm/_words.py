"""Encoding texts through a cache of their words.

Both tokenizer families cut a text at its single spaces before they merge
anything, so the ids of a text are the ids of its space-led words in a row.
Each distinct word is then encoded once per worker process.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

# a space between two characters that no tokenizer takes for white space
# (written to begin with the space, which lets the search skip to spaces)
_CUT = re.compile(r" (?<=[\w!-~] )(?=[\w!-~])")
_IRREGULAR = re.compile(r" (?:(?![\w!-~])|(?<![\w!-~] ))")


def chunks(text: str | None) -> list[str]:
    """The text in pieces; every piece but the first stands after one space."""
    if not text:
        return []
    return _CUT.split(text) if _IRREGULAR.search(text) else text.split(" ")


class WordCache:
    """Word -> ids; starts anew beyond ``limit`` words (or four ids for each)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_000_000):
        self.encode_words, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("q")

    def add(self, words: list[str]) -> None:
        # a key that begins with NUL stands for the rest of it, any other for itself after a space
        ids, sizes = self.encode_words([w[1:] if w[:1] == "\x00" else " " + w for w in words])
        first = len(self.sizes)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.starts.frombytes((len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.int32).tobytes())

    def _gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words at these places, and where each ends."""
        sizes = _view(self.sizes, np.int64)[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(_view(self.starts, np.int64)[place] - ends[:-1], sizes)
        return _view(self.flat, np.int32)[at], ends

    def encode(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and row offsets of texts given as ``chunks`` (lists that
        are not used again)."""
        if len(self.index) > self.limit or len(self.flat) > 4 * self.limit:
            self.clear()
        words: list[str] = []
        for row in rows:
            if row:  # a first piece has no space before it: kept apart by a leading NUL
                row[0] = "\x00" + row[0]
                words += row
        found = list(map(self.index.get, words))
        if None in found:
            missing = [k for k, v in enumerate(found) if v is None]
            self.add(list(dict.fromkeys(words[k] for k in missing)))
            for k in missing:
                found[k] = self.index[words[k]]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        ids, ends = self._gather(np.array(found, np.int64))
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


def _view(values: array, kind: type) -> np.ndarray:
    """The array's items without a copy (gone before it grows again)."""
    return np.frombuffer(values, kind) if values else np.zeros(0, kind)
