"""Texts as codes of repeated chunks, so that a tokenizer sees each distinct chunk once a task.

A chunk is a run of spaces and newlines with the letters after it, if an ASCII
character other than a letter follows them, or else with all characters up to
the next such run. A byte-level pattern always ends a match between a letter and
a character that is none, and before white space that follows other characters,
so encoding chunk by chunk gives the ids of the whole text. A text with any
other white space is one chunk of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

CHUNK = re.compile(r"[ \n]*(?:[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+(?=[\x00-@\[-`{-\x7f]|\Z)|[^ \n]+)|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")
KEEP_CHUNKS = 600_000  # the cache starts anew beyond so many chunks or ids; this bounds a worker's memory
KEEP_IDS = 8_000_000


def chunks(text: str) -> list[str]:
    if not text:
        return []
    return [text] if OTHER_SPACE.search(text) else CHUNK.findall(text)


class ChunkCodes:
    """Codes of chunks; ``encode`` maps new chunks to lists of ids."""

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def codes(self, texts: list[str]) -> list[list[int]]:
        """The code list of each text."""
        if len(self.code) > KEEP_CHUNKS or self.used > KEEP_IDS:
            self._clear()
        split = [chunks(t) for t in texts]
        new = list(set().union(*split).difference(self.code))
        if new:
            self._add(new, self.encode(new))
        get = self.code.__getitem__
        return [list(map(get, s)) for s in split]

    def _add(self, new: list[str], ids: list) -> None:
        n, first = len(new), len(self.code)
        lengths = np.fromiter(map(len, ids), np.int64, n)
        total = int(lengths.sum())
        self.flat = _room(self.flat, self.used + total)
        self.start, self.length = _room(self.start, first + n), _room(self.length, first + n)
        self.flat[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self.start[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.length[first : first + n] = lengths
        self.used += total
        self.code.update(zip(new, range(first, first + n)))

    def ids(self, codes: list[int]) -> np.ndarray:
        """The ids of one text, from its codes."""
        c = np.asarray(codes, np.int64)
        lengths = self.length[c]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[c] - ends + lengths, lengths) + np.arange(total)]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


def slices(texts: list[str], size: int = 2_000_000) -> list[slice]:
    """Cut a batch into runs of texts of about ``size`` characters; a longer text is alone."""
    out, first, total = [], 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            out.append(slice(first, i))
            first, total = i, 0
        total += len(t)
    return [*out, slice(first, len(texts))] if first < len(texts) else out
