"""Fast splitting of texts into pre-tokens: a text is cut at single spaces and each chunk is looked up.

A pre-token never continues behind a space, so the pre-tokens of a chunk that
neither starts nor ends with white space depend on the chunk alone. Chunks are
therefore split once per table and found again by a dictionary lookup; texts
with runs of white space around a space take the pattern over their whole
length.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np

SEGMENT = 1 << 22


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut a very long text before single spaces, where no pre-token can continue."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and (text[cut - 1].isspace() or text[cut + 1:cut + 2].isspace() or cut + 1 == len(text)):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class _Codes(dict):
    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, key):
        value = self[key] = self.add(key)
        return value


class ChunkTable:
    """Maps chunks to runs of integers in one flat array.

    ``ids_of`` gives the integers of a piece of text that is a whole number of
    pre-tokens. ``limit`` bounds the chunks that are remembered: beyond it the
    table starts anew, which costs time and changes no result.
    """

    def __init__(self, find_all: Callable[[str], list[str]], ids_of: Callable[[str], list[int]], limit: int):
        self.find_all, self.ids_of, self.limit = find_all, ids_of, limit
        self.reset()

    def reset(self) -> None:
        self.flat, self.sizes = array("I"), array("q")
        self.chunks = 0
        self.first = _Codes(lambda c: self._add(c, c))
        self.rest = _Codes(lambda c: self._add(c, " " + c))
        self.pieces = _Codes(lambda c: self._store(self.ids_of(c)))

    def _store(self, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.sizes.append(len(ids))
        self.chunks = n = len(self.sizes)
        return n - 1

    def _add(self, chunk: str, text: str) -> int:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return -1
        ids: list[int] = []
        for piece in self.find_all(text):
            ids += self.ids_of(piece)
        return self._store(ids)

    def codes(self, text: str) -> np.ndarray:
        """Places in the table whose runs, one after another, are the text's integers."""
        if not text:
            return np.zeros(0, dtype=np.int64)
        parts = text.split(" ")
        head, tail = parts[0], parts[1:]
        out = np.fromiter(map(self.rest.__getitem__, tail), dtype=np.int64, count=len(tail))
        if head:
            out = np.concatenate((np.array([self.first[head]], dtype=np.int64), out))
        if len(out) and out.min() < 0:
            found = self.find_all(text)
            out = np.fromiter(map(self.pieces.__getitem__, found), dtype=np.int64, count=len(found))
        return out

    def expand(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' integers in one array, and how many each text has."""
        if self.chunks > self.limit:
            self.reset()
        places = [[self.codes(s) for s in segments(t)] for t in texts]
        # views of the arrays, which may not grow before these are gone
        flat, known = np.asarray(self.flat, dtype=np.uint32), np.asarray(self.sizes, dtype=np.int64)
        sizes = np.array([sum(int(known[p].sum()) for p in parts) for parts in places], dtype=np.int64)
        joined = np.concatenate([p for parts in places for p in parts] or [np.zeros(0, dtype=np.int64)])
        return gather(flat, np.cumsum(known) - known, known, joined), sizes


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray,
           step: int = 1 << 19) -> np.ndarray:
    """Concatenate the runs ``flat[starts[p]:starts[p] + sizes[p]]`` over ``places``."""
    out = []
    for at in range(0, len(places), step):
        part = places[at:at + step]
        n = sizes[part]
        ends = np.cumsum(n)
        index = np.arange(int(n.sum()), dtype=np.int64) + np.repeat(starts[part] - (ends - n), n)
        out.append(flat[index])
    return np.concatenate(out) if out else flat[:0].copy()


def text_groups(texts: list[str], size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``size`` characters, so a batch of long texts is worked off in parts."""
    at = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
