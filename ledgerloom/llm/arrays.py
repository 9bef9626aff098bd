"""Texts as flat byte arrays: words and rolling hashes of a whole Arrow batch at once.

All task code of this subpackage works on the UTF-8 bytes of many texts laid end to end, so that a batch costs a
few numpy passes and no Python step per word. Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words of letters, digits and everything beyond ASCII, after lower-casing A-Z
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Sums:
    """Prefix sums of a polynomial over bytes: the hash of any slice in O(1), equal slices have equal hashes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def slices(texts: pa.Array, most: int = 2 << 20, rows: int = 1 << 15) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes of text: (first row, rows, bytes, offsets of each row and the end)."""
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def whole(docs: DataFrame) -> Column:
    """All columns of a table as one struct, ``doc``: names that an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def text_of(batch: pa.RecordBatch, at: int) -> pa.Array:
    """Column ``at`` of the struct in the first column of a batch, as strings."""
    texts = batch.column(0).flatten()[at]
    return texts if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else texts.cast(pa.string())


def tidy(task: Callable) -> Callable:
    """A task function that gives freed memory back to the system at its end: task processes stay alive for the next ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of marked bytes; a run never goes from one row into the next."""
    n = len(mask)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1] | cut[1:n]
    ends[:-1] &= ~mask[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Words:
    """Words of the rows of a slice: start and end byte, 64-bit hash of the lower-cased bytes, and row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.lower = LOWER[data]
        self.start, self.end = runs(WORD[data], offsets)
        self.hash = Sums(self.lower).of(self.start, self.end)
        #: first word of each row, and the number of words at the end
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, and where each row's begin; a shorter, not empty row gives one shingle."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    stop = np.repeat(first[1:], count)
    padded = np.concatenate([words, np.zeros(size, dtype=U64)])
    out = np.full(len(at), 0x632BE59BD9B4E019, dtype=U64)
    for k in range(size):
        inside = at + k < stop
        out = mixed(out ^ np.where(inside, padded[at + k], U64(0)) ^ U64(k + 1))
    return out, begin
