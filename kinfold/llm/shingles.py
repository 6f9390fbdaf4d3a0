"""Word shingles of many texts at once, as 64-bit hashes over arrays of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .pretoken import CHUNK, mixed, span_hashes

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_groups(texts: pa.Array, most: int = CHUNK):
    """(first row, bytes, offsets) of runs of texts with about ``most`` bytes; null is empty, a longer text a run of its own."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None and texts.buffers()[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words_of(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of solid bytes, and the index of each text's first word (and beyond the last)."""
    n = len(data)
    padded = np.zeros(n + 2, bool)
    padded[1:-1] = solid
    start, end = padded[1:-1] & ~padded[:-2], padded[1:-1] & ~padded[2:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    start[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets)


class Shingler:
    """Sets of word shingles. A text of fewer words than a shingle has is one shingle; without words it has none."""

    def __init__(self, words: int = 5):
        self.words = words
        self.odd = mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def sets(self, data: np.ndarray, offsets: np.ndarray):
        """The sorted distinct shingle hashes of each text, in order."""
        s, e, of = words_of(data, offsets, ~BLANK[data])
        w = span_hashes(LOWER[data], s, e) if len(s) else np.zeros(0, np.uint64)
        k = self.words
        full = np.zeros(max(len(w) - k + 1, 0), np.uint64)
        for i in range(k):
            full += w[i : i + len(full)] * self.odd[i]
        full = mixed(full)
        none = np.zeros(0, np.uint64)
        for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(full[a : b - k + 1])
            elif b > a:
                yield mixed((w[a:b] * self.odd[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield none
