"""Whole batches of UTF-8 text as byte arrays: words, their 64-bit hashes, sums per document.
Small helpers that run inside tasks."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class ByteText:
    """data: the bytes of all texts, A-Z lower-cased if asked; offsets: where each text starts."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.raw, self.offsets = data, offsets - offsets[0]
        self.data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data) if lower else data

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    def runs(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs between separators, cut at documents' borders."""
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        inside = ~separator
        start = inside & (np.concatenate([[True], separator[:-1]])[: len(inside)] | edge[:-1])
        end = inside & (np.concatenate([separator[1:], [True]])[: len(inside)] | edge[1:])
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs((self.data == 0x20) | ((self.data >= 9) & (self.data <= 13)))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte runs: polynomial over scrambled bytes, then scrambled."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        size = max(1 << 19, 1 << int(len(self.data)).bit_length())
        up, down = _powers(size)
        letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[self.data] * up[: len(self.data)])])
        return mixed((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def per_document(self, hit: np.ndarray) -> np.ndarray:
        """How many of a document's bytes have a property."""
        upto = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        return upto[self.offsets[1:]] - upto[self.offsets[:-1]]
