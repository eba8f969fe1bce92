"""Encoding by distinct chunks: a batch's texts are cut into chunks that a tokenizer encodes
independently of each other, each distinct chunk is encoded once, and the ids are put together
with array operations. Small helper of the two token operators; runs inside tasks."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa


class ChunkEncoder:
    """encode: list of distinct chunks -> list of id lists.

    Remembers up to `keep` chunks (more only while one slice has more distinct ones). When full,
    the half met in the most slices stays and old meetings count half, so frequent chunks are
    encoded once per worker."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], keep: int = 300_000):
        self.encode, self.keep = encode, keep
        self.at: dict[str, int] = {}
        self.flat, self.starts, self.met = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def _rows(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))

    def _forget(self) -> None:
        most = min(self.keep // 2, len(self.met))
        stay = np.sort(np.argpartition(-self.met, most - 1)[:most]) if most else np.zeros(0, np.int64)
        words = list(self.at)
        self.at = {words[i]: n for n, i in enumerate(stay.tolist())}
        length = np.diff(self.starts)[stay]
        self.flat = self.flat[spread(self.starts[stay], length)]
        self.starts, self.met = np.concatenate([[0], np.cumsum(length)]), self.met[stay] >> 1

    def _learn(self, chunks: list[str]) -> None:
        ids = self.encode(chunks)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
        self.at.update(zip(chunks, range(len(self.at), len(self.at) + len(chunks))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(length)])
        self.flat = np.concatenate([self.flat, new])
        self.met = np.concatenate([self.met, np.zeros(len(ids), np.int64)])

    def __call__(self, chunks: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts one after another, and the number of ids per text."""
        bounds = np.asarray(chunks.offsets)
        words = chunks.flatten().dictionary_encode()
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        known = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        row = self._rows(known)
        if (row < 0).any():
            self.met[row[row >= 0]] += 1
            if len(self.at) + int((row < 0).sum()) > self.keep:
                self._forget()
                row = self._rows(known)
            self._learn([known[i] for i in np.flatnonzero(row < 0).tolist()])
            row = self._rows(known)
        else:
            self.met[row] += 1
        which = row[np.asarray(words.indices)] if len(known) else np.zeros(0, np.int64)
        begin = self.starts[which]
        length = self.starts[which + 1] - begin
        ids = self.flat[spread(begin, length)]
        upto = np.concatenate([[0], np.cumsum(length)])
        bounds = bounds - bounds[0]
        return ids, np.diff(upto[bounds])


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (length[0] numbers), begin[1], ..."""
    if not len(length):
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(ends[-1]) + np.repeat(begin - (ends - length), length)


def pieces_of(batch: pa.RecordBatch, most_bytes: int = 4 << 20, column: int = 0, most_rows: int = 1 << 20):
    """A batch in slices of about so many bytes of text (a longer text is a slice of its own)."""
    text = batch.column(column)
    if not batch.num_rows:
        return
    size = np.cumsum(np.diff(np.asarray(text.buffers()[1]).view(np.int64 if pa.types.is_large_string(text.type) else np.int32)[text.offset : text.offset + len(text) + 1]))
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        end = min(start + most_rows, max(start + 1, int(np.searchsorted(size, done + most_bytes, "right"))))
        yield batch.slice(start, end - start)
        start = end


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def interleave(
    odd: np.ndarray, even: tuple[np.ndarray, np.ndarray], others: list[list[int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of all texts from those of texts that aren't odd and lists of those that are."""
    counts = np.zeros(len(odd), np.int64)
    counts[~odd], counts[odd] = even[1], [len(x) for x in others]
    ids = np.empty(int(counts.sum()), np.int32)
    from_even = np.repeat(~odd, counts)
    ids[from_even], ids[~from_even] = even[0], np.concatenate([np.zeros(0, np.int32), *map(np.asarray, others)])
    return ids, counts
