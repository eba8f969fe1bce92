"""Words of whole texts by byte classes: an ASCII byte is a part of a term or a divider, every
byte of a longer character is a part. So a text is lower-cased and cut by one table lookup over
its bytes. Small helper of the operators on terms; runs inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B)]
DIGITS = [*range(0x30, 0x3A)]


def byte_classes(parts: list[int]) -> np.ndarray:
    """For each byte: itself (A-Z lower-cased) where it is a part of a term, a blank elsewhere."""
    table = np.full(256, 0x20, np.uint8)
    inside = np.array([*parts, *range(0x80, 0x100)])
    table[inside] = inside
    upper = np.arange(0x41, 0x5B)
    table[upper] = np.where(table[upper] == upper, upper + 0x20, 0x20)
    return table


def terms(texts: pa.Array, classes: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts one after another, dictionary-encoded, and the text of each.

    A null text has no terms."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    mapped = classes[np.frombuffer(data, np.uint8)] if data is not None and data.size else np.zeros(0, np.uint8)
    cut = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(mapped)], 0, texts.offset)
    words = pc.ascii_split_whitespace(cut)
    if texts.null_count:
        words = pc.if_else(texts.is_valid(), words, pa.scalar(None, words.type))
    where = pc.list_parent_indices(words)
    flat = words.flatten()
    real = pc.not_equal(flat, "")
    encoded = flat.filter(real).cast(pa.string()).dictionary_encode()
    return encoded, np.asarray(where.filter(real)).astype(np.int64, copy=False)
