"""SentencePiece encoding that keeps source offsets, and decoding.

The model's compiled character map (a double-array trie and a pool of replacements) normalises
a text by its longest known prefixes; each replacement byte records the source byte it came
from. Pieces are laid over the normalised text, and their ends are projected through that
alignment, so every piece has a byte span of the original text. With an empty map (identity)
the alignment is a shift and spans come from piece lengths with array operations.

Ids are the library's own. When the map is the identity and no piece of the vocabulary
continues past the start of a word, words are encoded apart, each distinct word of a task once;
texts with doubled, leading or trailing blanks or the word mark itself go to the library whole,
as do all texts under any other model.

Defined cases: null text is empty; an empty text has no pieces; rows are independent, so
repeated rows give equal results; an empty table gives no rows; other columns pass through
unless they bear a result's name (`ids`, `begins`, `ends`, `decoded`), which the result takes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.common import memory_returned, released
from sprintlens.llm.word_pieces import ChunkEncoder, interleave, lists, pieces_of

#: The word mark of the library, U+2581.
MARK = "▁"
#: Texts are encoded and decoded in slices of about so many bytes: ids, spans and the lists that
#: the library decodes take some twenty times as much.
SLICE_BYTES = 512 << 10
#: Distinct words that a worker remembers.
WORDS = 150_000


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: (number, value)."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 0x7F) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 0x80:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            length, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = data[i : i + length], i + length
        yield key >> 3, value


class CharacterMap:
    """The compiled map: uint32 size, a trie of uint32 units, replacements ended by zero bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of text[at:] and its replacement."""
        if not self.units:
            return None
        offset = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        found, node = None, offset(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != text[i]:
                break
            node ^= offset(unit)
            if unit & 0x100:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if not found:
            return None
        start = found[1]
        return found[0], self.pool[start : self.pool.index(b"\0", start)]


class Codec:
    """Encodes and decodes with one model."""

    def __init__(self, path: str, end_id: bool = True):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            spec = dict(_message(dict(_message(f.read())).get(3, b"")))
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.normal_bytes = np.array([self._covered(i, n, 3) for i, n in enumerate(names)])
        self.source_bytes = np.array([self._covered(i, n, 1) for i, n in enumerate(names)])
        self.plain = not self.map.units and self.prefix and not self.squeeze and self.escape
        self.by_word = self.plain and not any(MARK in n.lstrip(MARK) or n[:2] == MARK * 2 and n.strip(MARK) for n in names)
        self.end = [self.sp.eos_id()] if end_id else []
        self.words = ChunkEncoder(lambda chunks: self.sp.encode(chunks, num_threads=1), keep=WORDS)

    def _covered(self, i: int, name: str, mark: int) -> int:
        if self.sp.is_control(i):
            return 0
        if self.sp.is_byte(i):
            return 1
        return sum(mark if c == MARK else len(c.encode()) for c in name)

    def normalise(self, text: str) -> tuple[bytes, list[int]]:
        """The normalised text and, for each of its bytes and its end, the source byte offset."""
        data, i = text.encode(), 0
        out, source = bytearray(), []
        blank = MARK.encode() if self.escape else b" "

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        steps = []
        while i < len(data):
            hit = self.map.longest(data, i)
            width = hit[0] if hit else max(1, 1 + sum(data[i] >= b for b in (0xC0, 0xE0, 0xF0)))
            steps.append((hit[1] if hit else data[i : i + width], i, width))
            i += width
        if self.squeeze:
            while steps and steps[0][0].strip(b" ") == b"":
                steps.pop(0)
            while steps and steps[-1][0].strip(b" ") == b"":
                steps.pop()
        if steps and self.prefix:
            put(blank, steps[0][1])
        was_blank = self.squeeze
        for piece, at, _ in steps:
            for byte in piece:
                if byte == 0x20:
                    if not (self.squeeze and was_blank):
                        put(blank, at)
                    was_blank = True
                else:
                    put(bytes([byte]), at)
                    was_blank = False
        source.append(steps[-1][1] + steps[-1][2] if steps else 0)
        return bytes(out), source

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of pieces in the source, through the recorded alignment."""
        normal, source = self.normalise(text)
        upto, ends = 0, []
        unknown = self.sp.unk_id()
        for i, piece in zip(ids, self.sp.encode(text, out_type=str) + [""] * len(self.end)):
            upto += len(piece.encode()) if i == unknown else int(self.normal_bytes[i])
            ends.append(min(upto, len(normal)))
        at = np.asarray(source)
        begin = np.array([0, *ends[:-1]], np.int64)[: len(ends)]
        return at[begin], at[np.asarray(ends, np.int64)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, begins, ends of all texts one after another, and the number of ids per text."""
        texts = pc.fill_null(texts, "")
        if not self.plain:
            ids = [i + self.end for i in self.sp.encode(texts.to_pylist(), num_threads=1)]
            spans = [self.spans(t, i) for t, i in zip(texts.to_pylist(), ids)]
            join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
            return join(ids), join([s[0] for s in spans]), join([s[1] for s in spans]), np.array([len(i) for i in ids])
        if self.by_word:
            odd = pc.or_(pc.match_substring_regex(texts, f"^ |  | $|{MARK}"), pc.equal(texts, ""))
        else:
            odd = pa.array(np.ones(len(texts), bool))
        odd = np.asarray(odd)
        whole = [i + self.end for i in self.sp.encode(texts.filter(pa.array(odd)).to_pylist(), num_threads=1)]
        ids, counts = self.words(pc.split_pattern(texts.filter(pa.array(~odd)), " "))
        if self.end:
            ids = np.insert(ids, np.cumsum(counts), self.end[0])
            counts = counts + 1
        if whole:
            ids, counts = interleave(odd, (ids, counts), whole)
        total = np.concatenate([[0], np.cumsum(self.source_bytes[ids])])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        first = np.repeat(total[bounds[:-1]] + 1, counts)  # the mark put before a text covers no byte of it
        begins, ends = np.maximum(total[:-1] - first, 0), np.maximum(total[1:] - first, 0)
        for i in np.flatnonzero(np.asarray(pc.match_substring(texts, MARK))):  # a mark of the source has three bytes
            a, b = bounds[i], bounds[i + 1]
            begins[a:b], ends[a:b] = self.spans(texts[int(i)].as_py(), ids[a:b].tolist())
        return ids, begins, ends, counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        flat, bounds = ids.tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()
        return self.sp.decode([flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]) if len(counts) else []


@functools.lru_cache(maxsize=2)
def shared_codec(path: str, end_id: bool) -> Codec:
    """One per Python worker, so that its tasks share the words encoded before."""
    return Codec(path, end_id)


RESULTS = ("ids", "begins", "ends", "decoded")


def coded(codec: Codec, batches: Iterator[pa.RecordBatch], kept: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of a text and the kept columns, slice by slice: the kept columns and the results."""
    memory_returned()  # what earlier tasks left to a worker that is used again
    for batch in batches:
        for part in pieces_of(batch, SLICE_BYTES):
            ids, begins, ends, counts = codec.encode(part.column(0))
            decoded = pa.array(codec.decode(ids, counts), pa.string())
            arrays = [lists(x, counts) for x in (ids, begins, ends)]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays, decoded], [*kept, *RESULTS])


def encode_decode(docs: DataFrame, model_path: str, end_id: bool = True, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Columns `keep` (default: all) with ids, begins, ends (byte spans) and decoded of `text`."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    slim = docs.select(F.col("text").cast("string").alias("_source_text"), *kept)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*kept).schema)
    schema = f"{fields}, ids array<int>, begins array<int>, ends array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from coded(shared_codec(model_path, end_id), batches, kept)

    return slim.mapInArrow(released(run), schema)
