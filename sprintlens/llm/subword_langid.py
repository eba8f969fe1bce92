"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords (runs of 2 to 4 bytes inside words, word ends included) are hashed to
buckets; the text's vector is the mean of its buckets' embeddings; a linear softmax gives the
languages' probabilities. Embeddings and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample: about `sample` documents in all, the same number per
language, chosen by a hash of the id. A fifth of the sample is left out of training and sets
the softmax temperature and the score under which a prediction counts as rejected (the lowest
that keeps `precision` on it).

Counting subwords runs in tasks over whole texts; the driver sees the sample's bucket
frequencies (one 8 KB row per sampled document).

Defined cases: text that is null or has no letter of any script is `und`, score 0, rejected;
rows without lang or doc_id teach nothing; with no teaching rows everything is `und`; repeated
rows are predicted alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.byte_text import ByteText
from sprintlens.llm.common import in_fold
from sprintlens.llm.pareto_mix import uniform
from sprintlens.llm.word_pieces import pieces_of

BUCKETS = 4096
WIDTH = 16
SAMPLE = 6000
EPOCHS = 20
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float


def subword_means(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Per text the share of its subwords in each bucket, and whether it has a letter."""
    t = ByteText(texts)
    data = t.data
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    code = np.where(letter, data, np.uint8(32)).astype(np.uint64)
    document = np.repeat(np.arange(t.n), np.diff(t.offsets))
    counts = np.zeros(t.n * buckets)
    for n in (2, 3, 4):
        if len(data) < n:
            continue
        gram = np.zeros(len(data) - n + 1, np.uint64)
        use = document[: len(gram)] == document[n - 1 :]
        for i in range(n):
            gram |= code[i : len(gram) + i] << np.uint64(8 * i)
            if 0 < i < n - 1:
                use &= letter[i : len(gram) + i]
        use &= letter[: len(gram)] | letter[n - 1 :]
        bucket = ((gram[use] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(buckets).bit_length() + 1)
        counts += np.bincount(document[: len(gram)][use] * buckets + bucket.astype(np.int64), minlength=len(counts))
    counts = counts.reshape(t.n, buckets)
    has_letter = t.per_document((data >= 97) & (data <= 122)) > 0
    for i in np.flatnonzero(~has_letter):
        has_letter[i] = any(c.isalpha() for c in (texts[int(i)].as_py() or ""))
    return counts / np.maximum(counts.sum(1, keepdims=True), 1), has_letter


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, width: int = WIDTH, precision: float = 0.99) -> Model:
    """x: bucket shares, y: language numbers, in an order that does not depend on the run."""
    rng = np.random.default_rng(7)
    held = np.arange(len(x)) % 5 == 4
    train, check = np.flatnonzero(~held), np.flatnonzero(held)
    embed = rng.normal(0, 1 / width, (x.shape[1], width))
    head, bias = np.zeros((width, len(languages))), np.zeros(len(languages))
    scale = np.sqrt(x.shape[1])  # shares are small numbers; this keeps steps of a usual size
    step, done, total = 0.5, 0, epochs * len(train)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train), max(1, len(train) // 16)):
            xs = x[rows] * scale
            hidden = xs @ embed
            p = softmax(hidden @ head + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = p @ head.T
            rate = step * (1 - done / total)
            head -= rate * (hidden.T @ p)
            bias -= rate * p.sum(0)
            used = np.flatnonzero(xs.any(0))
            embed[used] -= rate * (xs[:, used].T @ back)
            done += len(rows)
    weights = scale * embed @ head
    temperature, threshold = 1.0, 0.0
    if len(check):
        z, truth = x[check] @ weights + bias, y[check]
        loss = lambda t: -np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean()
        temperature = min(np.geomspace(0.25, 8, 41), key=loss)
        p = softmax(z / temperature)
        score, right = p.max(1), p.argmax(1) == truth
        order = np.argsort(-score)
        good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
        threshold = float(score[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, weights, bias, float(temperature), threshold)


def train(docs: DataFrame, teach: Column, sample: int = SAMPLE) -> Model:
    """Model from (text, lang) of rows where `teach` holds and lang is given."""
    rows = docs.filter(teach & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    each = max(50, sample // len(languages))
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, each / sizes[k])])
    drawn = rows.filter(uniform("langid", F.col("doc_id")) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, most_rows=1024):
                means, _ = subword_means(part.column(0))
                packed = [row.tobytes() for row in means.astype(np.float16)]
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(packed, pa.binary())], ["doc_id", "lang", "x"])

    found = drawn.select("text", F.col("doc_id").cast("string"), "lang").mapInArrow(count, "doc_id string, lang string, x binary").collect()
    found.sort(key=lambda r: (r["doc_id"][::-1], r["lang"], r["x"]))
    number = {k: i for i, k in enumerate(languages)}
    x = np.array([np.frombuffer(r["x"], np.float16) for r in found], np.float32).reshape(-1, BUCKETS)
    return fit(x, np.array([number[r["lang"]] for r in found], np.int64), languages)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in pieces_of(batch, most_rows=1024):
                x, known = subword_means(part.column(0))
                known &= bool(model.languages)
                p = softmax((x @ model.weights + model.bias) / model.temperature) if model.languages else np.zeros((len(x), 1))
                best = np.where(known, p.argmax(1), len(model.languages))
                score = np.where(known, p.max(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(score < model.threshold)],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.select("text", "doc_id").mapInArrow(predict, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def train_and_identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts all rows; adds held_out."""
    model = train(docs, in_fold(F.col("doc_id")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
