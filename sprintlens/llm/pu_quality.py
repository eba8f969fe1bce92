"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are rows that `labels` marks quality 1; the unlabelled set is web text as it
comes, labels unseen. A small network on whole-text statistics minimises

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss, so its sigmoid estimates P(good | text). The class prior is estimated
from the data: among the sets {score >= t} of a first positive-against-unlabelled model, the
smallest ratio of unlabelled to positive mass (bad documents only add unlabelled mass, so the
ratio bounds the prior from above and meets it where none is left).

Statistics are computed in tasks over whole texts. Training reads a bounded sample chosen by a
hash of the id (`positives` and `unlabelled` documents at most on average); the driver sees
their statistics only, some 30 numbers a document.

Defined cases: null text is empty; empty texts get the score of all-zero statistics; null
doc_id is never a label's; repeated rows score alike; without positives every score is 0.5
(nothing is known, nothing rejected); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.byte_text import ByteText
from sprintlens.llm.common import in_fold, released
from sprintlens.llm.pareto_mix import uniform
from sprintlens.llm.word_pieces import pieces_of

POSITIVES = 8000
UNLABELLED = 16000
HIDDEN = 24
EPOCHS = 60
#: Texts are measured in slices of about so many bytes: a byte takes some fifty in the arrays.
SLICE_BYTES = 512 << 10


def statistics(texts: pa.Array) -> np.ndarray:
    """Numbers that describe each whole text, one row per text."""
    t = ByteText(texts, lower=False)
    data, n = t.data, t.n
    size = np.maximum(np.diff(t.offsets), 1)
    share = lambda hit: t.per_document(hit) / size
    marks = [share(data == ord(c)) for c in ".,;:!?|*#$%&<>{}=/_-'\"()@"]
    upper, small = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, blank = (data >= 48) & (data <= 57), (data == 32) | (data == 9)
    starts, ends = t.words()
    doc = t.document_of(starts)
    length = (ends - starts).astype(np.float64)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    total = lambda v: np.bincount(doc, v, minlength=n)
    mean = total(length) / some
    h = t.hashes(starts, ends)
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])])[: len(h)]
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    fresh = np.concatenate([[True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])])[: len(hs)]
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(hs)))
    distinct = np.bincount(ds[at], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, ds[at], times)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    odd_end = ~(((last >= 48) & (last <= 57)) | ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128) | np.isin(last, np.frombuffer(b".,;:!?", np.uint8)))
    shouting = np.concatenate([[0], np.cumsum(upper)])
    loud = (shouting[ends] - shouting[starts]) >= np.maximum(2, 0.6 * length)
    ls, le = t.runs(data == 10)
    ld, lh = t.document_of(ls), t.hashes(ls, le)
    lorder = np.lexsort((lh, ld))
    twice = np.concatenate([[False], (lh[lorder][1:] == lh[lorder][:-1]) & (ld[lorder][1:] == ld[lorder][:-1])])[: len(lh)]
    line_bytes = np.bincount(ld, le - ls, minlength=n)
    twice_bytes = np.bincount(ld[lorder], (le - ls)[lorder] * twice, minlength=n)
    columns = [
        *marks,
        share(upper), share(small), share(digit), share(blank), share(data == 10), share(data >= 128),
        np.log1p(words), mean, np.sqrt(np.maximum(total(length**2) / some - mean**2, 0)),
        total(again) / some, distinct / some, distinct / np.sqrt(some), most / some,
        total(odd_end) / some, total(loud) / some,
        words / np.maximum(t.per_document((data == 46) | (data == 33) | (data == 63)), 1),
        twice_bytes / np.maximum(line_bytes, 1), words / np.maximum(np.bincount(ld, minlength=n), 1),
    ]
    return np.column_stack(columns).astype(np.float32)


@dataclass
class Model:
    center: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(self.scaled(x) @ w1 + b1) @ w2 + b2

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.spread, -6, 6)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def minimise(xp: np.ndarray, xu: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 11) -> list[np.ndarray]:
    """Network weights by mini-batch Adam on the non-negative risk (inputs already scaled)."""
    rng = np.random.default_rng(seed)
    d = xp.shape[1]
    layers = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    first, second, step = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers], 0
    parts = max(1, len(xu) // 512)
    for epoch in range(epochs):
        for p, u in zip(np.array_split(rng.permutation(len(xp)), parts), np.array_split(rng.permutation(len(xu)), parts)):
            if not len(p) or not len(u):
                continue
            x = np.concatenate([xp[p], xu[u]])
            hidden = np.tanh(x @ layers[0] + layers[1])
            g = hidden @ layers[2] + layers[3]
            gp, gu = g[: len(p)], g[len(p) :]
            rest = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if rest >= 0:
                dp = prior * (-sigmoid(-gp) - sigmoid(gp)) / len(p)
                du = sigmoid(gu) / len(u)
            else:  # the estimate went below what a risk can be: step back
                dp, du = prior * sigmoid(gp) / len(p), -sigmoid(gu) / len(u)
            dg = np.concatenate([dp, du])
            dh = np.outer(dg, layers[2]) * (1 - hidden**2)
            grads = [x.T @ dh + 1e-4 * layers[0], dh.sum(0), hidden.T @ dg + 1e-4 * layers[2], dg.sum()]
            step += 1
            rate = 0.005 * (1 - epoch / epochs)
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                layers[i] = layers[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return layers


def class_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Smallest ratio of unlabelled to positive mass over sets {score >= t} that hold most positives."""
    cuts = np.quantile(sp, np.linspace(0.005, 0.5, 100))
    p = 1 - np.searchsorted(np.sort(sp), cuts) / len(sp)
    u = 1 - np.searchsorted(np.sort(su), cuts) / len(su)
    return float(np.clip((u / p).min(), 0.01, 0.99))


def fit(xp: np.ndarray, xu: np.ndarray) -> Model:
    center = np.median(xu, 0)
    spread = xu.std(0) + 1e-6
    model = Model(center, spread, [], 0.5)
    sp, su = model.scaled(xp), model.scaled(xu)
    # first model: positives against unlabelled, cross-fitted so that its scores are honest
    fold_p, fold_u = np.arange(len(sp)) % 2, np.arange(len(su)) % 2
    priors = []
    for k in (0, 1):
        w1, b1, w2, b2 = minimise(sp[fold_p == k], su[fold_u == k], 0.5, EPOCHS // 3)
        score = lambda x: np.tanh(x @ w1 + b1) @ w2 + b2
        priors.append(class_prior(score(sp[fold_p != k]), score(su[fold_u != k])))
    model.prior = float(np.mean(priors))
    model.layers = minimise(sp, su, model.prior)
    return model


def _measured(docs: DataFrame, extra: list[str]) -> DataFrame:
    """Statistics (packed float32) next to the extra columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, SLICE_BYTES):
                packed = pa.array([row.tobytes() for row in statistics(part.column(0))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], packed], [*extra, "x"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*extra).schema)
    return docs.select("text", *extra).mapInArrow(released(run), f"{fields}, x binary")


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Model from labels outside the held-out fold; None without positives or documents."""
    trusted = labels.filter((F.col("quality") == 1) & in_fold(F.col("doc_id"))).select("doc_id")
    n_p, n_u = trusted.count(), docs.count()
    if not n_p or not n_u:
        return None
    # at most about `positives` ids, whatever the size of the tables
    chosen = trusted.filter(uniform("pu-p", F.col("doc_id")) < positives / n_p).distinct()
    flagged = docs.select("text", "doc_id").join(
        F.broadcast(chosen.select(F.col("doc_id").alias("_id"), F.lit(True).alias("p"))), F.col("doc_id") == F.col("_id"), "left"
    ).select(
        "text",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
        F.coalesce("p", F.lit(False)).alias("p"),
        (uniform("pu-u", F.col("doc_id")) < unlabelled / n_u).alias("u"),
    )
    rows = _measured(flagged.filter(F.col("p") | F.col("u")), ["key", "p", "u"]).collect()
    rows.sort(key=lambda r: (r["key"][::-1], r["x"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64)
    p, u = np.array([r["p"] for r in rows], bool), np.array([r["u"] for r in rows], bool)
    return fit(x[p], x[u]) if p.any() and u.any() else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, SLICE_BYTES):
                x = statistics(part.column(0)).astype(np.float64)
                s = sigmoid(model.logits(x)) if model else np.full(len(x), 0.5)
                arrays = [part.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "predicted"])

    return docs.select("text", "doc_id").mapInArrow(released(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def train_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns outside the held-out fold and scores all rows; adds held_out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return score(docs, train(docs, labels)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier accepts, in one pass over the texts, all columns kept."""
    model = train(docs, labels)
    names = docs.columns
    passed = docs.select("text", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names) if c != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, SLICE_BYTES):
                x = statistics(part.column(0)).astype(np.float64)
                keep = sigmoid(model.logits(x)) >= 0.5 if model else np.ones(len(x), bool)
                yield part.filter(pa.array(keep))

    kept = passed.mapInArrow(released(run), passed.schema)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
