"""The best documents of each item by an integer BM25, with terms dealt to successive owners.

1. `posted`: one pass over the documents counts, in tasks, the terms that any item asks for and
   writes them by shard, a run of at most SHARD_ROWS documents: per shard and term the places
   that hold it with their frequencies, per shard the ids and lengths of its documents.
2. Corpus figures: N, L and df of the asked terms, summed over shards.
3. Terms are dealt to stages by df, rare first. Items go in bundles; a bundle carries one sparse
   accumulator per shard and item through the stages. Stage s cogroups (bundle, shard) with the
   postings that its owner holds of this shard, adds w * impact as integers, and hands the bundle
   on. Between stages a place is let go only when it cannot reach the item's k-th score of its own
   shard any more: its sum plus the most that later owners could add is lower. This loses no
   result, and places that only frequent terms hold are never shuffled.
4. The last stage gives each shard's k best of each item; a window takes the k best of all.

Items are cut into independent searches of at most about VOCABULARY terms (their own text for an
item with more), since the asked terms of one search are sent to all tasks. Nothing grows with
the number of documents but the number of shards.

Defined cases: a null or empty item text has no terms and no rows; each item row is ranked for
itself, also if its id repeats; null document texts have no terms and are not counted in N;
equal scores are ordered by doc_id, null (and -2^63) first; rows with one doc_id are documents of their own;
no documents or no items give no rows; whole texts are read; other columns are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprintlens.llm.byte_terms import DIGITS, LETTERS, byte_classes, terms
from sprintlens.llm.common import written
from sprintlens.llm.word_pieces import pieces_of

SHARD_ROWS = 4096
SHARD_BYTES = 32 << 20
VOCABULARY = 500_000
BUNDLE = 256
#: Owner of a term: the first whose share of N is not below its df; the last owns the rest.
OWNERS = (1 / 64, 1 / 8)
HEAD = -1  # the row of a shard that has its ids and lengths
NO_ID = -(1 << 63)  # a null doc_id inside a shard
MOST_IMPACT = 1_000_000  # (1e9 tf) div (1000 tf + 8 m) is below it

POSTED = "shard long, term int, places array<int>, tf array<long>, ids array<long>, lengths array<long>"
CARRIED = "bundle long, shard long, item long, places array<int>, scores array<long>"
FOUND = "item long, doc_id long, score long"


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number of its own per row), item_id, terms (distinct, sorted)."""
    classes = byte_classes([*LETTERS, *DIGITS])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, row = terms(batch.column(2), classes)
            code = np.unique(row * max(1, len(words.dictionary)) + np.asarray(words.indices))
            row, code = np.divmod(code, max(1, len(words.dictionary)))
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), words.dictionary.take(pa.array(code)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed], ["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(split, "item long, item_id long, terms array<string>").filter(F.size("terms") > 0)


def posted(docs: DataFrame, asked: list[str]) -> DataFrame:
    """Rows (shard, term, places, tf) of the asked terms and one row with term -1 per shard that
    holds the ids and lengths of its documents; both over the documents with any term."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(asked)  # at most about VOCABULARY strings
    classes = byte_classes([*LETTERS, *DIGITS])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(shared.value)}
        shard = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in pieces_of(batch, SHARD_BYTES, column=1, most_rows=SHARD_ROWS):
                yield _post(part, classes, known, shard)
                shard += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(post, POSTED)


def _post(part: pa.RecordBatch, classes: np.ndarray, known: dict[str, int], shard: int) -> pa.RecordBatch:
    words, row = terms(part.column(1), classes)
    lengths = np.bincount(row, minlength=part.num_rows)
    some = np.flatnonzero(lengths)
    place = np.cumsum(lengths > 0) - 1
    names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    asked = np.fromiter((known.get(w, -1) for w in names), np.int64, len(names))
    term = asked[np.asarray(words.indices)] if len(names) else np.zeros(0, np.int64)
    hit = term >= 0
    key, tf = np.unique(term[hit] * (len(some) + 1) + place[row[hit]], return_counts=True)
    term, at = np.divmod(key, len(some) + 1)
    each, first = np.unique(term, return_index=True)
    offsets = np.concatenate([first, [len(key), len(key)]]).astype(np.int32)
    own = np.concatenate([np.zeros(len(each) + 1), [len(some)]]).astype(np.int32)
    ids = pc.fill_null(part.column(0), NO_ID).take(pa.array(some))
    as_list = lambda bounds, values: pa.ListArray.from_arrays(pa.array(bounds), values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(each) + 1, shard)), pa.array(np.append(each, HEAD).astype(np.int32)),
            as_list(offsets, pa.array(at.astype(np.int32))), as_list(offsets, pa.array(tf.astype(np.int64))),
            as_list(own, ids), as_list(own, pa.array(lengths[some].astype(np.int64))),
        ],
        ["shard", "term", "places", "tf", "ids", "lengths"],
    )


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """(1e9 tf) div (1000 tf + 8 m); lengths whose products leave 2^63 go by Python integers."""
    if len(length) and 90 * int(length.max()) * n >= 1 << 63:
        m = np.array([10 + 90 * int(x) * n // total for x in length], np.int64)
    else:
        m = 10 + 90 * length * n // total
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def add_owner(asked: dict, later: dict, postings: pd.DataFrame, carried: pd.DataFrame, lengths: np.ndarray, k: int, n: int, total: int):
    """One owner's contributions added to a bundle's accumulators of one shard.

    asked: {item: [(term, w), ..]} of this owner; later: {item: most that later owners can add}.
    Yields (item, places, scores) of the places that can still be among the k best."""
    by_term = {t: (p, f) for t, p, f in zip(postings["term"], postings["places"], postings["tf"])}
    before = {i: (p, s) for i, p, s in zip(carried["item"], carried["places"], carried["scores"])}
    impact: dict[int, np.ndarray] = {}
    for item in sorted({*before, *asked}):
        score = np.zeros(len(lengths), np.int64)
        if item in before:
            score[before[item][0]] = before[item][1]
        for term, w in asked.get(item, ()):
            if term in by_term:
                places, tf = by_term[term]
                if term not in impact:
                    impact[term] = impacts(np.asarray(tf), lengths[places], n, total)
                score[places] += w * impact[term]
        places = np.flatnonzero(score)
        if len(places) > k:
            kth = np.partition(score[places], -k)[-k]
            places = places[score[places] + later.get(item, 0) >= kth]
        if len(places):
            yield item, places.astype(np.int32), score[places]


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, owners: tuple = OWNERS, bundle: int = BUNDLE, vocabulary: int = VOCABULARY
) -> DataFrame:
    """item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    listed = written(item_terms(items), "items")
    asked = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    searches = -(-asked // vocabulary)
    found = spark.createDataFrame([], FOUND)
    for i in range(searches):
        mine = listed.filter(F.pmod(F.xxhash64("item"), F.lit(searches)) == i)
        found = found.unionByName(_search(docs, mine, k, owners, bundle))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, items: DataFrame, k: int, owners: tuple, bundle: int) -> DataFrame:
    """item, doc_id, score: the k best of each shard, from one bounded set of items."""
    spark = docs.sparkSession
    wanted = items.orderBy("item").toPandas()  # about VOCABULARY terms at most
    asked = sorted({t for ts in wanted["terms"] for t in ts})
    posts = written(posted(docs, asked), "postings")
    heads = posts.filter(F.col("term") == HEAD)
    n, total = heads.agg(F.sum(F.size("ids")), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)"))).first()
    held = posts.filter(F.col("term") != HEAD).groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    df = np.zeros(len(asked), np.int64)
    for r in held.toLocalIterator():  # one number per asked term
        df[r["term"]] = r["df"]
    if not n:
        return spark.createDataFrame([], FOUND)
    w, owner = weights(df, n), np.searchsorted(np.array(owners) * n, df)
    number = {t: i for i, t in enumerate(asked)}
    plans: list[dict] = [{} for _ in range(len(owners) + 1)]  # by stage: {bundle: ({item: [(term, w)]}, {item: later})}
    rows = set()
    for at, (item, words) in enumerate(zip(wanted["item"].tolist(), wanted["terms"])):
        own = [number[t] for t in words]
        for stage, plan in enumerate(plans):
            part, later = plan.setdefault(at // bundle, ({}, {}))
            part[item] = [(t, int(w[t])) for t in own if owner[t] == stage]
            later[item] = MOST_IMPACT * sum(int(w[t]) for t in own if owner[t] > stage)
        rows |= {(at // bundle, t, int(owner[t])) for t in own}
    rows |= {(b, HEAD, stage) for b in plans[0] for stage in range(len(plans))}
    asks = spark.createDataFrame(pd.DataFrame(sorted(rows), columns=["bundle", "term", "owner"]), "bundle long, term int, owner int")
    shared = spark.sparkContext.broadcast(plans)

    carried = spark.createDataFrame([], CARRIED)
    for stage in range(len(plans)):
        # a row per bundle and term at most: bounded like the asked terms
        mine = posts.join(F.broadcast(asks.filter(F.col("owner") == stage).drop("owner")), "term")
        last = stage == len(plans) - 1
        step = _stage_function(shared, stage, k, n, total, last)
        carried = mine.groupBy("bundle", "shard").cogroup(carried.groupBy("bundle", "shard")).applyInPandas(step, FOUND if last else CARRIED)
    return carried.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def _stage_function(shared, stage: int, k: int, n: int, total: int, last: bool):
    def step(key, postings: pd.DataFrame, carried: pd.DataFrame) -> pd.DataFrame:
        head = postings[postings["term"] == HEAD].iloc[0]
        asked, later = shared.value[stage][key[0]]
        lengths, ids = np.asarray(head["lengths"]), np.asarray(head["ids"])
        found = list(add_owner(asked, later, postings[postings["term"] != HEAD], carried, lengths, k, n, total))
        if not last:
            item, places, scores = map(list, zip(*found)) if found else ([], [], [])
            out = pd.DataFrame({"item": np.array(item, np.int64), "places": pd.Series(places, dtype=object), "scores": pd.Series(scores, dtype=object)})
            return out.assign(bundle=key[0], shard=key[1])
        best = []
        for item, places, score in found:
            order = np.lexsort((ids[places], -score))[:k]
            best.append(pd.DataFrame({"item": item, "doc_id": ids[places[order]], "score": score[order]}))
        return pd.concat(best) if best else pd.DataFrame({"item": [], "doc_id": [], "score": []}, dtype=np.int64)

    return step
