"""How far the word shares of each source lie from those of the other sources of its language.

Counts per (lang, source, term) become segment trees over term ids. Ids are dealt so that terms
of like document frequency share a block of about BLOCK ids; a block's subtree of one source is
built from its counts, equal subtrees (of any source, at any place of the block) are one node
(hash-consing by integer ids of distinct (left, right) pairs, level by level), and two sources
are compared by walking both trees at once. A walk never prices a pair of nodes twice: equal
(node, node) pairs of two sources are merged at each level and carry how often they occur; pairs
of nodes whose leaves are all alike are priced without going down. Blocks are Spark groups, the
top of the trees is a sum over blocks, and languages with many sources are cut into tiles of
sources, so that no task holds more than two tiles of one block.

Shares and prices are integers: p = 1 + floor(SCALE * (count + 2) / (N + 2 V)) and
f(p, q) = floor((p - q)^2 / (p + q)), both below 2^63 for any counts (products beyond 2^63 are
taken as Python integers or decimals).

Rows are counted inside tasks per slice of text and summed by Spark before the shuffle; a hot
source or term is one row per task.

Defined cases: null text, lang and source are ''; a row is a document, repeated or null doc_id
included; groups without any kept term still take part (count 0 everywhere); V = 0 gives pairs
of value 0 and no terms; an empty table gives no rows; ties are ordered by item in UTF-8 order;
very long texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprintlens.llm.byte_terms import LETTERS, byte_classes, terms
from sprintlens.llm.common import written
from sprintlens.llm.word_pieces import pieces_of

SCALE = 1_000_000_000
LEAST_DOCS = 10
BLOCK = 1024
TILE = 64
EXACT_COUNT = 9_000_000_000  # SCALE * (count + 2) stays below 2^63
COUNTS = "lang string, source string, term string, n long, docs long"
PAIRS = "lang string, a string, b string, value long"


def group_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it); a row with term null per
    group, so that groups without terms occur."""
    classes = byte_classes(LETTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, 16 << 20, column=2):
                yield _slice_counts(part, classes)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(text("lang"), text("source"), text("text")).mapInArrow(count, COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _slice_counts(part: pa.RecordBatch, classes: np.ndarray) -> pa.RecordBatch:
    words, row = terms(part.column(2), classes)
    groups = pa.StructArray.from_arrays([part.column(0), part.column(1)], ["lang", "source"]).to_pandas()
    group, named = pd.factorize(pd.Series([(g["lang"], g["source"]) for g in groups]))
    size = max(1, len(words.dictionary))
    code = np.asarray(words.indices).astype(np.int64)
    in_doc, tf = np.unique(row * size + code, return_counts=True)
    key, at = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    n = np.bincount(at, tf, len(key)).astype(np.int64)
    held = np.bincount(at, minlength=len(key)).astype(np.int64)
    which = np.concatenate([key // size, np.arange(len(named))])
    lang, source = (pa.array([x[i] for x in named], pa.string()).take(pa.array(which)) for i in (0, 1))
    term = pa.concat_arrays([words.dictionary.take(pa.array(key % size)), pa.nulls(len(named), pa.string())])
    zero = np.zeros(len(named), np.int64)
    return pa.RecordBatch.from_arrays(
        [lang, source, term, pa.array(np.concatenate([n, zero])), pa.array(np.concatenate([held, zero]))],
        ["lang", "source", "term", "n", "docs"],
    )


def kept_counts(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Rows of kept terms with lang_n and lang_docs, over all sources of the language."""
    of_term = Window.partitionBy("lang", "term")  # a row per source of the term
    both = counts.filter("term IS NOT NULL").withColumns(
        {"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)}
    )
    return both.filter(F.col("lang_docs") >= least)


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of each count, exact."""
    low = total + 2 * kept
    if len(count) and int(count.max()) > EXACT_COUNT:
        return np.array([1 + SCALE * (int(c) + 2) // low for c in count], np.int64)
    return 1 + SCALE * (count + 2) // low


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed segment trees of several sources over one block of ids.

    counts: sources x ids. nodes[l] holds the node of each source and place at level l (leaves
    first); left[l], right[l] the children of each distinct node of level l + 1; same[l] the leaf
    that every place below a node has, or -1."""

    def __init__(self, counts: np.ndarray):
        ids = counts.shape[1]
        width = 1 << max(0, int(ids - 1).bit_length())
        padded = np.full((len(counts), width), -1, np.int64)  # places past the last id cost nothing
        padded[:, :ids] = counts
        self.leaves, at = np.unique(padded, return_inverse=True)
        level = at.reshape(padded.shape)
        self.left, self.right, self.same = [], [], [np.arange(len(self.leaves))]
        while level.shape[1] > 1:
            base = int(level.max()) + 1
            key, at = np.unique(level[:, ::2] * base + level[:, 1::2], return_inverse=True)
            left, right = key // base, key % base
            below = self.same[-1]
            self.left.append(left)
            self.right.append(right)
            self.same.append(np.where(below[left] == below[right], below[left], -1))
            level = at.reshape(len(counts), -1)
        self.roots = level[:, 0]


def distances(forest: Forest, other: Forest, a: np.ndarray, b: np.ndarray, p_of, q_of) -> np.ndarray:
    """Summed price of each pair (a[i] of forest, b[i] of other) by one walk over both trees.

    p_of(source rows, leaf values) gives shares; both forests have the same height."""
    value = np.zeros(len(a), np.int64)
    pair, x, y = np.arange(len(a)), forest.roots[a], other.roots[b]
    times = np.ones(len(a), np.int64)
    for level in range(len(forest.left), -1, -1):
        alike = (forest.same[level][x] >= 0) & (other.same[level][y] >= 0)
        u, v = forest.leaves[forest.same[level][x[alike]]], other.leaves[other.same[level][y[alike]]]
        who, real = pair[alike], u >= 0
        paid = price(p_of(a[who[real]], u[real]), q_of(b[who[real]], v[real])) * times[alike][real] << level
        np.add.at(value, who[real], paid)
        if level == 0 or alike.all():
            break
        pair, x, y, times = pair[~alike], x[~alike], y[~alike], times[~alike]
        x = np.concatenate([forest.left[level - 1][x], forest.right[level - 1][x]])
        y = np.concatenate([other.left[level - 1][y], other.right[level - 1][y]])
        pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
        wide, high = int(x.max()) + 1, int(y.max()) + 1
        key, at = np.unique((pair * wide + x) * high + y, return_inverse=True)
        times = np.bincount(at, times, len(key)).astype(np.int64)
        pair, x, y = key // (wide * high), key // high % wide, key % high
    return value


def _dense(rows: pd.DataFrame, ids: dict, sources: list, width: int) -> np.ndarray:
    at = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(sources), width), np.int64)  # terms of other tiles only are 0 here
    mine = rows[rows["source"].isin(at)]
    counts[mine["source"].map(at).to_numpy(int), mine["term"].map(ids).to_numpy(int)] = mine["n"].to_numpy()
    return counts


def _table_of(sources: list, totals: np.ndarray, kept: int, leaves: np.ndarray):
    """Shares of every (source, leaf value), looked up by position."""
    real = np.maximum(leaves, 0)
    table = np.stack([shares(real, int(n), kept) for n in totals]) if len(sources) else np.zeros((0, len(leaves)), np.int64)
    return lambda row, value: table[row, np.searchsorted(leaves, value)]


def _block_distances(rows: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
    """Of one block and pair of tiles: the summed price of each pair of sources."""
    if sides.empty:  # a tile that no source fell into
        return _pair_rows("", [], [], np.zeros(0, np.int64))
    side = sides.iloc[0]
    kept, lang = int(side["kept"]), side["lang"]
    left, right = ([g["source"] for g in side[k]] for k in ("left", "right"))
    totals = [np.array([g["total"] for g in side[k]], np.int64) for k in ("left", "right")]
    ids = {t: i for i, t in enumerate(sorted(set(rows["term"])))}
    width = int(side["terms"])
    one = Forest(_dense(rows, ids, left, width))
    two = one if side["t"] == side["u"] else Forest(_dense(rows, ids, right, width))
    a, b = (np.triu_indices(len(left), 1) if two is one else tuple(x.ravel() for x in np.indices((len(left), len(right)))))
    value = distances(one, two, a, b, _table_of(left, totals[0], kept, one.leaves), _table_of(right, totals[1], kept, two.leaves))
    return _pair_rows(lang, [left[i] for i in a], [right[i] for i in b], value)


def _pair_rows(lang: str, a: list, b: list, value: np.ndarray) -> pd.DataFrame:
    text = lambda x: pd.Series(x, dtype=object)
    return pd.DataFrame({"lang": text([lang] * len(a)), "a": text(a), "b": text(b), "value": value})


def pair_distances(kept: DataFrame, groups: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, a, b, value of each unordered pair of a language's sources, over all kept terms.

    groups: lang, source, total, kept."""
    spread = lambda c, n: F.pmod(F.xxhash64(c), n)
    # ids: terms of like document frequency lie in the same blocks
    banded = kept.withColumn("band", F.floor(F.log2("lang_docs")).cast("int"))
    sizes = written(banded.groupBy("lang", "band").agg(F.ceil(F.count_distinct("term") / F.lit(block)).alias("blocks")), "blocks")
    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).alias("tiles"))
    tiled = written(groups.join(tiles, "lang").withColumn("tile", spread("source", F.col("tiles")).cast("int")), "tiles")
    members = tiled.groupBy("lang", "tile", "kept").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("members"))
    pairs = (
        members.alias("l").join(members.alias("r"), F.expr("l.lang = r.lang AND l.tile <= r.tile"))
        .select("l.lang", "l.kept", F.col("l.tile").alias("t"), F.col("r.tile").alias("u"), F.col("l.members").alias("left"), F.col("r.members").alias("right"))
    )
    dealt = banded.join(sizes, ["lang", "band"]).withColumn("block", spread("term", F.col("blocks")).cast("int"))
    dealt = written(dealt.select("lang", "band", "block", "source", "term", "n"), "dealt")
    blocks = written(dealt.groupBy("lang", "band", "block").agg(F.count_distinct("term").alias("terms")), "block-sizes")
    sides = pairs.join(blocks, "lang")
    placed = (
        dealt.join(tiled.select("lang", "source", "tile", "tiles"), ["lang", "source"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1)))
        .select("lang", "band", "block", F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("u"), "source", "term", "n")
    )
    key = ["lang", "band", "block", "t", "u"]
    parts = placed.groupBy(*key).cogroup(sides.groupBy(*key)).applyInPandas(_block_distances, PAIRS)
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _share(count, total, kept):
    """p as a column, exact for any count."""
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)"), (total + 2 * kept).cast("decimal(20,0)"))).cast("long")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = 10, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = written(group_counts(docs), "group-counts")
    kept = written(kept_counts(counts, least), "kept-counts")
    per_lang = kept.groupBy("lang").agg(F.count_distinct("term").alias("kept"), F.sum("n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(
        counts.filter("term IS NULL").select("lang", "source").distinct()
        .join(of_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept", "lang_total")]),
        "groups",
    )
    found = pair_distances(kept, groups.select("lang", "source", "total", "kept"), block, tile)
    both = found.unionByName(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    none = (
        groups.filter("kept = 0").alias("l").join(groups.alias("r"), F.expr("l.lang = r.lang AND l.source <> r.source"))
        .select("l.lang", F.col("l.source").alias("a"), F.col("r.source").alias("b"), F.lit(0).cast("long").alias("value"))
    )
    order = lambda: Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.unionByName(none).select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order()))
    p, q = F.col("p"), F.col("q")
    words = (
        kept.join(groups, ["lang", "source"])
        .withColumns({"p": _share(F.col("n"), F.col("total"), F.col("kept")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))})
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
        .withColumn("rank", F.row_number().over(order()))
        .filter(F.col("rank") <= top)
    )
    return pairs.unionByName(words)
