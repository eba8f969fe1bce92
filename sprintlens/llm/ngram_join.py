"""Exact n-gram Jaccard join by pigeonhole on a partition of the shingle universe.

Sets of distinct 5-word shingles (64-bit hashes) with Jaccard >= 3/4 differ in at most
H = floor((n + l) / 7) shingles. Sizes fall into bands that double; each band cuts the universe
of hashes into m segments (small bands: every shingle is a segment). Cutting a set there gives
its subsets; H differences touch at most H segments, so of any H + 1 non-empty subsets of a set
one is found unchanged in every set similar to it (value 1), and if one-deletion neighbourhoods
are compared as well, a segment with a single difference still matches (value 2). A set is
complete when the segments searched for it have values of H + 1 together. A pair needs one
complete set. A set whose partners reach into the next band is indexed in that band too.

Allocation by cost, cheapest first:
1. Every set searches its subsets that at most `common` sets share (unshared ones cost nothing).
   Candidates must share as many subsets as the bound leaves over, not just one.
2. Sets left incomplete (members of large families, sets made of common passages) compare
   a few smallest subsets in stars, which unites most families. Blocks of sets, dealt by the
   components so far, then send each subset once per component; those that several components
   share are compared in stars again, as far as the parities of their shingles differ in no more
   bits than a pair may differ in shingles. Where all sharing sets are one component, nothing is
   left to find and the subset is free; of the others a block gets back the cost.
3. Sets still incomplete use one-deletion neighbourhoods, again with stars and free ones, of the
   signatures that concern a set which they can complete (a costly subset stays costly).
4. Sets that even so fall short buy subsets in the order of their cost (number of components
   that share them in step 2, the same for every set) until their value is H + 1; sets of different
   components are compared once, at the first subset that both bought, where from there on both
   have as many subsets left as a pair of their sizes must share, and the parities of their
   shingles differ in no more bits than the pair may differ in shingles. Subsets that only sets of
   one component bought are left out before.
Candidates are verified by exact intersection. Equal sets are one set throughout.

Work per task is bounded: signatures travel in packed blocks by hash bucket (as many as
spark.sql.shuffle.partitions), a signature frequent within a map task sends `common` + 1
entries, and verification blocks hold a bounded number of left sets. A text asked for is hashed
once more and its set goes straight to the blocks that verify it; steps 2 to 4 read the sets
left incomplete only.

Defined cases: words and sets as the contract says (a text of one to four words is one
shingle); null or empty text has an empty set, linked with nothing; repeated rows are equal
documents; null doc_id takes part and is never a component's id unless all of its ids are null;
an empty table gives no rows; other columns are not read. Equality of sets and shingles is
equality of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.byte_text import ByteText, mixed
from sprintlens.llm.common import memory_returned, released, shuffles_released, tucked, written
from sprintlens.llm.components import components
from sprintlens.llm.word_pieces import pieces_of

WIDTH = 5
#: Subsets that more sets share are not paired at once.
COMMON = 32
#: Left sets of a verification block, about.
BLOCK_SETS = 256
#: Candidates among no more sets than so many blocks hold are dealt without components.
FEW_BLOCKS = 16
#: Texts are hashed in small slices, and indexed in larger ones.
HASH_BYTES = 512 << 10
SLICE_BYTES = 2 << 20
#: Bands whose sizes stay below this take every shingle as a segment.
SINGLE = 64
#: Bits of the map of wanted keys: for each key, and at most.
SLOTS_PER_KEY = 64
MOST_SLOTS = 1 << 25
#: Subsets of a set by which families are united first.
LEAST_SUBSETS = 4
#: Shingles of the sets that are cut into subsets together, about.
SLICE_SHINGLES = 1 << 20
#: Bits of the parities that sets in doubt are compared by before they are verified.
PARITY_BITS = 512
U = np.uint64


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another; and their number."""
    t = ByteText(texts)
    starts, ends = t.words()
    doc, h = t.document_of(starts), t.hashes(starts, ends)
    words = np.bincount(doc, minlength=t.n)
    factor = mixed(np.arange(1, width + 1, dtype=U))

    def combined(at: np.ndarray, length: int) -> np.ndarray:
        total = np.full(len(at), length, U)
        for j in range(length):
            total += h[at + j] * (factor[j] | U(1))
        return mixed(total)

    first = np.concatenate([[0], np.cumsum(words)[:-1]]) if t.n else np.zeros(0, np.int64)
    at = np.arange(len(h))
    whole = at[at + width <= np.repeat(first + words, words)]
    found, owner = [combined(whole, width)], [doc[whole]]
    for length in range(1, width):
        short = np.flatnonzero(words == length)
        found.append(combined(first[short], length))
        owner.append(short)
    x, owner = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    once = np.ones(len(x), bool)
    once[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    return x[once], np.bincount(owner[once], minlength=t.n)


def slice_sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """shingle_sets of a batch's first column, hashed piece by piece."""
    found = [shingle_sets(piece.column(0)) for piece in pieces_of(part, HASH_BYTES)]
    return np.concatenate([x for x, _ in found]), np.concatenate([c for _, c in found])


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, U)


def set_ids(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set (0 for the empty one)."""
    ids = np.zeros(len(counts), U)
    some = counts > 0
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[some]
    ids[some] = mixed(run_sums(mixed(x), starts) + counts[some].astype(U))
    return ids.view(np.int64)


def band(n: np.ndarray) -> np.ndarray:
    return np.maximum(np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) - 2, 0)


def reaches_on(n: np.ndarray) -> np.ndarray:
    """Whether a set can be similar to one of the next band."""
    return 4 * n >= 3 * (8 << band(n))


def most_differences(n: np.ndarray, which: np.ndarray | int) -> np.ndarray:
    """H towards the largest partner in the set's own band (0) or the next (1)."""
    largest = 4 * n // 3
    return (n + np.where(np.asarray(which) == 0, np.minimum(largest, (8 << band(n)) - 1), largest)) // 7


def segments(x: np.ndarray, counts: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty segments of each set: start in x, owner (row of counts), segment number, scheme."""
    scheme = band(counts) + which
    hi = 8 << scheme
    m = np.where(hi <= SINGLE, 0, (34 * hi) // 100 + 5).astype(U)
    owner = np.repeat(np.arange(len(counts)), counts)
    per = m[owner]
    seg = np.where(per == 0, np.arange(len(x), dtype=np.int64).view(U), ((x >> U(32)) * per) >> U(32))
    new = np.ones(len(x), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    number = np.where(per[starts] == 0, U(0), seg[starts])
    return starts, owner[starts], number, scheme[owner[starts]]


def subset_signatures(x: np.ndarray, starts: np.ndarray, number: np.ndarray, scheme: np.ndarray) -> np.ndarray:
    return mixed(run_sums(mixed(x), starts) + _place(number, scheme))


def _place(number: np.ndarray, scheme: np.ndarray) -> np.ndarray:
    return mixed(number * U(64) + scheme.astype(U) + U(1)) | U(1)


def _take(x: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[np.repeat(keep, counts)], counts[keep]


#: A set before its signatures in a block: n is negative for subsets in the next band; times is
#: the number of signatures that follow (a set with more of them stands there again).
HEAD = np.dtype([("id", np.int64), ("n", np.int32), ("times", np.uint8)])


def _pack(sig: np.ndarray) -> np.ndarray:
    """The lowest five bytes of each signature; the bucket tells the others apart."""
    return np.ascontiguousarray(sig).view(np.uint8).reshape(-1, 8)[:, :5]


def _unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    sig = np.zeros((len(raw), 8), np.uint8)
    sig[:, :5] = raw
    return sig.view(U)[:, 0]


def _index(buckets: int, common: int):
    """Texts -> blocks of subset signatures: (bucket, sets, entries, hot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in pieces_of(batch, SLICE_BYTES, most_rows=30_000):
                x, counts = slice_sets(part)
                ids = set_ids(x, counts)
                keep = counts > 0
                keep[np.setdiff1d(np.arange(len(ids)), np.unique(ids, return_index=True)[1])] = False
                keep &= np.array([i not in seen for i in ids.tolist()], bool)
                if len(seen) > 200_000:  # copies that are not remembered only cost time
                    seen.clear()
                seen.update(ids[keep].tolist())
                x, counts = _take(x, counts, keep)
                ids = ids[keep]
                if not len(ids):
                    continue
                sigs, index, sets = [], [], []
                for which in (0, 1):
                    use = np.ones(len(ids), bool) if which == 0 else reaches_on(counts)
                    xs, cs = _take(x, counts, use)
                    starts, owner, number, scheme = segments(xs, cs, which)
                    sigs.append(subset_signatures(xs, starts, number, scheme))
                    index.append(owner + sum(map(len, sets)))
                    row = np.zeros(len(cs), HEAD)
                    row["id"], row["n"] = ids[use], -cs if which else cs
                    sets.append(row)
                sig, index, sets = np.concatenate(sigs), np.concatenate(index), np.concatenate(sets)
                order = np.argsort(sig)
                sig, index = sig[order], index[order]
                rank = np.arange(len(sig)) - np.searchsorted(sig, sig, "left")
                over = rank > common
                hot = np.bincount(index[over], minlength=len(sets))
                sig, index = sig[~over], index[~over]
                bucket = ((sig >> U(40)) % U(buckets)).astype(np.int64)
                order = np.lexsort((index, bucket))
                sig, index, bucket = sig[order], index[order], bucket[order]
                new = np.ones(len(sig), bool)
                new[1:] = (index[1:] != index[:-1]) | (bucket[1:] != bucket[:-1])
                start = np.flatnonzero(new)
                length = np.diff(np.append(start, len(sig)))
                new |= (np.arange(len(sig)) - np.repeat(start, length)) % 255 == 0
                start = np.flatnonzero(new)
                heads, packed = sets[index[start]], _pack(sig)
                heads["times"] = np.diff(np.append(start, len(sig)))
                bounds = np.searchsorted(bucket, np.arange(buckets + 1))
                first = np.searchsorted(bucket[start], np.arange(buckets + 1))
                rows = [
                    (b, heads[first[b] : first[b + 1]].tobytes(), packed[bounds[b] : bounds[b + 1]].tobytes(), None)
                    for b in range(buckets) if bounds[b] < bounds[b + 1]
                ]
                many = np.flatnonzero(hot)
                if len(many):
                    rows.append((int(ids[0] % buckets), sets[many].tobytes(), b"", hot[many].astype(np.int32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                    ["bucket", "sets", "entries", "hot"],
                )

    return run


FOUND = "a long, b long, na int, nb int, shared int"


def _pairs_of_runs(sig: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted sig: index pairs inside runs of 2..common, and a mask of entries in longer runs."""
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(sig)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(lengths[(lengths > 1) & (lengths <= common)]):
        i, j = np.triu_indices(int(n), 1)
        at = starts[lengths == n][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    return np.concatenate(left), np.concatenate(right), np.repeat(lengths > common, lengths)


def _match(common: int):
    """Blocks of one bucket -> pairs with the number of subsets they share, and (b = -1) per set
    and band the number of its subsets that are too common."""

    def run(table: pa.Table) -> pa.Table:
        memory_returned()  # what earlier groups left
        sigs, rows, sets, hot_rows, hot_counts, base = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, HEAD)], [np.zeros(0, HEAD)], [np.zeros(0, np.int32)], 0
        for s, e, h in zip(table["sets"].to_pylist(), table["entries"].to_pylist(), table["hot"].to_pylist()):
            members = np.frombuffer(s, HEAD)
            if h is not None:
                hot_rows.append(members)
                hot_counts.append(np.frombuffer(h, np.int32))
                continue
            sigs.append(_unpack(e))
            rows.append(np.repeat(np.arange(base, base + len(members)), members["times"]))
            sets.append(members)
            base += len(members)
        sig, row, sets = np.concatenate(sigs), np.concatenate(rows), np.concatenate(sets)
        order = np.argsort(sig)
        sig, row = sig[order], row[order]
        again = np.zeros(len(sig), bool)
        again[1:] = sig[1:] == sig[:-1]
        shared = again.copy()
        shared[:-1] |= again[1:]
        sig, row = sig[shared], row[shared]
        order = np.lexsort((sets["id"][row], sig))  # a set met in several tasks counts once
        sig, row = sig[order], row[order]
        once = np.ones(len(sig), bool)
        once[1:] = (sig[1:] != sig[:-1]) | (sets["id"][row[1:]] != sets["id"][row[:-1]])
        sig, row = sig[once], row[once]
        i, j, frequent = _pairs_of_runs(sig, common)
        a, b = row[i], row[j]
        n = np.abs(sets["n"])
        na, nb = n[a].astype(np.int64), n[b].astype(np.int64)
        fit = 4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)
        a, b = a[fit], b[fit]
        ida, idb = sets["id"][a], sets["id"][b]
        order = np.lexsort((idb, ida))
        ida, idb, a, b = ida[order], idb[order], a[order], b[order]
        new = np.ones(len(ida), bool)
        new[1:] = (ida[1:] != ida[:-1]) | (idb[1:] != idb[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(ida)))
        hot = np.concatenate([sets[row[frequent]], *hot_rows])
        count = np.concatenate([np.ones(int(frequent.sum()), np.int32), *hot_counts])
        order = np.lexsort((hot["n"] < 0, hot["id"]))
        hot, count = hot[order], count[order].astype(np.int64)
        new = np.ones(len(hot), bool)
        new[1:] = (hot["id"][1:] != hot["id"][:-1]) | ((hot["n"][1:] < 0) != (hot["n"][:-1] < 0))
        key = hot[new]
        total = np.add.reduceat(count, np.flatnonzero(new)) if len(hot) else count
        return pa.table({
            "a": np.concatenate([ida[at], key["id"]]), "b": np.concatenate([idb[at], np.full(len(key), -1)]),
            "na": np.concatenate([n[a[at]], key["n"] < 0]).astype(np.int32),
            "nb": np.concatenate([n[b[at]], np.full(len(key), -1, np.int32)]).astype(np.int32),
            "shared": np.concatenate([times, total]).astype(np.int32),
        })

    return run


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: doc_id, set_id, n and the non-empty segments in its own band and the next."""
    for batch in batches:
        for part in pieces_of(batch, SLICE_BYTES, most_rows=30_000):
            x, counts = slice_sets(part)
            used = []
            for which in (0, 1):
                use = (counts > 0) & (reaches_on(counts) if which else True)
                xs, cs = _take(x, counts, use)
                e = np.full(len(counts), -1, np.int64)
                e[use] = np.bincount(segments(xs, cs, which)[1], minlength=len(cs))
                used.append(e)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), *[pa.array(c) for c in (set_ids(x, counts), counts.astype(np.int64), *used)]], ["doc_id", "set_id", "n", "e0", "e1"]
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces_of(batch, SLICE_BYTES, most_rows=30_000):
            x, counts = slice_sets(part)
            raw, bounds = x.tobytes(), np.concatenate([[0], np.cumsum(counts)]) * 8
            blobs = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(set_ids(x, counts)), pa.array(blobs, pa.binary())], ["set_id", "shingles"])


def _verify(pairs: pa.Table, members: pa.Table) -> pa.Table:
    memory_returned()
    ids = members["m_id"].to_numpy()
    blobs = members["shingles"]
    place = {i: k for k, i in enumerate(ids.tolist())}
    cache: dict[int, np.ndarray] = {}

    def get(i: int) -> np.ndarray:
        if i not in cache:
            cache[i] = np.frombuffer(blobs[place[i]].as_py(), U)
        return cache[i]

    a, b = (pairs[c].to_numpy() for c in ("a", "b"))
    ok = np.zeros(len(a), bool)
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        if i in place and j in place:
            x, y = get(i), get(j)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok[k] = 4 * both >= 3 * (len(x) + len(y) - both)
    return pa.table({"a": pa.array(a[ok], pa.int64()), "b": pa.array(b[ok], pa.int64())})


def placed(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with the block they are verified in. Blocks follow the candidates'
    components, and a component with many sets is many blocks, by its left sets. Few sets, of which
    no block would get many copies, are dealt by their left sets alone."""
    pairs = written(pairs.select("a", "b").distinct(), "ngram-pairs")
    nodes = 2 * pairs.count()
    if nodes > FEW_BLOCKS * BLOCK_SETS:
        with shuffles_released(pairs.sparkSession):
            nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).agg(F.approx_count_distinct("id")).first()[0]
    if nodes <= FEW_BLOCKS * BLOCK_SETS:
        return pairs.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(max(1, -(-nodes // BLOCK_SETS)))))
    group = written(components(pairs, "a", "b"), "ngram-blocks")
    size = group.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    parts = F.ceil(F.col("size") / BLOCK_SETS)
    dealt = (
        pairs.join(group.select(F.col("node").alias("a"), "component"), "a")
        .join(size, "component")
        .select("a", "b", F.xxhash64("component", F.pmod(F.xxhash64("a"), parts)).alias("block"))
    )
    return written(dealt, "ngram-placed")


def members_of(pairs: DataFrame) -> DataFrame:
    """The sets (set_id) that each block verifies."""
    return pairs.select("block", F.col("a").alias("set_id")).unionByName(pairs.select("block", F.col("b").alias("set_id"))).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Pairs that are placed already come with sets that
    hold the blocks they go to."""
    if "blocks" in sets.columns:
        members = sets.select(F.explode("blocks").alias("block"), "set_id", "shingles")
    else:
        pairs = placed(pairs)
        members = members_of(pairs).join(sets, "set_id")
    members = members.select(F.col("block").alias("m_block"), F.col("set_id").alias("m_id"), "shingles")
    return written(pairs.groupBy("block").cogroup(members.groupBy("m_block")).applyInArrow(_verify, "a long, b long"), "ngram-links")


ENTRY = np.dtype([("id", np.int64), ("n", np.int32), ("which", np.int8), ("seg", np.int32), ("value", np.int8), ("component", np.int64), ("able", np.int8), ("block", np.int32)])
#: An entry that may meet a representative comes with its set's parities.
STAR = np.dtype([*((c, ENTRY[c]) for c in ENTRY.names), ("parity", U, PARITY_BITS // 64)])


def _parity(x: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits of a set: whether an odd number of its shingles falls on each. Bits in which
    two sets differ are at most the shingles in which they differ."""
    odd = np.bincount((x % U(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(U)


def _entries(table: pa.Table | pa.RecordBatch, deletions: bool, least: int | None = None, kind: np.dtype = ENTRY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures of the subsets (and one-deletion neighbourhoods) of sets left incomplete, with
    their entries, by slices of sets; with `least`, only so many of the smallest of each set."""
    lists = [np.frombuffer(s, U) for s in table["shingles"].to_pylist()]
    ids, which_of, component = (table[c].to_numpy() for c in ("set_id", "which", "component"))
    able = table["able"].to_numpy(zero_copy_only=False)
    upto = np.cumsum([len(x) for x in lists])
    bounds = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, SLICE_SHINGLES)), len(lists)))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        sigs, entries = [], []
        for which in (0, 1):
            rows = lo + np.flatnonzero(which_of[lo:hi] == which)
            if not len(rows):
                continue
            counts = np.array([len(lists[r]) for r in rows])
            x = np.concatenate([lists[r] for r in rows])
            starts, owner, number, scheme = segments(x, counts, which)
            length = np.diff(np.append(starts, len(x)))
            entry = np.zeros(len(starts), kind)
            if "parity" in kind.names:
                entry["parity"] = np.array([_parity(lists[r]) for r in rows])[owner]
            entry["id"], entry["component"], entry["n"], entry["which"] = ids[rows][owner], component[rows][owner], counts[owner], which
            entry["able"] = able[rows][owner]
            entry["seg"] = np.arange(len(starts)) - np.searchsorted(owner, owner, "left")
            entry["value"] = np.where(length > 1, 2, 1)
            total, place = run_sums(mixed(x), starts), _place(number, scheme)
            sig = mixed(total + place)
            if least is not None:
                order = np.lexsort((sig, owner))
                few = order[np.arange(len(order)) - np.searchsorted(owner, owner[order], "left") < least]
                sig, entry = sig[few], entry[few]
            sigs.append(sig)
            entries.append(entry)
            if deletions:
                of = np.repeat(np.arange(len(starts)), length)
                more = length[of] > 1
                sigs.append(mixed(total[of][more] - mixed(x)[more] + place[of][more]))
                entries.append(entry[of][more])
        yield np.concatenate(sigs), np.concatenate(entries)


PACKED = "bucket int, sig binary, entry binary"


def _by_bucket(sig: np.ndarray, entry: np.ndarray, buckets: int) -> pa.Table:
    bucket = ((sig >> U(40)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sig, entry, bucket = sig[order], entry[order], bucket[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(bucket))
    return pa.table({
        "bucket": pa.array(bucket[at].astype(np.int32)), "sig": pa.array([sig[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
        "entry": pa.array([entry[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
    })


def _least_subsets(buckets: int, least: int):
    """The smallest subsets of each set, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sig, entry in _entries(batch, False, least, STAR):
                yield from _by_bucket(sig, entry, buckets).to_batches()

    return run


def _block_index(buckets: int, deletions: bool, kind: np.dtype):
    """Signatures of a block of sets, packed by bucket: one entry for each signature and component
    of the block, so that what a family shares travels once per block."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        memory_returned()
        found = []
        for sig, entry in _entries(table, deletions, kind=kind):
            order = np.lexsort((-entry["able"], entry["component"], sig))
            sig, entry = sig[order], entry[order]
            once = np.ones(len(sig), bool)
            once[1:] = (sig[1:] != sig[:-1]) | (entry["component"][1:] != entry["component"][:-1])
            sig, entry = sig[once], entry[once]
            entry["block"] = key[0].as_py()
            found.append(_by_bucket(sig, entry, buckets))
        return pa.concat_tables(found)

    return run


def _shared(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a bucket whose signatures several components share, at least one of their sets
    being able to gain by it: signatures, entries and the places where each signature starts."""
    sig = np.concatenate([np.frombuffer(s, U) for s in table["sig"].to_pylist()])
    entry = np.concatenate([np.frombuffer(s, kind) for s in table["entry"].to_pylist()])
    order = np.lexsort((mixed(entry["id"].view(U) + (sig & U(3))), sig))
    sig, entry = sig[order], entry[order]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    lengths = np.diff(np.append(starts, len(sig)))
    wanted = np.maximum.reduceat(entry["component"], starts) != np.minimum.reduceat(entry["component"], starts)
    wanted &= np.maximum.reduceat(entry["able"], starts) > 0
    keep = np.repeat(wanted, lengths)
    return sig[keep], entry[keep], np.cumsum(lengths[wanted]) - lengths[wanted]


def _stars(table: pa.Table) -> pa.Table:
    """Of a bucket: the sets of each shared signature with one of four representatives, as far as
    their sizes and parities allow and no link joins them yet."""
    memory_returned()
    sig, entry, starts = _shared(table, STAR)
    rep = np.repeat(entry[starts], np.diff(np.append(starts, len(sig))))
    n, rep_n = entry["n"].astype(np.int64), rep["n"].astype(np.int64)
    ok = (entry["component"] != rep["component"]) & (4 * np.minimum(n, rep_n) >= 3 * np.maximum(n, rep_n))
    ok[ok] = 7 * np.bitwise_count(entry["parity"][ok] ^ rep["parity"][ok]).sum(axis=1, dtype=np.int64) <= (n + rep_n)[ok]
    pairs = np.unique(np.stack([entry["id"][ok], rep["id"][ok]]), axis=1)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


#: A signature that several components share, and their number.
COST = np.dtype([("sig", np.uint64), ("cost", np.int64)])


def _costs(table: pa.Table) -> pa.Table:
    """Of a bucket: per block the signatures that several components share, with their number."""
    memory_returned()
    sig, entry, _ = _shared(table, ENTRY)
    order = np.lexsort((entry["component"], sig))
    sig, entry = sig[order], entry[order]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    new = np.ones(len(sig), np.int64)
    new[1:] = (sig[1:] != sig[:-1]) | (entry["component"][1:] != entry["component"][:-1])
    cost = np.zeros(len(sig), COST)
    cost["sig"] = sig
    cost["cost"] = np.repeat(run_sums(new, starts), np.diff(np.append(starts, len(sig))))
    order = np.lexsort((sig, entry["block"]))
    cost, block = cost[order], entry["block"][order]
    at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(block))
    return pa.table({"_block": pa.array(block[at], pa.int32()), "costs": pa.array([cost[i:j].tobytes() for i, j in zip(at, ends)], pa.binary())})


COSTLY = "set_id long, which int, n int, paid long, paid_most long, subsets array<struct<cost: long, sig: long>>"
COSTLY_ARROW = pa.schema([
    ("set_id", pa.int64()), ("which", pa.int32()), ("n", pa.int32()), ("paid", pa.int64()), ("paid_most", pa.int64()),
    ("subsets", pa.list_(pa.struct([("cost", pa.int64()), ("sig", pa.int64())]))),
])


def _costly_sets(deletions: bool):
    """Of a block of sets, one row per set: how many of its segments cost, their value, and (without
    deletions) its costly subsets in the order of their cost."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, costs: pa.Table) -> pa.Table:
        memory_returned()
        found = [COSTLY_ARROW.empty_table()]
        if table.num_rows and costs.num_rows:
            cost = np.unique(np.concatenate([np.frombuffer(c, COST) for c in costs["costs"].to_pylist()]))
            for sig, entry in _entries(table, deletions):
                at = np.minimum(np.searchsorted(cost["sig"], sig), len(cost) - 1)
                hit = cost["sig"][at] == sig
                if hit.any():
                    found.append(_per_set(sig[hit], entry[hit], cost["cost"][at[hit]], deletions))
        return pa.concat_tables(found)

    return run


def _per_set(sig: np.ndarray, entry: np.ndarray, cost: np.ndarray, deletions: bool) -> pa.Table:
    order = np.lexsort((sig.view(np.int64), cost, entry["which"], entry["id"]))
    sig, entry, cost = sig[order], entry[order], cost[order]
    new = lambda *columns: np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))
    starts = new(entry["id"], entry["which"])
    # segments count once, whatever number of their neighbourhoods cost
    by_seg = entry[np.lexsort((entry["seg"], entry["which"], entry["id"]))]
    segs = by_seg[new(by_seg["id"], by_seg["which"], by_seg["seg"])]
    at = new(segs["id"], segs["which"])
    head = entry[starts]
    upto = np.zeros(len(starts) + 1, np.int32) if deletions else np.append(starts, len(sig)).astype(np.int32)
    subsets = pa.StructArray.from_arrays([pa.array(cost[: upto[-1]]), pa.array(sig.view(np.int64)[: upto[-1]])], ["cost", "sig"])
    return pa.Table.from_arrays([
        pa.array(head["id"].copy()), pa.array(head["which"].astype(np.int32)), pa.array(head["n"].copy()),
        pa.array(np.diff(np.append(at, len(segs)))), pa.array(run_sums(segs["value"].astype(np.int64), at)),
        pa.ListArray.from_arrays(pa.array(upto), subsets),
    ], schema=COSTLY_ARROW)


def _similar_sizes(a: str, b: str):
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _bound(n, which):
    """H of most_differences as a column."""
    hi = 8 * F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(n)) - 2, F.lit(0)))
    largest = F.floor(4 * n / 3)
    return F.floor((n + F.when(which == 0, F.least(largest, hi - 1)).otherwise(largest)) / 7)


def _labelled(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows with the component of their set, as far as links are known."""
    joined = rows.join(known, F.col(key) == F.col("node"), "left")
    return joined.withColumn("component", F.coalesce("component", key)).drop("node")


def _costly(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Entries of signatures whose sets are in several components, with component and cost."""
    placed = written(_labelled(entries, known, "id"), "ngram-entries")  # read twice
    many = placed.groupBy("sig").agg(F.count_distinct("component").alias("cost")).filter("cost > 1")
    return placed.join(many, "sig")


def _blocks(left: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """Sets with their component, dealt to blocks of about BLOCK_SETS by component; a component
    with many sets is many blocks."""
    placed = _labelled(left, known, "set_id")
    parts = placed.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("parts"))
    dealt = F.pmod(F.xxhash64("component", F.pmod(F.xxhash64("set_id"), F.col("parts"))), F.lit(max(1, size // BLOCK_SETS)))
    return placed.join(parts, "component").select("set_id", "which", "shingles", "component", "able", dealt.cast("int").alias("block"))


def similar_components(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    described = written(texts.mapInArrow(released(_describe), "doc_id long, set_id long, n long, e0 long, e1 long"), "ngram-documents")
    classes = written(
        described.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_doc"), *[F.first(c).alias(c) for c in ("n", "e0", "e1")]), "ngram-classes"
    )
    blocks = texts.mapInArrow(released(_index(buckets, common)), "bucket int, sets binary, entries binary, hot binary")
    found = written(blocks.groupBy("bucket").applyInArrow(_match(common), FOUND), "ngram-found")

    # how many subsets of each set and band are too common to be searched at once
    hot = found.filter("b = -1").groupBy(F.col("a").alias("set_id"), F.col("na").alias("which")).agg(F.sum("shared").alias("hot"))
    bands = classes.select("set_id", "n", F.posexplode(F.array("e0", "e1")).alias("which", "e")).filter("e >= 0")
    state = written(
        bands.join(hot, ["set_id", "which"], "left").withColumn("cold", F.col("e") - F.coalesce("hot", F.lit(0))).drop("hot"), "ngram-state"
    )
    incomplete = written(state.filter(F.col("cold") <= _bound(F.col("n"), F.col("which"))), "ngram-incomplete")

    # candidates share every cold subset that the bound leaves over
    pairs = found.filter("b <> -1").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    tall = lambda n: F.greatest(F.floor(F.log2(n)).cast("int") - 2, F.lit(0))
    least = F.floor((F.col("na") + F.col("nb")) / 7)
    for side, n in (("a", "na"), ("b", "nb")):
        which = (tall(F.greatest("na", "nb")) > tall(F.col(n))).cast("int")
        pairs = pairs.withColumn("which", which).join(
            state.select(F.col("set_id").alias(side), "which", F.col("cold").alias(f"cold_{side}")), [side, "which"]
        ).drop("which")
    candidates = written(pairs.filter(F.col("shared") >= F.greatest(F.lit(1), F.col("cold_a") - least, F.col("cold_b") - least)).select("a", "b"), "ngram-candidates")

    # the blocks that verify a set travel with it, so that it is shuffled to them only
    pairs = placed(candidates)
    wanted = members_of(pairs).withColumns({"block": F.col("block").cast("long"), "again": F.lit(False)})
    wanted = wanted.unionByName(incomplete.select("set_id", F.lit(None).cast("long").alias("block"), F.lit(True).alias("again")))
    wanted = wanted.groupBy("set_id").agg(F.collect_list("block").alias("blocks"), F.max("again").alias("again"))
    wanted = written(classes.join(wanted, "set_id").select("set_id", F.xxhash64("first_doc").alias("key"), "blocks", "again"), "ngram-wanted")
    chosen = marked(texts, F.xxhash64("doc_id"), wanted).filter("_marked").select("text")
    hashed = chosen.mapInArrow(released(_sets), "set_id long, shingles binary").dropDuplicates(["set_id"])
    sets = written(hashed.join(wanted.drop("key"), "set_id"), "ngram-sets")
    links = verified(pairs, sets)
    sets = sets.filter("again").select("set_id", "shingles")  # those that later steps compare

    exact = known = None
    for deletions in (False, True):
        size = incomplete.count()
        if not size:
            break
        left = incomplete.join(sets, "set_id").select("set_id", F.col("which").cast("int"), "shingles", *(["able"] if deletions else [F.lit(True).alias("able")]))
        if known is None:  # families first: most of them share one of a few smallest subsets
            few = left.withColumn("component", F.col("set_id")).mapInArrow(released(_least_subsets(buckets, LEAST_SUBSETS)), PACKED)
            links = links.unionByName(verified(few.groupBy("bucket").applyInArrow(_stars, "a long, b long"), sets))
            known = written(components(links, "a", "b"), "ngram-known")
            worth = written(left.select("set_id", "which", "shingles").mapInArrow(released(_worth), "set_id long, which int, n long, worth long, most long"), "ngram-worth")
        dealt = written(_blocks(left, known, size), "ngram-dealt")
        index = lambda sets, kind: sets.groupBy("block").applyInArrow(_block_index(buckets, deletions, kind), PACKED).groupBy("bucket")
        known = _united(known, verified(index(dealt, STAR).applyInArrow(_stars, "a long, b long"), sets))
        # a block gets back the signatures that several components still share
        costs = index(_labelled(dealt.drop("component"), known, "set_id"), ENTRY).applyInArrow(_costs, "_block int, costs binary")
        found = dealt.filter("able").groupBy("block").cogroup(costs.groupBy("_block")).applyInArrow(_costly_sets(deletions), COSTLY)
        found = written(found, "ngram-costly-entries")
        exact = found if exact is None else exact
        lacks = lambda value, paid: _bound(F.col("n"), F.col("which")) + 1 - F.col(value) + F.coalesce(paid, F.lit(0)) > 0
        state = worth.join(found.select("set_id", "which", "paid", "paid_most"), ["set_id", "which"], "left")
        state = state.withColumns({"lacks": lacks("worth", "paid"), "able": lacks("most", "paid_most")}).withColumn("able", ~F.col("able"))
        if not deletions:
            incomplete = written(incomplete.join(state.filter("lacks").select("set_id", "which", "able"), ["set_id", "which"]), "ngram-incomplete")
        else:  # sets that no neighbourhood could complete have not asked
            done = state.filter("able").select("set_id", "which").join(incomplete.filter("able"), ["set_id", "which"], "left_semi")
            incomplete = written(incomplete.join(done, ["set_id", "which"], "left_anti"), "ngram-incomplete")
    if not incomplete.isEmpty():
        # the order of subsets by cost is the same for all sets, so of two similar sets both buy
        # the first subset that they share
        left = incomplete.join(sets, "set_id").select("set_id", F.col("which").cast("int"), "shingles")
        parities = left.select("set_id", "shingles").mapInArrow(released(_parities), "id long, parity array<long>").dropDuplicates(["id"])
        buying = exact.join(incomplete, ["set_id", "which"], "left_semi").join(worth.select("set_id", "which", "worth"), ["set_id", "which"])
        buying = buying.withColumnRenamed("set_id", "id").withColumn("all", F.size("subsets"))
        needs = _bound(F.col("n"), F.col("which")) + 1 - F.col("worth") + F.col("all")
        bought = buying.select("id", "which", "n", "worth", "all", F.posexplode(F.slice("subsets", F.lit(1), needs.cast("int"))).alias("before", "subset"))
        bought = bought.select("subset.sig", F.col("subset.cost").alias("price"), "id", "which", "n", "worth", (F.col("all") - F.col("before")).alias("ahead"))
        bought = written(_costly(bought, known), "ngram-bought")
        # subsets bought by the same sets give the same pairs: the first of them is enough
        buyers = bought.groupBy("sig", "price").agg(F.bit_xor(F.xxhash64("id")).alias("who"), F.sum(F.xxhash64("id") % (1 << 20)).alias("sum"))
        first = buyers.groupBy("who", "sum").agg(F.min(F.struct("price", "sig")).alias("first")).select("first.sig")
        bought = written(bought.join(first, "sig", "left_semi"), "ngram-first")
        in_order = F.array_sort(F.collect_list(F.struct("price", "sig")))["sig"]
        lists = bought.groupBy("id", "which").agg(in_order.alias("sigs"))
        bought = bought.join(parities.join(lists, "id"), ["id", "which"])
        bought = bought.withColumn("sigs", F.slice("sigs", 1, F.array_position("sigs", F.col("sig")).cast("int")))
        side = lambda x: bought.select("sig", *[F.col(c).alias(x + c) for c in ("id", "n", "component", "worth", "ahead", "parity", "sigs")])
        # from the first subset that two sets share, either must have as many ahead as they need to share
        needed = F.greatest("aworth", "bworth") - F.floor((F.col("an") + F.col("bn")) / 7)
        apart = reduce(add, [F.bit_count(F.col("aparity")[k].bitwiseXOR(F.col("bparity")[k])) for k in range(PARITY_BITS // 64)])
        rest = side("a").join(side("b"), "sig").filter(
            (F.col("aid") < F.col("bid")) & (F.col("acomponent") != F.col("bcomponent")) & _similar_sizes("an", "bn") & (F.least("aahead", "bahead") >= needed)
            & (7 * apart <= F.col("an") + F.col("bn")) & (F.array_intersect("asigs", "bsigs")[0] == F.col("sig"))
        ).select(F.col("aid").alias("a"), F.col("bid").alias("b"))
        known = _united(known, verified(rest, sets))

    joined = components(links, "a", "b") if known is None else known
    labelled = written(
        classes.select("set_id", "first_doc").join(joined, F.col("set_id") == F.col("node"), "left").select("set_id", "first_doc", F.coalesce("component", "set_id").alias("label")),
        "ngram-labels",
    )
    least_doc = labelled.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    per_class = labelled.join(least_doc, "label").select("set_id", "component_id")
    linked = described.filter("n > 0").join(per_class, "set_id").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(described.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_parity(np.frombuffer(blob, U)).view(np.int64).tolist() for blob in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["id", "parity"])


def _worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Value of all segments of each incomplete set, without and with one-deletion neighbourhoods."""
    for batch in batches:
        worth, most, size = [], [], []
        for which, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            x = np.frombuffer(blob, U)
            starts = segments(x, np.array([len(x)]), which)[0]
            length = np.diff(np.append(starts, len(x)))
            worth.append(len(length))
            most.append(int(np.where(length > 1, 2, 1).sum()))
            size.append(len(x))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (size, worth, most)]], ["set_id", "which", "n", "worth", "most"])


def _united(known: DataFrame, links: DataFrame) -> DataFrame:
    """The components known so far, united by further links."""
    if links.isEmpty():
        return known
    return written(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links), "a", "b"), "ngram-known")


def marked(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows with _marked: true for each whose key is among `keys` (hashes in a column key), and
    for few others. Of the keys a bit map of at most MOST_SLOTS bits travels to the rows, so that
    texts that nobody asked for are not shuffled."""
    count = keys.count()
    slots = min(MOST_SLOTS, max(64, 1 << (SLOTS_PER_KEY * count).bit_length()))
    slot = F.pmod(key, F.lit(slots))
    words = (
        keys.select(F.pmod("key", F.lit(slots)).alias("_slot"))
        .groupBy(F.shiftright("_slot", 6).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")).alias("_bits"))
    )
    joined = rows.withColumn("_slot", slot).join(F.broadcast(words), F.shiftright("_slot", 6) == F.col("_word"), "left")
    hit = F.coalesce(F.getbit("_bits", F.col("_slot") % 64) == 1, F.lit(False))
    return joined.withColumn("_marked", hit).drop("_slot", "_word", "_bits")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without near copies: one row of each component, that with the smallest id
    (null ids last), then the smallest hash of its text. Of rows equal in id and text one stays,
    also where they have no words; other rows without words all stay. Rows are told apart by a
    64-bit hash of id and text, so a repeated id does not keep a copy.
    """
    docs, restored = tucked(docs, "doc_id", "text")
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    rows = docs.select(key.alias("doc_id"), "text")
    groups = similar_components(rows, **options).groupBy(F.col("doc_id").alias("_row")).agg(F.min("component_id").alias("_group"))
    sizes = docs.groupBy(key.alias("_row")).agg(
        F.min("doc_id").alias("_id"), F.min(F.xxhash64("text")).alias("_text"), F.count(F.lit(1)).alias("_n")
    )
    best = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_text", "_row", "_n"))
    placed = written(sizes.join(groups, "_row"), "ngram-rows")
    picked = written(placed.groupBy("_group").agg(best.alias("_best")).select("_best._row", "_best._n"), "ngram-kept")
    single, repeated = picked.filter("_n = 1"), picked.filter("_n > 1")
    # most rows are alone and stay: only those that may not be are moved to meet their key
    others = written(placed.join(single, "_row", "left_anti").select(F.col("_row").alias("key")), "ngram-others")
    told = marked(docs, key, others)
    alone, asked = told.filter("NOT _marked").select(*docs.columns), told.filter("_marked").select(*docs.columns)
    one = asked.join(single, key == F.col("_row"), "left_semi")
    several = asked.join(repeated.select("_row"), key == F.col("_row"))
    whole = F.min(F.struct(*docs.columns)).alias("_doc")
    return restored(alone.unionByName(one).unionByName(several.groupBy("_row").agg(whole).select("_doc.*")))
