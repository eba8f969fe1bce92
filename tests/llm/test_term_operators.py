"""Ranked search, divergence audit and token counts against brute force on small tables with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sprintlens.llm import divergence_audit, lexical_search, token_counts
from sprintlens.llm.byte_terms import DIGITS, LETTERS, byte_classes, terms
from sprintlens.llm.queries import tokenizer_file
from sprintlens.llm.token_store import encode_texts, odd_texts
from sprintlens.session import scratch_dir

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WITH_DIGITS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ONLY_LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id long, text string, lang string, source string, term string, shard long, n int, content string, p double"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 0.5) for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}É" for i in range(120)] + ["the", "a1", "B2", "ß"]
    out = [(None, None, "en", "s0"), (1, "", "en", None), (2, " \n\t--12 3", None, "s1"), (3, "the " * 30_000 + "Rare", "en", "s2")]
    for i in range(4, 260):
        words = rng.choice(vocabulary, int(rng.integers(1, 60)), p=np.arange(124, 0, -1) / 7750)
        lang, source = ("en", "de", "")[i % 3], ("s0" if i % 2 else f"s{i % 7}")
        out.append((i, (" " if i % 5 else "-").join(w.upper() if i % 4 == 0 else w for w in words), lang, source))
    return out + [out[9], out[9], (None, out[12][1], "en", "s0"), (7, out[20][1], "xx", "s9")]


def test_byte_terms_equal_the_patterns(rows):
    texts = [r[1] for r in rows] + ["café—“Ünï” z9", "\x00a\x7fb", "Ａｂ K"]
    for parts, pattern in (([*LETTERS, *DIGITS], WITH_DIGITS), (LETTERS, ONLY_LETTERS)):
        column = pa.array(["x", *texts]).slice(1)
        found, row = terms(column, byte_classes(parts))
        mine = defaultdict(list)
        for t, i in zip(found.to_pylist(), row.tolist()):
            mine[i].append(t)
        assert [mine[i] for i in range(len(texts))] == [pattern.findall((t or "").translate(LOWER)) for t in texts]


def brute_ranking(docs, items, k=10):
    found = [Counter(WITH_DIGITS.findall((t or "").translate(LOWER))) for t in docs]
    n_docs, total = sum(1 for c in found if c), sum(sum(c.values()) for c in found)
    df = Counter(t for c in found for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, c) in zip([d for d in range(len(docs))], found):
            n = sum(c.values())
            m = 10 + 90 * n * n_docs // total if total else 0
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(WITH_DIGITS.findall((text or "").translate(LOWER))) if c[t]
            )
            if s > 0:
                scores.append((s, doc_id))
        out += [(item_id, s) for s, _ in sorted(scores, key=lambda x: -x[0])[:k]]
    return out


@pytest.mark.parametrize("settings", [{}, {"vocabulary": 25, "bundle": 2}, {"owners": (1 / 50, 1 / 10, 1 / 4)}])
def test_search_equals_brute_force(spark, rows, settings, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", 37)
    items = [(1, rows[30][1]), (2, None), (3, "--"), (4, "The the RARE"), (5, "unknown"), (6, rows[40][1]), (6, rows[41][1]), (9, "a1 b2 ß")]
    table = spark.createDataFrame([(*i, 1, "z") for i in items], "item_id long, text string, item long, bundle string")
    got = lexical_search.search(docs_of(spark, rows), table, **settings).collect()
    want = brute_ranking([r[1] for r in rows], items)
    assert sorted((r.item_id, r.score) for r in got) == sorted(want)
    by_text = {r[0]: r[1] for r in rows if r[0] is not None and r[0] not in (7, 9)}
    scores = defaultdict(list)
    for r in got:
        scores[r.item_id].append(r)
    for item, found in scores.items():
        if item != 6:  # two rows of one id are two rankings
            found.sort(key=lambda r: r["rank"])
            assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
            assert found == sorted(found, key=lambda r: (-r.score, -1 if r.doc_id is None else r.doc_id))
            assert all(r.doc_id is None or r.doc_id in by_text or r.doc_id in (7, 9) for r in found)


def test_search_of_empty_tables(spark, rows):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    docs = docs_of(spark, rows)
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs.filter("text IS NULL"), items).count() == 0


def brute_audit(rows, least, top=10):
    counts, held, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        c = Counter(ONLY_LETTERS.findall((text or "").translate(LOWER)))
        counts[lang, source].update(c)
        held[lang].update(set(c))
    out = []
    for lang, sources in langs.items():
        kept = sorted((t for t, d in held[lang].items() if d >= least), key=str.encode)
        def shares(c):
            low = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // low for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(found) if part == "pair" or n < top]
    return sorted(out)


@pytest.mark.parametrize("settings", [{}, {"block": 8, "tile": 2}, {"least": 1000}])
def test_audit_equals_brute_force(spark, rows, settings):
    got = divergence_audit.audit(docs_of(spark, rows), **settings)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, settings.get("least", 10))


def test_audit_of_an_empty_table(spark, rows):
    assert divergence_audit.audit(docs_of(spark, rows).limit(0)).count() == 0


def test_equal_subtrees_are_one_node_and_pairs_are_priced_once(monkeypatch):
    rng = np.random.default_rng(5)
    counts = rng.poisson(0.3, (6, 100))
    counts[1] = counts[0]
    counts[2, 64:] = 0
    forest = divergence_audit.Forest(counts)
    assert forest.roots[0] == forest.roots[1] != forest.roots[3]
    for level, left in enumerate(forest.left):
        pairs = list(zip(left.tolist(), forest.right[level].tolist()))
        assert len(pairs) == len(set(pairs))
    priced = []
    price = divergence_audit.price
    monkeypatch.setattr(divergence_audit, "price", lambda p, q: priced.append(len(p)) or price(p, q))
    totals = counts.sum(1)
    share = lambda row, value: 1 + 10**9 * (value + 2) // (totals[row] + 200)
    a, b = np.triu_indices(6, 1)
    got = divergence_audit.distances(forest, forest, a, b, share, share)
    want = [price(share(np.full(100, i), counts[i]), share(np.full(100, j), counts[j])).sum() for i, j in zip(a, b)]
    assert got.tolist() == want and sum(priced) < 100 * len(a) / 3


def test_shares_beyond_64_bits():
    count = np.array([0, 5, 2 * 10**10])
    assert divergence_audit.shares(count, 3 * 10**10, 7).tolist() == [1 + 10**9 * (int(c) + 2) // (3 * 10**10 + 14) for c in count]


ODD = ["W̊ J̌", "<|endoftext|> <|STARTOFTEXT|>", "Ångström", "İstanbul ǅ K", "a\x0bb\x85c d", "it's 12 IT'S 's", "ÀÉ÷ß.ß!", "日本語 x"]


def test_token_counts_equal_the_library(spark, rows):
    path, cache = tokenizer_file("word_bpe_49k.json"), scratch_dir(spark, "cache")
    library = Tokenizer.from_file(path)
    all_rows = rows + [(1000 + i, t, "en", "s0") for i, t in enumerate(ODD * 2)]
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    want = sorted((r[0] or -1, len((r[1] or "").encode()), count(r[1]), count(r[1]) > 2048) for r in all_rows)
    docs = docs_of(spark, all_rows)
    read = lambda df: sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())
    token_counts.count_tokens(docs.filter("doc_id < 100"), cache, path)
    stored = spark.read.parquet(cache)
    before = stored.count()
    assert before == stored.select("content").distinct().count()
    assert token_counts.count_misses(docs.filter("doc_id < 100"), cache, path).count() == 0
    for few in (10**6, 0):
        assert read(token_counts.count_tokens(docs, cache, path, few=few)) == want
    stored = spark.read.parquet(cache)
    assert before < stored.count() == stored.select("content").distinct().count() < len(all_rows)
    assert read(token_counts.count_tokens(docs.limit(0), cache, path)) == []


def test_token_counts_take_stored_counts_of_the_same_version_only(spark):
    path, cache = tokenizer_file("word_bpe_49k.json"), scratch_dir(spark, "cache")
    docs = spark.createDataFrame([(1, "Hello  World")], "doc_id long, text string")
    keyed = token_counts._keyed(spark.createDataFrame([("hello world",)], "text string"), path).select("content")
    keyed.selectExpr("content", "77L AS n_tokens").write.parquet(f"{cache}/tokenizer={token_counts.tokenizer_version(path)}")
    assert token_counts.count_tokens(docs, cache, path).first().n_tokens == 77
    pieces = tokenizer_file("piece_bpe_32k.model")
    import sentencepiece

    want = len(sentencepiece.SentencePieceProcessor(model_file=pieces).encode("Hello  World"))
    assert token_counts.count_tokens(docs, cache, pieces).first().n_tokens == want
    other = tokenizer_file("byte_bpe_50k.json")
    assert odd_texts(other) is None and odd_texts(path) is not None
    assert token_counts.count_tokens(docs, cache, other).first().n_tokens == len(Tokenizer.from_file(other).encode("Hello  World").ids)


def test_encoder_keeps_frequent_chunks():
    from sprintlens.llm.word_pieces import ChunkEncoder

    asked = Counter()
    def encode(chunks):
        asked.update(chunks)
        return [[len(c), ord(c[0])] for c in chunks]
    encoder = ChunkEncoder(encode, keep=40)
    for i in range(30):
        words = [f"often{j}" for j in range(10)] + [f"once{i}-{j}" for j in range(15)]
        ids, counts = encoder(pa.array([words, [], words[:3]]))
        assert counts.tolist() == [50, 0, 6] and ids[:4].tolist() == [6, ord("o"), 6, ord("o")]
    assert max(asked[f"often{j}"] for j in range(10)) == 1 and len(encoder.at) <= 40


def test_odd_texts_are_encoded_as_by_the_library():
    path = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids, counts = encode_texts(path, pa.array(ODD), None)
    want = [e.ids for e in library.encode_batch(ODD, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
