"""Operators on documents and conversations against brute force, on small tables with nulls,
empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sprintlens.llm import (
    chat_snapshots,
    line_spread,
    ngram_join,
    pareto_mix,
    pu_quality,
    sp_codec,
    subword_langid,
    token_store,
)
from sprintlens.llm.queries import tokenizer_file
from sprintlens.session import scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k int, size string, h string"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, ids=None, sources=None, langs=None):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [
        (ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else f"s{i % 4}", len(t or ""), 1, "x", "y")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def words_of(rng, n, vocabulary=400):
    return [f"w{x}" for x in rng.integers(0, vocabulary, n)]


@pytest.fixture(scope="module")
def family():
    """Near copies, exact copies, shared passages, short, empty and null texts."""
    rng = np.random.default_rng(3)
    texts = [None, "", " \n ", "one two", "One  TWO", "a b c", "a b c d e", "a b c d e f", "é É x y z q"]
    passage = words_of(rng, 40, 10**6)
    for _ in range(12):
        base = words_of(rng, int(rng.integers(20, 160)), 10**6)
        for copy in range(4):
            w = list(base)
            for at in rng.integers(0, len(w), copy * len(w) // 60):
                w[at] = f"n{rng.integers(10**9)}"
            texts.append(" ".join(w))
    texts += [" ".join(passage + words_of(rng, int(n), 10**6)) for n in rng.integers(3, 60, 45)]
    base = words_of(rng, 70, 10**6)
    for _ in range(50):
        w = list(base)
        w[int(rng.integers(0, 70))] = f"n{rng.integers(10**9)}"
        texts.append(" ".join(w))
    texts.append(" ".join(words_of(rng, 30_000, 10**6)))
    return texts + texts[-60:-55]


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("common", [32, 3])
def test_ngram_components_equal_brute_force(spark, family, common):
    found = ngram_join.similar_components(documents(spark, family).repartition(5), common=common).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(family)


@pytest.mark.parametrize("few_blocks", [0, 16])
def test_sets_of_common_passages_are_compared_once(spark, monkeypatch, few_blocks):
    """Sets that share many subsets that are all too common: a pair is a candidate once per band,
    at the first of them, and no link is lost, with blocks by component and by left sets."""
    rng, seen, verified = np.random.default_rng(8), [], ngram_join.verified
    passages = [words_of(rng, 40, 10**6) for _ in range(10)]
    texts = []
    for i in range(60):
        chosen = np.sort(rng.choice(10, 7, replace=False)).tolist()
        texts.append(" ".join(w for k in chosen for w in passages[k]) + f" n{i}")

    def recorded(pairs, sets):
        seen.append((pairs.count(), pairs.distinct().count()))
        return verified(pairs, sets)

    monkeypatch.setattr(ngram_join, "verified", recorded)
    monkeypatch.setattr(ngram_join, "FEW_BLOCKS", few_blocks)
    found = ngram_join.similar_components(documents(spark, texts), common=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)
    rows, pairs = seen[-1]
    assert len(seen) == 5 and pairs and rows <= 2 * pairs


def test_neighbourhoods_are_sent_back_only_to_sets_they_can_complete(spark, monkeypatch):
    """Sets of passages that are all too common: their neighbourhoods cost as much as their subsets."""
    rng, entries, written = np.random.default_rng(8), [], ngram_join.written
    passages = [words_of(rng, 40, 10**6) for _ in range(10)]
    chosen = [np.sort(rng.choice(10, 7, replace=False)).tolist() for _ in range(40)]
    texts = [" ".join(w for k in c for w in passages[k]) + f" n{i}" for i, c in enumerate(chosen)]

    def recorded(df, name):
        out = written(df, name)
        if name == "ngram-costly-entries":
            entries.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", recorded)
    found = ngram_join.similar_components(documents(spark, texts), common=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)
    assert len(entries) == 2 and entries[1] <= entries[0]


def test_costly_subsets_are_not_rows_of_their_own(spark, monkeypatch):
    """Sets of passages that are all too common and that no link joins: what is written of their
    subsets is a row per set and what they buy, and their parities tell them apart at once."""
    rng, rows, written = np.random.default_rng(8), defaultdict(list), ngram_join.written
    passages = [words_of(rng, 40, 10**6) for _ in range(10)]
    chosen = [np.sort(rng.choice(10, 4, replace=False)).tolist() for _ in range(80)]
    texts = [" ".join(w for k in c for w in [f"n{i}", *passages[k]]) for i, c in enumerate(chosen)]

    def recorded(df, name):
        out = written(df, name)
        rows[name].append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", recorded)
    found = ngram_join.similar_components(documents(spark, texts), common=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)
    sets = 2 * len(texts)  # in their own band, and maybe the next
    assert rows["ngram-costly-entries"] and max(rows["ngram-costly-entries"]) <= sets
    # candidates by cold subsets, then by stars: of sets that many share, few can be similar
    assert len(rows["ngram-candidates"]) == 1 and max(rows["ngram-pairs"][1:]) <= 2 * sets


def test_only_texts_asked_for_are_moved(spark, monkeypatch):
    rng, moved, marked = np.random.default_rng(9), [], ngram_join.marked
    texts = [" ".join(words_of(rng, 12, 10**6)) for _ in range(200)]
    texts += texts[:3] + [None, None]

    def recorded(rows, key, keys):
        out = marked(rows, key, keys)
        moved.append(out.filter("_marked").count())
        return out

    monkeypatch.setattr(ngram_join, "marked", recorded)
    kept = ngram_join.one_of_each(documents(spark, texts)).collect()
    assert sorted(r.doc_id for r in kept) == [*range(200), 203, 204]
    assert len(moved) == 2 and max(moved) < 60


def test_marked_keeps_all_rows_and_misses_no_key(spark):
    rows = spark.range(2000).select(F.when(F.col("id") < 1990, F.col("id")).alias("id"))
    keys = rows.filter("id % 50 = 0 OR id IS NULL").select(F.xxhash64("id").alias("key"))
    out = ngram_join.marked(rows, F.xxhash64("id"), keys)
    assert out.columns == ["id", "_marked"] and out.count() == 2000
    assert out.filter("(id % 50 = 0 OR id IS NULL) AND NOT _marked").count() == 0
    assert out.filter("_marked").count() < 300
    assert ngram_join.marked(rows, F.xxhash64("id"), keys.limit(0)).filter("_marked").count() == 0


def test_later_steps_read_only_sets_left_incomplete(spark, monkeypatch):
    rng, read, verified = np.random.default_rng(10), [], ngram_join.verified
    texts = [" ".join(words_of(rng, 30, 10**6)) for _ in range(60)]
    texts += [t + " again" for t in texts]
    passages = [words_of(rng, 40, 10**6) for _ in range(10)]
    for i in range(20):
        chosen = np.sort(rng.choice(10, 7, replace=False)).tolist()
        texts.append(" ".join(w for k in chosen for w in passages[k]) + f" n{i}")

    def recorded(pairs, sets):
        read.append((sets.count(), sets.select("set_id").distinct().count()))
        return verified(pairs, sets)

    monkeypatch.setattr(ngram_join, "verified", recorded)
    found = ngram_join.similar_components(documents(spark, texts), common=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts)
    assert all(rows == sets for rows, sets in read)
    assert read[0][0] == 140 and len(read) > 1 and max(rows for rows, _ in read[1:]) <= 20


def test_entries_meet_their_components_once(spark):
    entries = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 12), (3, 12)], "sig long, id long")
    known = spark.createDataFrame([(10, 10), (12, 10)], "node long, component long")
    costly = ngram_join._costly(entries, known)
    assert sorted((r.sig, r.id, r.component, r.cost) for r in costly.collect()) == [(1, 10, 10, 2), (1, 11, 11, 2)]
    assert costly._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_subsets_travel_under_short_heads():
    """Some three subsets of a set in a bucket: 5 bytes each and 13 of the set; a set with more than
    255 of them stands there again."""
    rng = np.random.default_rng(12)
    texts = [" ".join(words_of(rng, 300, 10**6)) for _ in range(40)] + [" ".join(words_of(rng, 30_000, 10**6))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for buckets, most in ((50, 11), (2, 7)):
        (out,) = ngram_join._index(buckets, 32)(iter([batch]))
        heads = [np.frombuffer(x, ngram_join.HEAD) for x in out.column("sets").to_pylist()]
        sent = [ngram_join._unpack(x) for x in out.column("entries").to_pylist()]
        assert [int(h["times"].sum()) for h in heads] == [len(x) for x in sent]
        assert sum(13 * len(h) + 5 * len(x) for h, x in zip(heads, sent)) < most * sum(map(len, sent))
        x, counts = ngram_join.shingle_sets(batch.column(0))
        expected = sum(len(ngram_join.segments(*ngram_join._take(x, counts, use), w)[0]) for w, use in ((0, counts > 0), (1, ngram_join.reaches_on(counts))))
        assert sum(map(len, sent)) == expected


def test_ngram_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + [None], ids=[5, 5, 7, None])
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.similar_components(docs).collect())
    assert found == [(0, 0, None), (5, 2, 5), (5, 2, 5), (7, 2, 5)]
    assert ngram_join.similar_components(documents(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_smallest(spark, family):
    docs = documents(spark, family)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in brute_components(family).values()}


def test_texts_are_coded_in_small_slices(monkeypatch):
    """A worker holds ids, spans and lists of half a megabyte of text at a time, not of two."""
    codec, sizes = sp_codec.Codec(tokenizer_file("piece_bpe_32k.model")), []
    encode = codec.encode
    monkeypatch.setattr(codec, "encode", lambda texts: sizes.append(sum(len(t) for t in texts.to_pylist())) or encode(texts))
    rng = np.random.default_rng(5)
    texts = [" ".join(words_of(rng, 400)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(1500))], ["text", "doc_id"])
    out = pa.Table.from_batches(list(sp_codec.coded(codec, iter([batch]), ["doc_id"])))
    assert sum(sizes) > 2 << 20 and max(sizes) <= 512 << 10
    assert out["decoded"].to_pylist() == texts and out["doc_id"].to_pylist() == list(range(1500))


def test_tokens_equal_library_and_files_are_in_order(spark, family):
    from tokenizers import Tokenizer

    texts = family[:40] + ["don't <|endoftext|> stop!! 12", "Été, İ ΣΑΣ ß?", "x y\x1cz"]
    ids = list(range(1000, 1000 - len(texts), -1))
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(documents(spark, texts, ids=ids), path, tokenizer_file("word_bpe_49k.json"))
    found = {r.doc_id: r for r in token_store.document_table(spark, path).collect()}
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    start = 0
    for doc_id, text in sorted(zip(ids, texts)):
        want = library.encode(text or "", add_special_tokens=False).ids + [2]
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    one = token_store.read_tokens(spark, path).filter(f"doc_id = {ids[3]}").collect()
    assert len(one) == 1
    empty = scratch_dir(spark, "tokens")
    token_store.write_tokens(documents(spark, []), empty, tokenizer_file("word_bpe_49k.json"))
    assert token_store.document_table(spark, empty).count() == 0


def test_sentencepiece_equals_library_and_spans_cover_text(spark, family):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    texts = family[:30] + ["  two  blanks ", "▁mark ▁", "\n\ttab\n", "日本 \U0001f600 é"]
    found = {r.doc_id: r for r in sp_codec.encode_decode(documents(spark, texts), tokenizer_file("piece_bpe_32k.model")).collect()}
    for i, text in enumerate(texts):
        want = library.encode(text or "") + [2]
        r = found[i]
        assert r.ids == want and r.decoded == library.decode(want)
        raw = (text or "").encode()
        assert r.ends[-1] == len(raw) and r.begins[0] == 0
        assert all(b == e for b, e in zip(r.begins[1:], r.ends[:-1]))


def test_character_map_takes_longest_prefix_and_records_source():
    # a trie over "a" -> "x" and "ab" -> "yz", laid out by hand: unit = offset << 10 | leaf bit | label
    units = [0] * 600
    base_root, base_a, base_ab = 256, 300, 400
    units[0] = base_root << 10
    a = base_root ^ ord("a")
    units[a] = (a ^ base_a) << 10 | 1 << 8 | ord("a")
    units[base_a] = 1 << 31 | 0
    ab = base_a ^ ord("b")
    units[ab] = (ab ^ base_ab) << 10 | 1 << 8 | ord("b")
    units[base_ab] = 1 << 31 | 2
    trie = np.array(units, "<u4").tobytes()
    table = sp_codec.CharacterMap(len(trie).to_bytes(4, "little") + trie + b"x\0yz\0")
    assert table.longest(b"ab", 0) == (2, b"yz") and table.longest(b"ac", 0) == (1, b"x") and table.longest(b"b", 0) is None
    codec = sp_codec.Codec(tokenizer_file("piece_bpe_32k.model"))
    codec.map = table
    normal, source = codec.normalise("cab a")
    assert normal.decode() == "▁cyz▁x"
    assert source == [0, 0, 0, 0, 1, 1, 3, 3, 3, 4, 5]


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(["w"] * int(n)) for n in rng.integers(0, 60, 900)] + [None, "", "w " * 5000]
    sources = [["a", "b", None][int(x)] for x in rng.choice(3, len(texts), p=[0.1, 0.6, 0.3])]
    rows = pareto_mix.mix(documents(spark, texts, sources=sources)).collect()
    assert len(rows) == len(texts)
    total, by = sum(r["size"] for r in rows), defaultdict(list)
    for r in rows:
        assert 0 <= r.copies <= 2 and r["size"] == len((texts[r.doc_id] or "").split())
        by[sources[r.doc_id]].append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert v[0].source_size == sum(r["size"] for r in v) and v[0].target <= 2 * v[0].source_size
        assert abs(sum(r.copies * r["size"] for r in v) - v[0].target) <= max(r["size"] for r in v) / 2 + 1
    assert pareto_mix.mix(documents(spark, [])).count() == 0
    weighted = pareto_mix.mix(documents(spark, texts, sources=sources), weight="_k").collect()
    assert {(r.doc_id, r.copies) for r in weighted} == {(r.doc_id, r.copies) for r in rows}
    mixed = pareto_mix.mixed_documents(documents(spark, texts, sources=sources))
    assert mixed.columns == documents(spark, []).columns and mixed.count() == sum(r.copies for r in rows)


def test_lines_by_exact_spread(spark):
    texts, sources = [], []
    for i in range(30):
        own = f"own line {i}\n\n"
        spread = "".join(f"line of {k}\n" for k in (3, 4, 5) if i < k)
        texts.append(own + " everywhere \t\n" + spread + "everywhere")
        sources.append(f"s{i}")
    texts += [None, "", "everywhere", "everywhere"]
    sources += ["s1", "s2", None, "s3"]
    out = {r.doc_id: r for r in line_spread.dedup_lines(documents(spark, texts, sources=sources), min_sites=4).collect()}
    assert out[0].text == texts[0] and out[0].n_removed == 0
    assert out[1].text == "own line 1\n\nline of 3" and (out[1].n_lines, out[1].n_removed) == (6, 4)
    assert out[30].text is None and out[31].text == "" and out[32].text == "" and out[33].n_removed == 1
    assert line_spread.dedup_lines(documents(spark, [])).count() == 0
    clean = line_spread.cleaned_documents(documents(spark, texts, sources=sources), min_sites=4)
    assert clean.columns == documents(spark, []).columns and clean.filter("doc_id = 1").first().n_chars == len(out[1].text)


def test_chats_keep_maximal_conversations(spark):
    say = lambda c, *t: [(c, i, "user" if i % 2 == 0 else "assistant", x, "k") for i, x in enumerate(t)]
    rows = say(1, "a") + say(2, "a", "b") + say(3, "a", "b", "c") + say(4, "a", "x") + say(5, "a", "b", "c") + say(6, "b")
    rows += say(3, "a") + [(None, 0, "user", "lost", "k"), (7, None, None, None, "k"), (7, 0, "user", "<|im_end|>", "k")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, _k string")
    out = {r.conv_id: r for r in chat_snapshots.format_chats(turns).collect()}
    assert sorted(out) == [3, 4, 6, 7]
    assert out[3].n_equal == 2 and out[3].n_turns == 3
    assert out[6].text == "<|im_start|>user\nb<|im_end|>\n"
    assert out[7].text == "<|im_start|>user\n< |im_end|><|im_end|>\n<|im_start|>unknown\n<|im_end|>\n"
    assert chat_snapshots.format_chats(turns.limit(0)).count() == 0


def test_languages_held_out(spark):
    rng = np.random.default_rng(1)
    stems = {"en": ["th", "er", "on", "ing", "wh"], "de": ["sch", "ch", "ü", "ei", "pf"], "fr": ["eau", "é", "oi", "ê", "qu"]}
    texts, langs = [], []
    for i in range(360):
        lang = list(stems)[i % 3]
        texts.append(" ".join("".join(rng.choice(stems[lang], 3)) for _ in range(40)))
        langs.append(lang if i % 7 else None)
    texts += [None, "", "12 ?! \n"]
    langs += ["en"] * 3
    truth = [list(stems)[i % 3] for i in range(360)] + ["und"] * 3
    out = subword_langid.train_and_identify(documents(spark, texts, langs=langs)).collect()
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in out) and len(out) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert subword_langid.train_and_identify(documents(spark, [])).count() == 0
    assert {r.lang_pred for r in subword_langid.train_and_identify(documents(spark, ["abc"], langs=[None])).collect()} == {"und"}


def test_quality_held_out(spark):
    rng = np.random.default_rng(2)
    good = lambda: ". ".join(" ".join(words_of(rng, 9, 900)) for _ in range(12)) + "."
    bad = lambda: " ".join(["###&&&"] * 40) if rng.random() < 0.5 else "BUY!! NOW!! " * 30
    kind = rng.random(1200) < 0.8
    texts = [good() if k else bad() for k in kind] + [None, ""]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(k), 0) for i, k in enumerate(kind) if i % 2], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in pu_quality.train_and_score(docs, labels).collect()}
    held = [i for i in range(1200) if out[i].held_out]
    assert np.mean([out[i].predicted == kind[i] for i in held]) > 0.97
    assert 0 <= out[1200].score == out[1201].score <= 1
    kept = pu_quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out.values())
    assert {r.score for r in pu_quality.train_and_score(docs, labels.limit(0)).collect()} == {0.5}
    assert pu_quality.train_and_score(documents(spark, []), labels).count() == 0


def test_set_identity_is_stable():
    x, n = ngram_join.shingle_sets(pa.array(["a b c d e f", None, "f e", "a b c d e f"]))
    ids = ngram_join.set_ids(x, n)
    assert n.tolist() == [2, 0, 1, 2] and ids[0] == ids[3] != ids[2] and ids[1] == 0
    assert hashlib.sha256(x.tobytes()).hexdigest() == hashlib.sha256(ngram_join.shingle_sets(pa.array(["a b c d e f", "", "f e", "a b c d e f"]))[0].tobytes()).hexdigest()
