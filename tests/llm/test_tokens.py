import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from lumaset.llm import bpe, grammar, packing, token_files

BYTE, WORD = (bpe.vocabulary(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LETTERS = str.maketrans("0123456789", "abcdefghij")


def library_ids(path, texts):
    return [e.ids for e in bpe.encoder(path).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(path, rows):
    rnd = random.Random(5)
    texts = [t or "" for _, t, _ in rows]
    texts += ["", "it's we're I'll 'sxs 's'tt ''s", "１２3 ½ Ⅷ", "日本　x\xa0y\x85z", "ΑΣ Σ İI", "   a", "a   ", "\x00\x1c a", "x'l", "😀 😀a'll'S"]
    texts += ["".join(rnd.choice("ab'stmdrevl  \n\t\xa012²!?.é日ß́Σ'") for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    ids, counts = bpe.encoder(path).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library_ids(path, texts)


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "AT_ONCE", 20)
    texts = [f"word{i} other{i}" for i in range(20)]
    texts.append(" \n\tword  after\n\nword's it's  " * 30 + "x" * 50)
    for path in (BYTE, WORD):
        ids, counts = bpe.Encoder(path).encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library_ids(path, texts)


def test_many_pieces_are_learned_once(monkeypatch):
    learned = []
    monkeypatch.setattr(bpe.Encoder, "piece_ids", lambda self, piece: learned.append(piece) or [len(piece)])
    enc = bpe.Encoder(BYTE)
    texts = ["".join(f" {i}" for i in range(lo, lo + 5000)).translate(LETTERS) for lo in range(0, 450_000, 5000)]
    want = [len(f" {i}") for i in range(450_000)]
    for _ in range(2):
        ids, counts = enc.encode(texts)
        assert (counts == 5000).all() and (ids == want).all()
    assert len(learned) == len(set(learned)) == 450_000


@pytest.mark.parametrize("block, file_ids", [(64, 500), (1 << 18, 1 << 22), (2, 50)])
def test_token_counts(docs, rows, block, file_ids, monkeypatch):
    if block == 64:
        monkeypatch.setattr(token_files, "LISTED", 3)
        monkeypatch.setattr(token_files, "AT_ONCE", 100)
    if block == 2:
        docs, rows = docs.where("doc_id < 40"), [r for r in rows if r[0] < 40]
    found = token_files.token_counts(docs, BYTE, 50256, block_bytes=block, file_ids=file_ids).collect()
    want = {r[0]: len(ids) + 1 for r, ids in zip(rows, library_ids(BYTE, [t for _, t, _ in rows]))}
    assert {r.doc_id: r.n_tokens for r in found} == want
    place = {}
    for r in sorted(found, key=lambda r: (r.file, r.ordinal)):
        assert r.start == place.get(r.file, 0)
        place[r.file] = r.start + r.n_tokens


def test_token_counts_edges(no_docs, twice, rows):
    assert token_files.token_counts(no_docs, BYTE, 50256).count() == 0
    assert token_files.token_counts(twice, BYTE, 50256).count() == 2 * len(rows) + 1
    with pytest.raises(ValueError):
        token_files.token_counts(no_docs, BYTE, 1 << 16)


def expected_shards(rows):
    start, out = 0, {}
    for (i, *_), ids in zip(rows, library_ids(BYTE, [t for _, t, _ in rows])):
        raw = np.array([*ids, 0], "<u4")
        out[i] = (start, len(raw), zlib.crc32(raw.tobytes()))
        start += len(raw)
    return out


@pytest.mark.parametrize("options", [{}, {"rows_each": 7, "shard_chars": 300}])
def test_shards(docs, rows, options):
    found = grammar.token_shards(docs, BYTE, 50257, **options).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected_shards(rows)


def test_shards_edges(no_docs, twice, rows):
    assert grammar.token_shards(no_docs, BYTE, 50257).count() == 0
    found = grammar.token_shards(twice, BYTE, 50257).collect()
    assert len(found) == 2 * len(rows) + 1
    runs = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(runs, runs[1:]))
    assert min(found, key=lambda r: r.start).doc_id is None


def occurrences(seq):
    """Times that each pair occurs without overlap."""
    pairs = Counter((a, b) for a, b in zip(seq, seq[1:]) if a != b)
    for value, run in itertools.groupby(seq):
        pairs[value, value] += len(list(run)) // 2
    return pairs


@settings(deadline=None)
@given(hnp.arrays(np.uint32, st.integers(0, 300), elements=st.integers(0, 4)), st.integers(2, 5))
def test_grammar_round_trip(seq, least):
    rules, short = grammar.compress(seq, 5, least=least)
    lengths = grammar.expansion_lengths(rules, 5)
    assert (grammar.expand(short, rules, 5, lengths) == seq).all()
    assert (grammar.unrolled(short, rules, 5) == seq).all()
    assert all(lengths[i] == len(grammar.unrolled(np.array([5 + i], np.uint32), rules, 5)) for i in range(len(rules)))
    assert max(occurrences(short.tolist()).values(), default=0) < least


def test_grammar_counts_only_new_pairs(monkeypatch):
    """After the first round only pairs that a merge has changed are counted: two a merge at most."""
    counted, count = [], grammar.pair_groups
    monkeypatch.setattr(grammar, "pair_groups", lambda places, *more: counted.append(len(places)) or count(places, *more))
    seq = np.random.default_rng(2).zipf(1.3, 20_000).clip(max=400).astype(np.uint32)
    rules, short = grammar.compress(seq, 401)
    assert len(counted) > 4 and max(occurrences(short.tolist()).values()) < grammar.LEAST
    assert sum(counted) < len(seq) + 2 * (len(seq) - len(short))


@pytest.mark.parametrize("shift", [0, 1 << 31])
def test_pair_groups(shift):
    seq = np.random.default_rng(4).integers(0, 6, 500).astype(np.uint32) + np.uint32(shift)
    keys, places, counts = grammar.pair_groups(np.arange(499)[::-1], seq[:-1][::-1], seq[1:][::-1], 12)
    want = {k: n for k, n in Counter(zip(seq.tolist(), seq[1:].tolist())).items() if n >= 12}
    assert {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(keys.tolist(), counts.tolist())} == want
    assert sorted(places.tolist()) == [i for i in range(499) if (seq[i], seq[i + 1]) in want]
    assert (((seq[places].astype(np.uint64) << np.uint64(32)) | seq[places + 1]) == np.repeat(keys, counts)).all()


def test_grammar_of_runs_and_copies():
    for seq in (np.full(100_000, 7, np.uint32), np.tile(np.random.default_rng(1).integers(0, 50, 700).astype(np.uint32), 64)):
        rules, short = grammar.compress(seq, 50)
        assert (grammar.expand(short, rules, 50, grammar.expansion_lengths(rules, 50)) == seq).all()
        assert len(short) + len(rules) < len(seq) / 40


def test_shard_reads_single_documents():
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(1, 40, 50)
    ids = rnd.integers(0, 6, lengths.sum()).astype(np.uint32)
    raw = grammar.encode_shard(np.arange(50), ids, lengths, 6, least=3, every=16).to_bytes()
    shard = grammar.Shard.from_bytes(raw)
    assert len(shard.symbols) < len(ids)
    for k, part in enumerate(np.split(ids, np.cumsum(lengths)[:-1])):
        assert (shard.document(k) == part).all()
    for broken in (raw[:-1], raw + b"x", b"x" * 80):
        with pytest.raises(ValueError):
            grammar.Shard.from_bytes(broken)


def test_repeated_ids_keep_their_places(spark):
    """Rows with one id, texts of equal length too, come in order of their texts whatever the partitions."""
    rows = [(5, t) for t in ("ab", "ba", "aa", "bb", None, "ab")] + [(4, "z")]
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        raw = np.array([*library_ids(BYTE, [t])[0], 0], "<u4")
        want.append((i, start, len(raw), zlib.crc32(raw.tobytes())))
        start += len(raw)
    for n in (1, 4):
        df = spark.createDataFrame(rows[::-1] if n == 4 else rows, "doc_id bigint, text string").repartition(n)
        found = grammar.token_shards(df, BYTE, 50257)
        assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect()) == want


def check_packing(found, rows, capacity):
    want = {i: [*ids, 0] for (i, *_), ids in zip(rows, library_ids(WORD, [t for _, t, _ in rows]))}
    bins, total = {}, 0
    for r in found:
        part = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.start == r.piece * capacity
        assert len(part) == r.length > 0
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        total += r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert total == sum(map(len, want.values()))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity, rows_each", [(2048, 50_000), (64, 20), (1, 10_000)])
def test_packing(docs, rows, capacity, rows_each):
    if capacity == 1:
        docs, rows = docs.where("doc_id < 30"), [r for r in rows if r[0] < 30]
    packed = packing.pack_documents(docs, WORD, capacity, rows_each=rows_each).cache()
    used = check_packing(packed.collect(), rows, capacity)
    assert packing.certificate(packed, capacity)[0] == used
    assert used <= packing.certificate(packed, capacity)[1] * 1.1 + 1


def test_packing_edges(no_docs, twice, rows):
    assert packing.pack_documents(no_docs, WORD).count() == 0
    assert packing.certificate(packing.pack_documents(no_docs, WORD), 2048) == (0, 0)
    found = packing.pack_documents(twice, WORD).collect()
    assert sum(r.piece == 0 for r in found) == 2 * len(rows) + 1
    with pytest.raises(ValueError):
        packing.pack_documents(no_docs, WORD, 0)


def fewest_bins(sizes, capacity):
    """Exact count by trying all partitions of few items."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 12), max_size=8))
def test_bounds_hold(sizes):
    sizes.sort(reverse=True)
    exact = fewest_bins(sizes, 12) if sizes else 0
    lengths = np.array(sizes, np.int64)
    assert packing.lower_bound(lengths, 12) <= exact
    bins, offsets, left = packing.best_fit_decreasing(lengths, 12)
    assert exact <= len(left) <= exact * 11 / 9 + 1
    assert all(left >= 0)


def test_ranges_of_ids(spark):
    import bisect

    from pyspark.sql import functions as F

    from lumaset.llm import ordered

    rnd = random.Random(1)
    for n in (0, 1, 3, 8, 100):
        starts = sorted({rnd.randint(-(10**12), 10**12) for _ in range(n)})
        keys = [rnd.randint(-(10**12), 10**12) for _ in range(30)] + starts[:20] + [None]
        found = spark.createDataFrame([(k,) for k in keys], "k bigint").select(ordered.bucket(F.col("k"), starts).alias("b")).collect()
        assert [r.b for r in found] == [0 if k is None else bisect.bisect_right(starts, k) for k in keys]
    table = spark.range(1000).withColumnRenamed("id", "k")
    assert len(ordered.bounds(table, "k", 10)) == 9
    assert ordered.bounds(table.limit(0), "k", 10) == []
