import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumaset.llm import components, exact_dedup, line_dedup, near_dups, repeats, windows


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = {}
    for t, ids in groups.items():
        for i in ids:
            out[i] = (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact(docs, rows, weak):
    options = {"fingerprint": F.length("body").cast("bigint"), "capacity": 4, "hot": 3} if weak else {}
    found = exact_dedup.exact_dedup(docs, **options)
    assert found.columns == ["doc_id", "text", "source", "score", "row", "keep_id", "group_size", "kept", "text_sha256"]
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()} == expected_exact(rows)


def test_exact_chains_collisions(spark, monkeypatch):
    # fingerprint and digest both collide: only the bytes tell the texts apart
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("same"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c")], "doc_id bigint, text string")
    for hot in (1, 1024):
        found = exact_dedup.exact_dedup(df, fingerprint=F.lit(7).cast("bigint"), hot=hot).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in found} == {1: (3, 2), 3: (3, 2), 2: (4, 2), 4: (4, 2), 5: (5, 1)}


def test_exact_edges(no_docs, twice, docs, rows):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    want = expected_exact(rows)
    found = exact_dedup.exact_dedup(twice).collect()
    assert len(found) == 2 * len(rows) + 1
    # the row of nulls is one more empty text, and its id stays beside no other
    more = {i: 2 * want[i][1] + (not t) for i, t, _ in rows}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found if r.doc_id is not None} == {(i, want[i][0], more[i], want[i][2]) for i, *_ in rows}
    assert [r.kept for r in found if r.doc_id is None] == [False]
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, e in want.items() if e[2])
    assert {r.kept for r in kept.collect()} == {"x"}


def test_results_come_from_the_index_files(docs, rows):
    table = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("body")).withColumn("fp", F.xxhash64("body"))
    index, directory = exact_dedup.build_index(table, capacity=8)
    assert len(directory) > 4
    assert all(b.entries <= 8 for b in directory)
    whole = exact_dedup.look_up(table, index, directory).collect()
    assert {r.id: (r.keep_id, r.group_size, r.text_sha256) for r in whole} == {i: (*e[:2], e[3]) for i, e in expected_exact(rows).items()}
    # a bucket whose file is damaged: its rows, and only they, are told something else or not found
    owner = {r.id: r.b for r in table.select("id", exact_dedup.bucket_of(F.col("fp"), directory).alias("b")).collect()}
    lost = exact_dedup.look_up(table, index.where("bucket != 2"), directory).collect()
    assert {r.id for r in whole} - {r.id for r in lost} == {i for i, b in owner.items() if b == 2} != set()
    changed = exact_dedup.look_up(table, index.withColumn("keep_id", F.when(F.col("bucket") == 3, -1).otherwise(F.col("keep_id"))), directory).collect()
    assert {r.id for r in changed if r.keep_id == -1} == {i for i, b in owner.items() if b == 3} != set()
    # a wrong directory sends rows to buckets that don't have them
    assert exact_dedup.look_up(table, index, directory[1:]).count() < len(rows)


def test_directory_splits_until_buckets_fit(spark):
    cells = {(c, 4): 10 for c in range(16) if c != 3} | {(3 * 16 + c, 8): 30 for c in range(16)}
    found = exact_dedup.split_buckets(cells, 40)
    assert sum(b.entries for b in found) == sum(cells.values())
    assert all(b.entries <= 40 for b in found)
    edges = [b.start for b in found] + [2**63]
    assert edges[0] == -(2**63)
    assert all(a + (1 << (64 - b.depth)) == z for a, b, z in zip(edges, found, edges[1:]))
    # fingerprints close to each other, at both ends of their range and all alike
    for values in ([7, 8, 9, 10, -5, 2**63 - 1, -(2**63), 2**40], [3], []):
        prints = spark.createDataFrame([(v,) for v in values], "fp bigint")
        directory = exact_dedup.build_directory(prints, 2)
        assert all(b.entries <= 2 for b in directory)
        got = prints.select("fp", exact_dedup.bucket_of(F.col("fp"), directory).alias("b")).collect()
        assert all(directory[r.b].start <= r.fp < (directory[r.b + 1].start if r.b + 1 < len(directory) else 2**63) for r in got)


def shingles(text, size):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected_near(rows, size):
    sets = {i: shingles(t, size) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near(docs, rows, size):
    found = near_dups.near_duplicates(docs, size=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == expected_near(rows, size)


def test_rarest_lists_hold_every_match(spark):
    """Pairs that agree in MATCHES coordinates meet in a list that is left; what agrees in fewer need not."""
    rng = np.random.default_rng(6)
    base = rng.integers(-(2**31), 2**31, (6, near_dups.COORDINATES))
    common = rng.integers(-(2**31), 2**31, near_dups.COORDINATES)
    rows = []
    for doc in range(90):
        own = base[doc % 6].copy()
        # some coordinates are everybody's, some are its own
        shared, own_at = rng.choice(near_dups.COORDINATES, rng.integers(0, 30), replace=False), rng.choice(near_dups.COORDINATES, rng.integers(0, 40), replace=False)
        own[shared] = common[shared]
        own[own_at] = rng.integers(-(2**31), 2**31, len(own_at))
        rows.append(own)
    signed = spark.createDataFrame([(i, [int(v) for v in r]) for i, r in enumerate(rows)], "doc bigint, signature array<int>")
    held = defaultdict(set)
    posted = near_dups.rarest_lists(signed).collect()
    for r in posted:
        held[r.key].add(r.doc)
    meet = {(a, b) for docs in held.values() for a in docs for b in docs if a < b}
    match = {(a, b) for b in range(90) for a in range(b) if (rows[a] == rows[b]).sum() >= near_dups.MATCHES}
    assert match
    assert match <= meet
    assert max(Counter(r.doc for r in posted).values()) <= near_dups.COORDINATES - near_dups.MATCHES + 1


def test_near_in_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(near_dups, "LIST", 2)
    monkeypatch.setattr(near_dups, "FAMILY", 2)
    monkeypatch.setattr(near_dups, "BROADCAST_ROWS", 0)
    found = near_dups.near_duplicates(docs, size=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == expected_near(rows, 2)


def test_near_edges(no_docs, twice, rows):
    assert near_dups.near_duplicates(no_docs).count() == 0
    found = near_dups.near_duplicates(twice, size=2).collect()
    assert len(found) == 2 * len(rows) + 1
    want = expected_near(rows, 2)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id][:2] for r in found if r.doc_id is not None and r.n_shingles)
    with pytest.raises(ValueError):
        near_dups.near_duplicates(no_docs, percent=50)


def test_drop_near(docs, rows):
    kept = near_dups.drop_near_duplicates(docs, size=2)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, e in expected_near(rows, 2).items() if e[2]]


@settings(deadline=None)
@given(st.lists(st.text(alphabet="abAB é\t\n ", max_size=12), max_size=6))
def test_shingle_sets(texts):
    flat, counts = near_dups.shingle_sets([np.frombuffer(t.encode(), np.uint8) for t in texts], 2)
    assert counts.tolist() == [len(shingles(t, 2)) for t in texts]


def test_scratch_is_cleared(spark):
    from pathlib import Path

    from lumaset.llm import shared

    table = shared.materialise(spark.range(3), "scratch")
    here = Path(table._lumaset_path.removeprefix("file://"))
    assert list(here.iterdir())
    shared.clear(spark)
    assert not here.exists()
    shared.clear(spark)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (7, 7), (100, 105)]
    found = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.u: r.v for r in found} == {**{i: 0 for i in range(1, 41)}, 103: 100, 105: 100}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def expected_repeats(rows, width):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    often = Counter(b[p : p + width] for _, b in texts for p in range(len(b) - width + 1))
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if often[b[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.setdefault(i, (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(docs, rows):
    found = repeats.remove_repeats(docs)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}
    assert got == expected_repeats(rows, 200)
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("at_once", [700, 1 << 22])
def test_repeats_of_few_letters(spark, monkeypatch, at_once):
    import random

    rnd = random.Random(at_once)
    monkeypatch.setattr(repeats, "AT_ONCE", at_once)
    texts = ["".join(rnd.choice("ab") * rnd.choice([1, 1, 40]) for _ in range(rnd.randint(0, 60))) for _ in range(30)]
    texts += ["ab" * 700, "b" * 90, texts[0][:500] + texts[1][:500]]
    rows = list(enumerate(texts))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), width=64, k=20)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()} == expected_repeats(rows, 64)


def test_repeats_edges(no_docs, twice, rows):
    assert repeats.remove_repeats(no_docs).count() == 0
    found = repeats.remove_repeats(twice).collect()
    assert len(found) == 2 * len(rows) + 1
    assert all(r.n_removed == (r.n_bytes if r.n_bytes >= 200 else 0) for r in found if r.doc_id is not None)
    assert all(r.spans[-1].stop <= r.n_bytes for r in found if r.spans)


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), min_size=5, max_size=60), st.integers(1, 5))
def test_sliding_argmin(values, width):
    keys = np.array(values, np.uint64) << np.uint64(40)
    found = windows.sliding_argmin(keys, width)
    assert found.tolist() == [min(range(p, p + width), key=lambda q: (values[q], q)) for p in range(len(values) - width + 1)]


def test_lines(spark):
    nav = "<ul><li>Home</li><li>About us</li></ul>"
    rows = [(i, f"http://A.example/{i}", f"<html><script>x<p>y</script>{nav}<p>body {i}</p><p>body {i}</p><!-- c --></html>", "z") for i in range(6)]
    rows += [(10, "ftp://b.example", "<p>Home</p>", "z"), (11, None, None, None), (12, "nohost", "", "z"), (13, "http://a.example?x", nav, "z"), (None, "http://a.example/9", "<p>only</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    found = {r.page_id: r for r in line_dedup.line_dedup(pages).collect()}
    assert (found[0].host, found[0].n_lines, found[0].n_dropped, found[0].kept_text) == ("a.example", 4, 2, "body 0\nbody 0")
    assert (found[10].n_lines, found[10].n_dropped) == (1, 0)
    assert (found[11].host, found[11].n_lines, found[11].kept_text) == ("", 0, "")
    assert (found[13].n_dropped, found[13].kept_text) == (2, "")
    assert found[None].kept_text == "only"
    assert line_dedup.line_dedup(pages.limit(0)).count() == 0
    assert line_dedup.line_dedup(pages.unionByName(pages)).count() == 22
