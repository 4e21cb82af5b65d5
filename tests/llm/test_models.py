import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumaset.llm import catalog, fingerprints, mixing, quality


def test_statistics():
    assert quality.statistics(b"") == [0.0] * len(quality.FEATURES)
    for text in ("a", "\n", " ", "é", "a b. C!\n\nd", "\x00", "x" * 5000):
        found = quality.statistics(text.encode())
        assert len(found) == len(quality.FEATURES)
        assert np.isfinite(found).all()


def test_trees_learn_and_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    for labels in (np.zeros(0), np.ones(5), np.zeros(5)):
        flat = quality.fit(x[: len(labels)], labels).score(x[:4])
        assert ((flat > 0) & (flat < 1)).all()


def plain_statistics(text):
    """The statistics in plain Python, by name."""
    raw, n = text.encode(), len(text.encode())
    words, lines = re.findall(rb"[^ \t\r\x0b\x0c\n]+", raw), re.findall(rb"[^\n]+", raw)
    upper, digit = lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57
    letter = lambda b: upper(b) or 97 <= b <= 122
    blank, symbol = lambda b: b in b" \t\r\x0b\x0c", lambda b: b < 128 and not letter(b) and not digit(b) and b not in b" \t\r\x0b\x0c\n,;:.!?'\"()-"
    share = lambda test: sum(map(test, raw)) / n
    mean, spread = lambda x: sum(x) / len(x) if x else 0.0, lambda x: (sum((v - sum(x) / len(x)) ** 2 for v in x) / len(x)) ** 0.5 if x else 0.0
    variety = lambda x: (len(set(x)) / len(x), max(Counter(x).values()) / len(x)) if x else (0.0, 0.0)
    entropy = lambda counts: -sum(c / sum(counts) * math.log2(c / sum(counts)) for c in counts)
    most = lambda test: mean([sum(map(test, w)) * 2 > len(w) for w in words])
    wl, ll = [len(w) for w in words], [len(x) for x in lines]
    letters = list(Counter(b | 32 for b in raw if letter(b)).values())
    return {
        "bytes": math.log1p(n), "words": math.log1p(len(words)), "lines": math.log1p(len(lines)), "word_length": mean(wl), "word_length_spread": spread(wl),
        "long_words": mean([x > 14 for x in wl]), "short_words": mean([x < 3 for x in wl]), "line_length": math.log1p(mean(ll)), "line_length_spread": math.log1p(spread(ll)),
        "upper": share(upper), "digits": share(digit), "spaces": share(blank), "newlines": raw.count(b"\n") / n, "commas": share(lambda b: b in b",;:"), "stops": share(lambda b: b in b".!?"),
        "marks": share(lambda b: b in b"'\"()-"), "symbols": share(symbol), "wide": share(lambda b: b >= 128), "repeated_bytes": mean([a == b for a, b in zip(raw, raw[1:])]),
        "word_variety": variety(words)[0], "pair_variety": variety(list(zip(words, words[1:])))[0] if len(words) > 1 else 1.0, "line_variety": variety(lines)[0],
        "top_word": variety(words)[1], "top_line": variety(lines)[1], "byte_entropy": entropy(list(Counter(raw).values())), "pipes": raw.count(b"|") / n,
        "capital_starts": mean([upper(w[0]) for w in words]), "ended_lines": mean([x[-1] in b".!?" for x in lines]), "digit_words": most(digit), "symbol_words": most(symbol), "upper_words": most(upper),
        "packed": len(zlib.compress(raw, 1)) / n, "sentence_length": min(200.0, max(1, len(words)) / max(1, sum(w[-1] in b".!?" for w in words))),
        "letters_entropy": entropy(letters) if letters else 0.0, "longest_word": math.log1p(max(wl, default=0)),
    }


def test_statistics_equal_plain_ones():
    rnd = random.Random(3)
    texts = ["a", " ", "\n", "A b.\nA b.\n\nC|d 12,5 (x)\r\n\té日 WORD!", "x" * 300, "no letters: 12 34!".upper()]
    texts += ["".join(rnd.choice("abcABC 019,.!|\n\t'é~") for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    for text in texts:
        want = plain_statistics(text)
        found = dict(zip(quality.FEATURES, quality.statistics(text.encode()), strict=True))
        assert found.keys() == want.keys()
        for name in want:
            assert found[name] == pytest.approx(want[name], rel=1e-6, abs=1e-9), (name, text)


def plain_score(trees, row):
    margin = trees.base
    for feature, cut, value in zip(trees.feature, trees.cut, trees.value, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        margin += value[node - len(feature)]
    return 1 / (1 + math.exp(-margin))


def test_splits_and_walk_equal_plain_ones(monkeypatch):
    """The first tree's root against trying every cut of every statistic; the flattened walk against one by nodes."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)).round(2)
    y = (x[:, 2] + 0.3 * rng.normal(size=300) > 0.4).astype(float)
    trees = quality.fit(x, y)
    base = (y.sum() + 1) / (len(y) + 2)
    g, h = y - base, np.full(len(y), base * (1 - base))
    best = (-1.0, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= quality.LEAST:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + quality.SMOOTH) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + quality.SMOOTH)
                if gain > best[0] + 1e-12:
                    best = (gain, f, cut)
    assert (trees.feature[0][0], trees.cut[0][0]) == best[1:]
    assert trees.score(x) == pytest.approx([plain_score(trees, row) for row in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9


def test_quality_separates_the_drivers_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rated = catalog.op6_quality(spark, sf)
    assert rated.count() == docs.count()
    held = rated.where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.99


def labelled(spark, n=500):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        good = rnd.random() < 0.7
        words = [rnd.choice(["the", "house", "walks", "quiet", "evening", "of"]) for _ in range(rnd.randint(20, 80))]
        rows.append((i, " ".join(words).capitalize() + "." if good else " | ".join(w.upper() + "!!" for w in words), int(good)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(1, None), (None, 1), (2, rows[2][2])], "doc_id bigint, quality int")
    return docs, labels, {i: q for i, _, q in rows}


def test_quality(spark):
    docs, labels, truth = labelled(spark)
    more = docs.unionByName(spark.createDataFrame([(9001, None, None), (9002, "", "x"), (None, "The house.", "x")], docs.schema))
    found = quality.rate_documents(more, labels).collect()
    assert len(found) == 503
    for r in found:
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.rate_documents(docs, some).collect()} for some in (labels, flipped))
    assert a == b


def test_quality_edges(spark, no_docs, twice):
    docs, labels, _ = labelled(spark, 60)
    assert quality.rate_documents(no_docs, labels).count() == 0
    assert quality.rate_documents(docs, labels.limit(0)).count() == 60
    assert quality.rate_documents(twice, labels).count() == twice.count()


def test_mixing_follows_the_inverted_distribution(docs, rows):
    found = mixing.mix(docs, weights={"hot": 1.0, "s0": 3.0, "": 40.0}, seed="t", epochs=2.0).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s or ""] += len((t or "").encode()) + 1
    goal = {"hot": 1.0, "s0": 3.0, "": 40.0}
    goal = {s: goal.get(s, 0.0) for s in size}
    want = {}
    for i, _, s in rows:
        rate = goal[s or ""] / sum(goal.values()) * sum(size.values()) / size[s or ""] * 2.0
        parts = max(1, int(np.ceil(rate / 32)))
        n = 0
        for part in range(1, parts + 1):
            u = int(hashlib.sha256(f"t|{i}|{part}".encode()).hexdigest()[:13], 16) / 2**52
            p = total = np.exp(-rate / parts)
            k = 0
            while total <= u and k < 129:
                k += 1
                p *= rate / parts / k
                total += p
            n += k
        want[i] = n
    got = Counter(r.doc_id for r in found)
    assert got == {i: n for i, n in want.items() if n}
    assert max(want.values()) > 33
    for r in found:
        assert r.n_copies == want[r.doc_id]
        assert 0 <= r.copy < r.n_copies
    assert len({(r.doc_id, r.copy) for r in found}) == len(found)


def test_mixing_edges(spark, docs, no_docs, twice):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(docs, weights={}).count() == 0
    assert mixing.mix(twice).columns[: len(twice.columns)] == twice.columns
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": -1.0})
    keys = [r.shuffle_key for r in mixing.mix(docs, epochs=5.0).collect()]
    assert keys == sorted(keys)


def test_fingerprints(docs, rows):
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert set(found) == {r[0] for r in rows}
    by_text = {}
    for k, (i, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.edited_fingerprint == fingerprints.spelled(*fingerprints.fingerprints([edited])[0])
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert r.near_edited == plain_likeness(text, edited)
        assert r.near_next == plain_likeness(text, following)


def test_fingerprints_edges(spark, docs, no_docs, twice, rows):
    assert fingerprints.fingerprint_documents(no_docs).count() == 0
    assert fingerprints.fingerprint_documents(twice).count() == 2 * len(rows) + 1
    alone = fingerprints.fingerprint_documents(docs.where("doc_id = 1")).collect()
    assert len(alone) == 1
    assert alone[0].near_next == 1.0


def plain_walk(text):
    """The walk step by step."""
    steps = fingerprints._steps().reshape(fingerprints.CLASSES, fingerprints.PERIOD)
    read = []
    for c in text:
        mixed = int(fingerprints.mix(np.array([ord(c) + 1], np.uint64))[0])
        stay = int(steps[mixed >> 58, len(read) % fingerprints.PERIOD])
        read += [mixed & 15] * stay
    return len(read), [read[s] for s in fingerprints.sample_steps(len(read))] if read else []


def plain_likeness(a, b):
    """Share of the steps sampled for both texts at which they agree, beyond one in sixteen."""
    (na, sa), (nb, sb) = plain_walk(a), plain_walk(b)
    if (na, sa) == (nb, sb):
        return 1.0
    if not na or not nb:
        return 0.0
    ours, theirs = (dict(zip(fingerprints.sample_steps(n).tolist(), s)) for n, s in ((na, sa), (nb, sb)))
    share = sum(theirs.get(step) == v for step, v in ours.items()) / max(len(ours), len(theirs))
    return max(0.0, min(1.0, (share - 1 / 16) / (1 - 1 / 16)))


def test_walk_in_lockstep():
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcé日 ") for _ in range(rnd.choice([0, 1, 2, 50, 700, 9000]))) for _ in range(25)]
    for text, (taken, samples) in zip(texts, fingerprints.walk(texts), strict=True):
        assert (taken, samples.tolist()) == plain_walk(text)


def test_likeness_follows_edits():
    rnd = random.Random(9)
    near, far = [], []
    for _ in range(20):
        a = "".join(rnd.choice("abcdefghij ") for _ in range(2000))
        b = list(a)
        b[rnd.randrange(2000)] = "z"
        other = "".join(rnd.choice("abcdefghij ") for _ in range(2000))
        x, y, z = fingerprints.fingerprints([a, "".join(b), other])
        near.append(fingerprints.likeness(x, y))
        far.append(fingerprints.likeness(x, z))
    assert np.median(near) > 0.9
    assert np.median(far) < 0.15


def test_banded_links(spark):
    rnd = random.Random(10)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(1500)) for _ in range(40)]
    texts += [t[:700] + "z" + t[701:] for t in texts[:10]] + texts[:3]
    prints = [fingerprints.spelled(*f) for f in fingerprints.fingerprints(texts)]
    table = spark.createDataFrame(list(enumerate(prints)), "doc_id bigint, fingerprint string")
    linked = {(r.doc_id, r.leader) for r in fingerprints.near_links(table).collect()}
    assert all(leader == doc - 40 or (doc >= 50 and leader in (doc - 50,)) for doc, leader in linked)
    assert len({d for d, _ in linked}) >= 11


def joined(links):
    """Least member of each linked document's component."""
    least = {}

    def top(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        least[b] = a
    return {x: top(x) for x in least}


def test_bands_compare_more_than_leaders(spark):
    """Each band's least holder is unlike the others that hold it, which are alike."""
    rnd = random.Random(11)
    text = "".join(rnd.choice("0123456789abcdef") for _ in range(192))
    prints = []
    for band in range(24):
        other = "".join(rnd.choice("0123456789abcdef") for _ in range(192))
        prints.append(other[: band * 8] + text[band * 8 : band * 8 + 8] + other[band * 8 + 8 :])
    prints += [text, text, text[:100] + ("0" if text[100] != "0" else "1") + text[101:]]
    table = spark.createDataFrame([(i, "7d0:" + p) for i, p in enumerate(prints)], "doc_id bigint, fingerprint string")
    found = fingerprints.near_links(table).collect()
    assert joined((r.doc_id, r.leader) for r in found) == {24: 24, 25: 24, 26: 24}
    assert all(r.likeness >= 0.8 for r in found)


def test_short_texts_are_linked(spark):
    """Short texts are linked as comparing all pairs links them."""
    rnd = random.Random(12)
    texts = ["", "", "a", "a", "bc", "bc"]
    for _ in range(40):
        base = [rnd.choice("abcdefghij ") for _ in range(rnd.randint(1, 90))]
        texts.append("".join(base))
        texts.append("".join(base) + rnd.choice("xyz"))
        base[rnd.randrange(len(base))] = "z"
        texts.append("".join(base))
    own = fingerprints.fingerprints(texts)
    pairs = [(i, j) for j in range(len(own)) for i in range(j) if fingerprints.likeness(own[i], own[j]) >= 0.8]
    table = spark.createDataFrame([(i, fingerprints.spelled(*p)) for i, p in enumerate(own)], "doc_id bigint, fingerprint string")
    assert joined((r.doc_id, r.leader) for r in fingerprints.near_links(table).collect()) == joined(pairs)


def test_blocks_compare_all_in_a_band(spark, monkeypatch):
    rnd = random.Random(13)
    text = "".join(rnd.choice("0123456789abcdef") for _ in range(192))
    table = spark.createDataFrame([(i, "7d0:" + text[:i] + "0" + text[i + 1 :]) for i in range(30)], "doc_id bigint, fingerprint string")
    monkeypatch.setattr(fingerprints, "LIST", 4)
    assert set(joined((r.doc_id, r.leader) for r in fingerprints.near_links(table).collect()).values()) == {0}


def test_recall_of_long_texts(spark):
    """Bands find nine in ten of the pairs that comparing all fingerprints finds, also where likeness is just enough."""
    rnd = random.Random(14)
    texts = []
    for _ in range(30):
        base = [rnd.choice("abcdefghij klmno") for _ in range(rnd.randint(400, 3000))]
        for edits in (0, 1, 3, 10, 30, 80):
            new = list(base)
            for _ in range(edits):
                new[rnd.randrange(len(new))] = rnd.choice("xyz")
            texts.append("".join(new))
    own = fingerprints.fingerprints(texts)
    pairs = [(i, j) for j in range(len(own)) for i in range(j) if fingerprints.likeness(own[i], own[j]) >= 0.8]
    table = spark.createDataFrame([(i, fingerprints.spelled(*p)) for i, p in enumerate(own)], "doc_id bigint, fingerprint string")
    found = joined((r.doc_id, r.leader) for r in fingerprints.near_links(table).collect())
    caught = [found.get(i, i) == found.get(j, j) for i, j in pairs]
    assert len(pairs) > 100
    assert np.mean(caught) >= 0.9


def test_fingerprint_query_links(spark, docs, twice, no_docs, rows):
    found = fingerprints.with_near_ids(fingerprints.fingerprint_documents(docs)).collect()
    own = [(r[0], fingerprints.fingerprints([r[1] or ""])[0]) for r in rows]
    links = [(i, j) for n, (j, b) in enumerate(own) for i, a in own[:n] if fingerprints.likeness(a, b) >= 0.8]
    least = joined(links)
    assert {r.doc_id: r.near_id for r in found} == {i: least.get(i, i) for i, _ in own}
    again = fingerprints.with_near_ids(fingerprints.fingerprint_documents(twice))
    assert again.columns[-1] == "near_id"
    # the row of nulls is an empty text, whose least id counts
    empty = least[next(i for i, t, _ in rows if not t)]
    assert sorted((r.doc_id or 0, r.near_id) for r in again.collect()) == sorted([(r.doc_id, r.near_id) for r in found] * 2 + [(0, empty)])
    assert fingerprints.with_near_ids(fingerprints.fingerprint_documents(no_docs)).count() == 0
    assert "near_id" in catalog.op10_fingerprints(spark, "/root/testdata/sf0.001").columns


def plain_mixture(rows):
    """Copies of each document for targets that are the square roots of the sources' sizes."""
    size = defaultdict(int)
    for _, t, s in rows:
        size[s or ""] += len((t or "").encode()) + 1
    goal = {s: v**0.5 for s, v in size.items()}
    out = Counter()
    for i, _, s in rows:
        rate = goal[s or ""] / sum(goal.values()) * sum(size.values()) / size[s or ""]
        assert rate <= 32
        u, k = int(hashlib.sha256(f"mix|{i}|1".encode()).hexdigest()[:13], 16) / 2**52, 0
        p = total = math.exp(-rate)
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        out[i] += k
    return +out


def test_stages_keep_columns_of_the_user(spark):
    """Columns named like those that operators add pass through the stages unchanged."""
    docs, labels, _ = labelled(spark, 60)
    own = {"score": "s", "held_out": "h", "predicted": "p", "kept": "k", "keep_id": "i", "group_size": "g", "copy": "c", "n_copies": "n", "shuffle_key": "x", "component_id": "d"}
    docs = docs.select("doc_id", "text", F.lit("web").alias("source"), *[F.lit(v).alias(c) for c, v in own.items()])
    from lumaset.llm import exact_dedup, near_dups

    for made in (quality.keep_good(docs, labels), exact_dedup.drop_exact_copies(docs), near_dups.drop_near_duplicates(docs), mixing.mixture(docs)):
        assert made.columns == docs.columns
        assert made.select(*own).distinct().collect() == [tuple(own.values())]


def test_pipeline_stages_in_order(spark, monkeypatch):
    """Each stage against a plain version of it on the driver's smallest tables."""
    from test_dedup import expected_exact, expected_near
    from test_tokens import WORD, library_ids

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0].startswith("quality")
    state = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text, r.source) for r in state.collect()]
        after = corpus_pipeline.materialise(stage(spark, state, sf), f"test-{k}")
        got = after.collect()
        if k < 4:
            assert after.columns == docs.columns
        if k == 0:
            trees = quality.train(state, spark.read.parquet(f"{sf}/labels.parquet"))
            scores = {i: plain_score(trees, quality.statistics((t or "").encode())) for i, t, _ in before}
            assert sorted(r.doc_id for r in got) == sorted(i for i, s in scores.items() if s >= 0.3)
            good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
            assert len(good - {r.doc_id for r in got}) <= 0.05 * len(good)
        elif k == 1:
            assert sorted(r.doc_id for r in got) == sorted(i for i, e in expected_exact(before).items() if e[2])
        elif k == 2:
            assert sorted(r.doc_id for r in got) == sorted(i for i, e in expected_near(before, 5).items() if e[2])
        elif k == 3:
            assert Counter(r.doc_id for r in got) == plain_mixture(before)
            assert {(r.doc_id, r.text, r.source) for r in got} <= set(before)
        else:
            copies, unique = Counter(i for i, *_ in before), {i: t for i, t, _ in before}
            ids = {i: [*x, 0] for i, x in zip(unique, library_ids(WORD, list(unique.values())), strict=True)}
            want = Counter()
            for i, n in copies.items():
                for k in range(0, len(ids[i]), 2048):
                    part = np.array(ids[i][k : k + 2048], "<u4")
                    want[i, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += n
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
            ends = defaultdict(list)
            for r in got:
                ends[r.sequence_id].append((r.offset, r.offset + r.length))
            for places in ends.values():
                places.sort()
                assert places[0][0] == 0
                assert all(a[1] == b[0] for a, b in zip(places, places[1:]))
                assert places[-1][1] <= 2048
            assert len(ends) <= -(-sum(n * len(ids[i]) for i, n in copies.items()) // 2048) * 1.05 + 1
        state = after


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        duck.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    relation = duck.sql(catalog.ORACLE[name])
    at = [relation.columns.index(c) for c in columns]
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert ours == sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
