"""Near-duplicate documents by an inverted join on MinHash signature coordinates, confirmed on full shingle sets.

1. A document's set holds its distinct word shingles as 64-bit numbers; equal sets collapse to one representative.
2. A signature has COORDINATES coordinates, one MinHash value each.  Representatives are posted under each pair of
   coordinate and value.  Two that agree in MATCHES coordinates share a pair among the COORDINATES - MATCHES + 1
   rarest of either, so each is left in those lists alone.  Values that it alone has come first among the rarest and
   need no list; what shares fewer than MATCHES values with anyone is skipped as a whole.
3. The lists that are left are merged: for the members that meet in one, collisions over all coordinates are counted on
   their signatures.  What matches in MATCHES of them is linked; what is linked already is skipped, so a list of n
   gives at most n - 1 links.  Lists of over LIST members are compared block by block.
4. Links join into families, in which every pair over the threshold lies (but for one in ten million).  Within a
   family sets are compared exactly, again skipping what is linked; the links that hold give the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import keyed, materialise, partitions, release
from .windows import Rolling, mix

#: A pair of similarity 0.8 agrees in fewer than 32 of 64 coordinates in 1e-8 of cases.
COORDINATES, MATCHES = 64, 32
#: Members of a posting list, or of a family, that one task compares at most.
LIST, FAMILY = 4096, 4096
#: Documents in families up to which their ids (8 bytes each) are broadcast to the texts; beyond, both are shuffled.
BROADCAST_ROWS = 500_000
#: Bytes of text whose sets are made at once, unless a single text is longer.
AT_ONCE = 1 << 20
OUT = ("n_shingles", "component_id", "kept")
_rng = np.random.default_rng(20240917)
_A = (_rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(raw: list[np.ndarray], size: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text's bytes, sorted, end to end, and how many each has."""
    lengths = np.array([len(r) for r in raw], np.int64)
    x = _LOWER[np.concatenate(raw)] if raw else np.zeros(0, np.uint8)
    stops = np.cumsum(lengths)
    word = _WORD[x]
    head = np.zeros(len(x) + 1, bool)
    head[stops - lengths] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | head[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | head[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = Rolling(x, 0).of(begin, end) if len(begin) else np.zeros(0, np.uint64)
    bounds = np.searchsorted(begin, np.concatenate([[0], stops]), "left")
    counts = np.diff(bounds)
    if len(words) >= size:
        grams = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            grams = mix(grams + words[k : k + len(grams)] * np.uint64(0x9E3779B97F4A7C15))
    else:
        grams = np.zeros(0, np.uint64)
    out = []
    for a, n in zip(bounds[:-1].tolist(), counts.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(grams[a : a + n - size + 1]))
        elif n:
            whole = np.uint64(n)
            for w in words[a : a + n]:
                whole = mix(np.array([whole]) + w)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array([len(o) for o in out], np.int64)


def signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values, a row for each of the non-empty sets laid end to end."""
    offsets = np.cumsum(counts) - counts
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    values = np.empty((len(counts), COORDINATES), np.uint32)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        # the product's high bits depend on all of x, so they are mixed in before the least is taken
        y = x * a + b
        values[:, i] = np.minimum.reduceat(y ^ (y >> np.uint32(15)), offsets)
    return values


def grouped(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    lo = size = 0
    raw: list[np.ndarray] = []
    for i, body in enumerate(column):
        raw.append(np.frombuffer(body.as_buffer(), np.uint8) if body.is_valid and len(body.as_buffer()) else np.zeros(0, np.uint8))
        size += len(raw[-1])
        if size >= AT_ONCE:
            yield lo, i + 1, raw
            lo, size, raw = i + 1, 0, []
    if raw:
        yield lo, lo + len(raw), raw


def sign(texts: DataFrame, size: int) -> DataFrame:
    """(doc, same, n, signature, bytes): set digest, set size, MinHash values and a byte of each, of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw in grouped(batch.column(1)):
                shingles, counts = shingle_sets(raw, size)
                full = np.flatnonzero(counts)
                values = signatures(shingles, counts[full]) if len(full) else np.zeros((0, COORDINATES), np.uint32)
                low, ends = (values & np.uint32(255)).astype(np.uint8), np.cumsum(counts)
                rows = np.full(hi - lo, -1)
                rows[full] = np.arange(len(full))
                same = [hashlib.blake2b(shingles[e - n : e].tobytes(), digest_size=16).digest() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                sizes = pa.array(np.concatenate([[0], np.cumsum((counts > 0) * COORDINATES)]), pa.int32())
                columns = [
                    batch.column(0).slice(lo, hi - lo), pa.array(same, pa.binary()), pa.array(counts),
                    pa.ListArray.from_arrays(sizes, pa.array(values.view(np.int32).ravel())), pa.array([low[r].tobytes() if r >= 0 else b"" for r in rows.tolist()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "same", "n", "signature", "bytes"])

    return texts.mapInArrow(work, "doc bigint, same binary, n bigint, signature array<int>, bytes binary")


def walk_list(values: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links (i, j) that join what matches in ``least`` values, directly or through others."""
    links, rest = [], np.arange(len(values))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = (values[rest] == values[at]).sum(1) >= least
            near = rest[hit].tolist()
            links += [(at, j) for j in near]
            queue += near
            rest = rest[~hit]
    return links


def walk_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join sets with 100 * intersection >= percent * union, directly or through others."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    parts = [flat[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    mark = np.zeros(int(flat.max()) + 1, bool)
    links, rest = [], np.arange(len(sets))

    def lay(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        laid = np.concatenate([parts[i] for i in ids.tolist()]) if len(ids) else np.zeros(0, np.int64)
        return laid, np.cumsum(sizes[ids]) - sizes[ids]

    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        laid, offsets = lay(rest)
        while queue and len(rest):
            at = queue.pop()
            mark[parts[at]] = True
            common = np.add.reduceat(mark[laid], offsets, dtype=np.int64)
            mark[parts[at]] = False
            hit = 100 * common >= percent * (sizes[rest] + sizes[at] - common)
            near = rest[hit].tolist()
            if near:
                links += [(at, j) for j in near]
                queue += near
                rest = rest[~hit]
                laid, offsets = lay(rest)
    return links


def in_blocks(rows: DataFrame, group: str, count: str, most: int) -> DataFrame:
    """Rows under (group, i, j): one block for groups of up to ``most``; larger ones once for each pair of blocks."""
    blocks = F.ceil(F.col(count) / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("doc", F.lit(7)), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: (b != F.col("own")) | (F.col("blocks") == 1))
    rows = rows.withColumn("other", F.explode(other))
    return rows.select(group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *[c for c in rows.columns if c not in (group, count, "blocks", "own", "other")])


def per_group(rows: DataFrame, group: str, payload: str, solve) -> DataFrame:
    """Links (u, v) that ``solve`` finds among the payloads of each (group, i, j); a group is at hand as a whole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(docs: np.ndarray, raw: list) -> list[tuple[int, int]]:
            return [(int(docs[a]), int(docs[b])) for a, b in solve(raw)]

        key, docs, raw, out = None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [np.array(batch.column(i)) for i in range(3)]
            names, bodies = np.array(batch.column(3)), batch.column(4)
            new = np.ones(len(names), bool)
            new[1:] = (ids[0][1:] != ids[0][:-1]) | (ids[1][1:] != ids[1][:-1]) | (ids[2][1:] != ids[2][:-1])
            cuts = [*np.flatnonzero(new).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                own = (ids[0][a], ids[1][a], ids[2][a])
                if own != key:
                    if len(raw) > 1:
                        out += links(np.concatenate(docs), raw)
                    key, docs, raw = own, [], []
                docs.append(names[a:b])
                raw += [bodies[i].as_buffer() for i in range(a, b)]
            if len(out) > 10_000:
                yield as_links(out)
                out = []
        if len(raw) > 1:
            out += links(np.concatenate(docs), raw)
        yield as_links(out)

    dealt = rows.select(group, "i", "j", "doc", payload).repartition(partitions(rows.sparkSession), group, "i", "j")
    return dealt.sortWithinPartitions(group, "i", "j", "doc").mapInArrow(work, "u bigint, v bigint")


def as_links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def match_values(raw: list) -> list[tuple[int, int]]:
    return walk_list(np.stack([np.frombuffer(r, np.uint8) for r in raw]), MATCHES)


def match_sets(percent: int):
    return lambda raw: walk_sets([np.frombuffer(r, np.uint64) for r in raw], percent)


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw in grouped(batch.column(2)):
                shingles, counts = shingle_sets(raw, size)
                ends = np.cumsum(counts)
                sets = [shingles[e - n : e].tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["doc", "family", "set"])

    return texts.select("doc", "family", "body").mapInArrow(work, "doc bigint, family bigint, set binary")


def rarest_lists(signed: DataFrame) -> DataFrame:
    """(key, doc): the posting lists, each document in those of the rarest values among which any match must show."""
    key = F.shiftleft(F.col("coordinate").cast("bigint"), 32).bitwiseOR(F.col("value").cast("bigint").bitwiseAND(F.lit((1 << 32) - 1)))
    posted = signed.select("doc", F.posexplode("signature").alias("coordinate", "value")).select("doc", key.alias("key"))
    lists = materialise(posted.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "near-counts")
    # at most COORDINATES entries a document
    shared = posted.join(lists, "key").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("members", "key"))).alias("held")).where(F.size("held") >= MATCHES)
    # values that nobody else has come before all of these
    first = F.slice("held", F.lit(1), F.size("held") - (MATCHES - 1))
    return shared.select("doc", F.explode(first).alias("h")).select("h.key", "doc")


def families(signed: DataFrame) -> DataFrame:
    """(u, v): representatives that match in MATCHES values, directly or through others, with their family's least."""
    posted = materialise(rarest_lists(signed), "near-posted")
    lists = materialise(posted.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "near-sizes")
    members = materialise(posted.join(lists, "key"), "near-lists").join(signed.select("doc", "bytes"), "doc")
    return components(per_group(in_blocks(members, "key", "members", LIST), "key", "bytes", match_values), "near-families")


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Words are maximal runs of bytes other than space and 0x09 to 0x0D, after lower-casing A to Z.  Documents with
    fewer words than ``size`` have one shingle of all their words; documents without words, null texts too, have none
    and are linked with nothing.  Rows that repeat an id count as documents of their own with that id; kept rows are
    those whose id is their component's least, so that repeats of it stay together.  ``percent`` of at least 80 is
    what the signatures are laid out for.  Other columns of ``docs`` don't matter.
    """
    if percent < 80:
        raise ValueError("signatures are laid out for similarities of 0.8 and more")
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body")), "id", "doc")
    repeated = hasattr(rows, "_lumaset_path")
    spark = rows.sparkSession
    signed = materialise(sign(rows.select("doc", "body"), size), "near-signed")
    # aggregates are written before they are joined: then Spark can split what one set, list or family has too much of
    same = materialise(signed.where("n > 0").groupBy("same").agg(F.min("doc").alias("rep")), "near-same")
    reps = signed.join(same.select(F.col("rep").alias("doc")), "doc", "left_semi").select("doc", "signature", "bytes")
    close = families(reps)
    release(spark)
    # the least of each family belongs to it too
    member = close.select(F.col("u").alias("doc"), F.col("v").alias("family")).unionByName(close.select("v", "v").distinct().toDF("doc", "family"))
    member = materialise(member, "near-members")
    sizes = materialise(member.groupBy("family").agg(F.count(F.lit(1)).alias("members")), "near-sizes")
    chosen = F.broadcast(member) if member.count() <= BROADCAST_ROWS else member
    sets = full_sets(rows.select("doc", "body").join(chosen, "doc"), size)
    links = per_group(in_blocks(sets.join(sizes, "family"), "family", "members", FAMILY), "family", "set", match_sets(percent))
    joined = components(links, "near-components").select(F.col("u").alias("rep"), F.col("v").alias("least"))
    found = signed.select("doc", "same", F.col("n").alias("n_shingles")).join(same, "same", "left").join(joined, "rep", "left")
    found = found.select("doc", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("least", "rep")).otherwise(F.col("doc")).alias("component"))
    if repeated:
        found = found.join(rows.select("doc", "id"), "doc")
        least = found.groupBy("component").agg(F.min("id").alias("component_id"))
        found = found.join(least, "component").select("id", "n_shingles", "component_id")
    else:
        found = found.select(F.col("doc").cast(rows.select("id").dtypes[0][1]).alias("id"), "n_shingles", F.col("component").alias("component_id"))
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component, one for each component where ids are unique."""
    id_col = options.get("id_col", "doc_id")
    kept = near_duplicates(docs, **options).where("kept").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
