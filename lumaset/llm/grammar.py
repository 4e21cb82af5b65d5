"""Token-id shards compressed by Re-Pair, and reading them back.

Per shard the frequent neighbouring id pairs are replaced by new ids, again and again until no pair occurs LEAST
times.  A round replaces many pairs at once, chosen by falling count so that no two of their occurrences overlap (no
id is the left part of one and the right part of another); of a run of one id, every other position is replaced.
A shard stores the rules, the length each id expands to, the sequence, the documents' places and, every EVERY
symbols, the place that the sequence has reached, so that a reader expands any document without the others.

Shard layout, little-endian: 8 bytes ``LSGRAM02``; unsigned 64-bit: first nonterminal, rules, symbols, documents, bytes
of a symbol (2 or 4), EVERY; rules (2 x u32); expansion lengths of the rules (u32); symbols; document ids (i64);
documents' starts and the end of the last (u64); checkpoints (u64).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, ordered
from .shared import materialise, partitions

MAGIC = b"LSGRAM02"
HEAD = struct.Struct("<8s6Q")
#: Occurrences that a pair needs to be replaced, and symbols between checkpoints.
LEAST, EVERY = 8, 1024
#: Characters of text in a shard, but for one longer text.
SHARD_CHARS = 1 << 22


class Line:
    """A sequence whose ids keep their places while pairs are merged; the place behind the last is never live."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        places = np.arange(-1, n + 2, dtype=np.int32 if n < 2**31 - 2 else np.int64)
        self.ids = np.append(seq, np.uint32(0))
        self.next, self.before = places[2:].copy(), places[:-2].copy()
        self.next[n], self.before[0] = n, n
        self.live = np.ones(n + 1, bool)
        self.live[n] = False

    def merge(self, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Put ``ids`` in place of the pairs that start ``at``, ascending; returns the places at which other pairs start now."""
        gone = self.next[at]
        after = self.next[gone]
        self.ids[at], self.live[gone], self.next[at], self.before[after] = ids, False, after, at
        ahead = self.before[at]
        return np.concatenate([at, ahead[self.without(ahead, at)]])

    def without(self, places: np.ndarray, changed: np.ndarray) -> np.ndarray:
        """Which of the places are live and not ``changed`` (which are live)."""
        self.live[changed] = False
        kept = self.live[places]
        self.live[changed] = True
        return kept

    def pairs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places at which pairs start, left ids, right ids)."""
        places = places[self.live[places]]
        right = self.next[places]
        inner = self.live[right]
        if not inner.all():
            places, right = places[inner], right[inner]
        return places, self.ids[places], self.ids[right]


def pair_groups(places: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of pairs that occur ``least`` times, left * 2**32 + right; the places of each, key by key; how many)."""
    if not len(places):
        return np.zeros(0, np.uint64), places, np.zeros(0, np.int64)
    wide, deep = int(max(left.max(), right.max())).bit_length(), int(places.max()).bit_length()
    if 2 * wide + deep <= 64:
        # key and place in one number: sorted faster than an order is found
        wide, deep = np.uint64(wide), np.uint64(deep)
        both = (((left.astype(np.uint64) << wide) | right) << deep) | places.astype(np.uint64)
        both.sort()
        keys, places = both >> deep, (both & ((np.uint64(1) << deep) - np.uint64(1))).astype(np.int64)
    else:
        wide = np.uint64(32)
        keys = (left.astype(np.uint64) << wide) | right
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    counts = np.diff(edges)
    often = counts >= least
    keys = keys[edges[:-1][often]]
    return ((keys >> wide) << np.uint64(32)) | (keys & ((np.uint64(1) << wide) - np.uint64(1))), places[np.repeat(often, counts)], counts[often]


def chosen_pairs(keys: np.ndarray) -> np.ndarray:
    """Which keys (left * 2**32 + right) are replaced together: left and right ids are disjoint sets, first come first served."""
    lefts, rights = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = int(max(lefts.max(initial=-1), rights.max(initial=-1))) + 1
    is_left, is_right = bytearray(n), bytearray(n)
    take = np.zeros(len(keys), bool)
    for i, (a, b) in enumerate(zip(lefts.tolist(), rights.tolist())):
        if not is_right[a] and not is_left[b]:
            is_left[a] = is_right[b] = take[i] = True
    return take


def replace_runs(line: Line, same: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, places where pairs changed) for ids next to themselves, which start at ``same``: every other place of a run stands for two."""
    none = np.zeros((0, 2), np.uint32), np.zeros(0, np.int64)
    if not len(same):
        return none
    same = np.unique(same)
    first = np.flatnonzero(np.concatenate([[True], line.next[same[:-1]] != same[1:]]))
    lengths = np.diff(np.append(first, len(same)))
    ids, which = np.unique(line.ids[same[first]], return_inverse=True)
    often = np.bincount(which, (lengths + 1) // 2, len(ids)) >= least
    if not often.any():
        return none
    number = np.cumsum(often) - 1
    within = np.arange(len(same)) - np.repeat(first, lengths)
    which = np.repeat(which, lengths)
    hit = often[which] & (within % 2 == 0)
    return np.stack([ids[often], ids[often]], 1).astype(np.uint32), line.merge(same[hit], top + number[which[hit]])


def compress(seq: np.ndarray, first: int, *, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Rules (n x 2; rule i defines id first + i) and the sequence, in which no pair occurs ``least`` times any more.

    Only pairs with an id made since the last count are counted, runs likewise: others just get rarer, so of those the
    frequent ones wait with their places.
    """
    line, rules, top = Line(seq.astype(np.uint32)), [np.zeros((0, 2), np.uint32)], first
    by_runs, by_pairs = np.zeros(0, np.int64), np.arange(len(seq))
    keys, counts, at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        fresh = line.pairs(by_pairs)
        again, left, right = line.pairs(by_runs)
        made, by_runs = replace_runs(line, np.concatenate([fresh[0][fresh[1] == fresh[2]], again[left == right]]), top, least)
        if len(made):
            rules.append(made)
            top += len(made)
            kept = line.without(fresh[0], by_runs)
            fresh = [np.concatenate([old[kept], new]) for old, new in zip(fresh, line.pairs(by_runs))]
            kept = line.without(at, by_runs)
            counts, at = np.bincount(np.repeat(np.arange(len(keys)), counts)[kept], minlength=len(keys)), at[kept]
        other = fresh[1] != fresh[2]
        if not other.all():
            fresh = [part[other] for part in fresh]
        keys, at, counts = map(np.concatenate, zip((keys, at, counts), pair_groups(*fresh, least)))
        often = np.flatnonzero(counts >= least)
        often = often[np.lexsort((keys[often], -counts[often]))]
        chosen = often[chosen_pairs(keys[often])]
        if not len(made) and not len(chosen):
            break
        rules.append(np.stack([keys[chosen] >> np.uint64(32), keys[chosen] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        number = np.zeros(len(keys), np.int64)
        number[chosen] = top + np.arange(len(chosen))
        top += len(chosen)
        numbers = np.repeat(number, counts)
        hit = np.flatnonzero(numbers)
        # by ascending places, which memory is read along; ids have 32 bits
        both = np.sort((at[hit].astype(np.uint64) << np.uint64(32)) | numbers[hit].astype(np.uint64))
        by_pairs = line.merge((both >> np.uint64(32)).astype(np.int64), both & np.uint64(0xFFFFFFFF))
        waits = (counts >= least) & (number == 0)
        left_over = np.flatnonzero(np.repeat(waits, counts))
        kept = line.without(at[left_over], by_pairs)
        keys, at, counts = keys[waits], at[left_over[kept]], counts[waits]
        counts = np.bincount(np.repeat(np.arange(len(keys)), counts)[kept], minlength=len(keys))
    return np.concatenate(rules), line.ids[line.live]


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Ids that each rule's id stands for; a rule uses earlier ids only."""
    lengths = np.ones(len(rules), np.uint32)
    a, b = rules[:, 0].astype(np.int64) - first, rules[:, 1].astype(np.int64) - first
    of = lambda x: np.where(x < 0, 1, lengths[np.maximum(x, 0)])
    while True:
        new = (of(a) + of(b)).astype(np.uint32)
        if (new == lengths).all():
            return lengths
        lengths = new


def unrolled(seq: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that a sequence stands for, one level of rules after the other."""
    seq = seq.astype(np.uint32)
    while len(rules):
        inner = seq >= first
        if not inner.any():
            break
        ends = np.cumsum(np.where(inner, 2, 1))
        out = np.empty(ends[-1], np.uint32)
        rule = rules[seq[inner].astype(np.int64) - first]
        out[ends[~inner] - 1] = seq[~inner]
        out[ends[inner] - 2], out[ends[inner] - 1] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


def expand(seq: np.ndarray, rules: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
    """The ids that a sequence stands for, gathered from the rules' expansions where those are shorter than the result."""
    sizes = widths(seq, lengths, first)
    total, known = int(sizes.sum()), int(lengths.sum())
    if not known or known > total:
        return unrolled(seq, rules, first)
    flat = np.concatenate([np.arange(first, dtype=np.uint32), unrolled(np.arange(first, first + len(rules)), rules, first)])
    starts = np.concatenate([np.arange(first), first + np.cumsum(lengths, dtype=np.int64) - lengths])
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts[seq] - before, sizes) + np.arange(total)]


def widths(symbols: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """Ids that each symbol stands for."""
    out = np.ones(len(symbols), np.int64)
    inner = symbols >= first
    out[inner] = lengths[symbols[inner].astype(np.int64) - first]
    return out


@dataclass
class Shard:
    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    doc_ids: np.ndarray
    starts: np.ndarray
    checkpoints: np.ndarray
    every: int = EVERY

    def to_bytes(self) -> bytes:
        wide = 2 if len(self.rules) + self.first <= 1 << 16 else 4
        head = HEAD.pack(MAGIC, self.first, len(self.rules), len(self.symbols), len(self.doc_ids), wide, self.every)
        parts = [self.rules.astype("<u4"), self.lengths.astype("<u4"), self.symbols.astype(f"<u{wide}"), self.doc_ids.astype("<i8"), self.starts.astype("<u8"), self.checkpoints.astype("<u8")]
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Shard":
        magic, first, n_rules, n_symbols, n_docs, wide, every = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a grammar shard")
        kinds = (("<u4", 2 * n_rules), ("<u4", n_rules), (f"<u{wide}", n_symbols), ("<i8", n_docs), ("<u8", n_docs + 1), ("<u8", -(-n_symbols // every)))
        if HEAD.size + sum(np.dtype(kind).itemsize * n for kind, n in kinds) != len(raw):
            raise ValueError("a grammar shard is cut short")
        at, out = HEAD.size, []
        for kind, n in kinds:
            out.append(np.frombuffer(raw, kind, n, at))
            at += out[-1].nbytes
        return cls(first, out[0].reshape(-1, 2), *out[1:], every)

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.first, self.lengths)

    def document(self, ordinal: int) -> np.ndarray:
        """Ids of one document, from the checkpoint before it and the symbols up to its end."""
        start, stop = int(self.starts[ordinal]), int(self.starts[ordinal + 1])
        first = int(np.searchsorted(self.checkpoints, start, "right")) - 1
        last = int(np.searchsorted(self.checkpoints, stop, "left"))
        near = self.symbols[first * self.every : last * self.every]
        ends = int(self.checkpoints[first]) + np.cumsum(widths(near, self.lengths, self.first))
        lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skip = start - int(ends[lo - 1] if lo else self.checkpoints[first])
        return unrolled(near[lo:hi], self.rules, self.first)[skip : skip + stop - start]


def encode_shard(doc_ids: np.ndarray, ids: np.ndarray, counts: np.ndarray, first: int, *, every: int = EVERY, **options) -> Shard:
    """A shard of documents laid end to end, ``counts`` ids each."""
    rules, symbols = compress(ids.astype(np.uint32), first, **options)
    lengths = expansion_lengths(rules, first)
    ends = np.cumsum(widths(symbols, lengths, first))
    checkpoints = np.concatenate([[0], ends])[:-1][::every] if len(symbols) else np.zeros(0, np.int64)
    return Shard(first, rules, lengths, symbols, doc_ids, np.concatenate([[0], np.cumsum(counts)]), checkpoints, every)


def write_shards(docs: DataFrame, vocabulary: str, first: int, end: int, *, id_col: str = "doc_id", text_col: str = "text", rows_each: int = 4096, shard_chars: int = SHARD_CHARS, least: int = LEAST) -> DataFrame:
    """Shards in ascending id order: (bucket, shard, n_docs, n_ids, n_symbols, body), written to the shared folder.

    ``first`` is the first nonterminal, the vocabulary's size at least.  Null texts are empty, null ids come first,
    equal ids are in order of their texts.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    starts = ordered.bounds(rows, "id", ordered.range_count(rows, rows_each, partitions(docs.sparkSession)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, place, number = bpe.encoder(vocabulary), None, 0
        group, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal group, size, number
            if group:
                keys, ids, counts = (np.concatenate(x) for x in zip(*group, strict=True))
                shard = encode_shard(keys, ids, counts, first, least=least)
                values = (place, number, len(keys), len(ids), len(shard.symbols))
                group, size, number = [], 0, number + 1
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in values), pa.array([shard.to_bytes()], pa.binary())], names=["bucket", "shard", "n_docs", "n_ids", "n_symbols", "body"])

        for batch in batches:
            places = np.array(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)] if len(places) else []
            for a, b in zip(cuts, cuts[1:]):
                if places[a] != place:
                    yield from out()
                    place, number = int(places[a]), 0
                keys = np.array(batch.column(1).slice(a, b - a).fill_null(-(2**63)))
                for lo, hi, texts in bpe.slices(batch.column(2).slice(a, b - a), shard_chars // 4):
                    group.append((keys[lo:hi], *bpe.with_end(*enc.encode(texts), end)))
                    size += sum(map(len, texts))
                    if size >= shard_chars:
                        yield from out()
        yield from out()

    placed = rows.select(ordered.bucket(F.col("id"), starts).cast("int").alias("bucket"), "id", "body")
    # the range's number is the task's: nothing has to be sampled
    dealt = placed.repartitionById(len(starts) + 1, "bucket").sortWithinPartitions("bucket", "id", "body")
    dealt = dealt.select(F.col("bucket").cast("bigint"), "id", "body")
    return materialise(dealt.mapInArrow(encode, "bucket bigint, shard bigint, n_docs bigint, n_ids bigint, n_symbols bigint, body binary"), "grammar-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, bucket, shard) decoded from the written shards."""
    # one row for each bucket reaches the driver: as many as tasks wrote
    totals = sorted((r["bucket"], r["n"]) for r in shards.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect())
    base, run = [], 0
    for where, n in totals:
        base.append((where, run))
        run += n
    bases = shards.sparkSession.createDataFrame(base, "bucket bigint, base bigint")
    order = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("bucket", "shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before")).join(bases, "bucket")
    offsets = offsets.select("bucket", "shard", (F.col("base") + F.col("before")).alias("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, n, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                shard = Shard.from_bytes(body)
                raw = memoryview(shard.ids().astype("<u4").tobytes())
                edges = shard.starts.astype(np.int64)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                m = len(crc)
                columns = [np.full(m, where), np.full(m, n), shard.doc_ids, edges[:-1], np.diff(edges), np.array(crc, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    docs = shards.select("bucket", "shard", "body").mapInArrow(decode, "bucket bigint, shard bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)).cast("bigint"), F.col("doc_id")))
    joined = docs.join(offsets, ["bucket", "shard"])
    return joined.select("doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "bucket", "shard")


def token_shards(docs: DataFrame, vocabulary: str, first: int, end: int = 0, **options) -> DataFrame:
    """Encode, compress, write, read back: see ``read_shards``.

    Every row counts, repeated ones too; an empty table gives no shards and no rows.
    """
    return read_shards(write_shards(docs, vocabulary, first, end, **options))
