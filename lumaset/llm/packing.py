"""Best-fit packing with certified bin counts.

Partitions pack their pieces by best-fit decreasing.  Dual feasible functions bound the number of bins from below;
a partition whose count meets its bound keeps its well-filled bins, one with a gap gives up every bin that is not
full.  What partitions give up is exchanged: dealt into partitions of the same size and packed again, for as long as
that saves bins.  No round runs in one task unless the rest is one partition's.  Only piece lengths move; texts and
ids don't.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import materialise

#: Pieces that a partition packs at most (hashing spreads them unevenly by a little).
ROWS_EACH = 50_000
#: A round must save one of so many of the bins that were given up to it, else it is the last.
WORTH = 500
#: A certified partition gives up bins with more room than this share, while others can still use it.
ROOM = 1 / 16
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins needed at least: the best of two families of dual feasible functions over the lengths.

    The first rounds lengths up to all and down to none around a threshold and keeps those between; the second
    rounds k + 1 times a length to multiples of the capacity.  Each, summed, bounds the bins from below.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    weight = count * np.arange(capacity + 1)
    upto, sums = np.cumsum(count), np.cumsum(weight)
    eps = np.arange(1, capacity // 2 + 1)
    large = upto[-1] - upto[capacity - eps]
    between = sums[capacity - eps] - sums[eps - 1]
    best = int((large + -(-between // capacity)).max(initial=0))
    best = max(best, int(-(-sums[-1] // capacity)))
    values = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 65):
        scaled = (k + 1) * values
        exact = scaled % capacity == 0
        # in units of 1 / (k * capacity)
        bound = int((count * np.where(exact, values * k, scaled // capacity * capacity)).sum())
        best = max(best, -(-bound // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the room left in each bin.

    Open bins are listed by their room; one big integer has a bit for each room that occurs, so the smallest room
    that is large enough is found by shifting.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    mask = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            where = stacks[room].pop()
            if not stacks[room]:
                mask ^= 1 << room
        else:
            room, where = capacity, len(rooms)
            rooms.append(capacity)
        bins[i], offsets[i] = where, capacity - room
        left = rooms[where] = room - size
        if left:
            if not stacks[left]:
                mask |= 1 << left
            stacks[left].append(where)
    return bins, offsets, np.array(rooms, np.int64)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, *, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of ``capacity`` ids at most of each document's ids and end id; null texts are empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(vocabulary)
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, texts in bpe.slices(batch.column(1), 1 << 20):
                ids, counts = bpe.with_end(*enc.encode(texts), end)
                raw = memoryview(ids.astype("<u4").tobytes())
                pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(hi - lo), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(capacity, counts[doc] - start)
                at = (np.cumsum(counts) - counts)[doc] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                columns = [keys.take(pa.array(doc + lo)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(encode, PIECES)


def solver(capacity: int, room: int, level: int, last: bool):
    """Packs one partition and marks the bins that it gives up."""

    def solve(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "start"], kind="stable", na_position="first").reset_index(drop=True)
        sizes = group["length"].to_numpy()
        bins, offsets, left = best_fit_decreasing(sizes, capacity)
        certified = len(left) == lower_bound(sizes, capacity)
        given_up = np.zeros(len(left), bool) if last else left > (room if certified else 0)
        group["sequence_id"] = (np.int64(level) << 56) + (np.int64(key[0]) << 28) + bins
        group["offset"] = offsets
        group["open"] = given_up[bins]
        return group.drop(columns="part")

    return solve


def pack(pieces: DataFrame, capacity: int, *, rows_each: int = ROWS_EACH) -> DataFrame:
    """The rows of ``pieces`` (a written table; of 1 to ``capacity`` ids) with sequence_id and offset.

    A sequence's id tells the round, the partition and the bin that it comes from.  Every round deals the pool into
    partitions of about ``rows_each`` rows.  The last is the one that packs a single partition, or that saves less
    than one in WORTH of the bins which were given up to it; bins get fewer each round, so there is a last one.
    """
    done, level, given_up = [], 0, None
    pool, parts = pieces, max(1, -(-pieces.count() // rows_each))
    while True:
        last = parts == 1
        room = 0 if last else int(capacity * ROOM)
        schema = f"{PIECES}, sequence_id bigint, offset bigint, open boolean"
        # rows of a written table have numbers that stay; ids repeat and would meet in one partition
        dealt = pool.withColumn("part", F.pmod(F.xxhash64(F.lit(level), F.monotonically_increasing_id()), F.lit(parts)).cast("bigint"))
        packed = materialise(dealt.groupBy("part").applyInPandas(solver(capacity, room, level, last), schema), f"packed-{level}")
        used, open_bins, open_rows = packed.agg(F.countDistinct("sequence_id"), F.countDistinct(F.when(F.col("open"), F.col("sequence_id"))), F.count_if("open")).first()
        if last or not open_rows or (given_up is not None and given_up - used < max(1, given_up // WORTH)):
            done.append(packed.drop("open"))
            break
        done.append(packed.where("not open").drop("open"))
        pool, given_up, level = packed.where("open").select(*pieces.columns), open_bins, level + 1
        parts = -(-open_rows // rows_each)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, *, end: int = 0, rows_each: int = ROWS_EACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of all rows.

    Null and empty texts are one piece of one id, the end id.  Rows that repeat an id, or are alike, are packed each.
    Only documents longer than ``capacity`` are cut; long texts are encoded in parts.  Ties of length go by id and
    place.  An empty table gives no rows.  Other columns of ``docs`` don't matter.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = materialise(token_pieces(docs, vocabulary, capacity, end=end, id_col=id_col, text_col=text_col), "pieces")
    return pack(pieces, capacity, rows_each=rows_each)


def certificate(packed: DataFrame, capacity: int) -> tuple[int, int]:
    """(sequences used, sequences needed at least), from counts by length, at most ``capacity`` rows."""
    used = packed.select("sequence_id").distinct().count()
    rows = packed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        return used, 0
    return used, lower_bound(np.repeat([r["length"] for r in rows], [r["n"] for r in rows]), capacity)
