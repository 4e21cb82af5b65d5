"""Removal of byte strings that repeat: a truncated suffix sort on a content-chosen difference cover.

Sorting every suffix would shuffle tens of bytes for each byte of text.  Strings of a fixed width are all that
matters, so positions are sampled by content: in each window of that width the k-byte string with the least
fingerprint is its anchor.  Equal windows have their anchors at the same place, which is what a difference cover
provides for positions, with one sample in about seventy bytes.

1. Names of sampled suffixes are k-byte fingerprints; anchors whose name occurs once are dropped.
2. The windows of one anchor form a run; a run is named by the whole string that it spans.  Runs that share their
   name repeat as a whole.
3. Where runs share the anchor but not the name, the names are refined: runs are cut into blocks of sixteen
   windows, named by the string that the block spans and compared only if the part that all its windows share
   occurs again; blocks that differ are cut into single windows, which are merged by 128-bit fingerprints.
4. Intervals of repeated windows are merged per document and the bytes that they cover are cut out.

Equality of strings rests on fingerprints, 64 bits within one anchor and 128 for single windows, not on bytes.

Work on one name is grouped with map-side counts and joined back, so that a passage that many documents hold is
split over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, keyed, materialise, release
from .windows import Rolling, sliding_argmin

ITEM = "core bigint, name bigint, doc bigint, lo int, hi int, anchor int, sure boolean"
NAMES = ["core", "name", "doc", "lo", "hi", "anchor", "sure"]
OUT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
BLOCK = 16
#: Bytes of text that are scanned at once; longer texts are scanned in overlapping parts.
AT_ONCE = 1 << 20


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def items(core, name, doc, lo, hi, anchor, sure) -> pa.RecordBatch:
    columns = [signed(core), signed(name), pa.array(doc, pa.int64()), *(pa.array(x, pa.int32()) for x in (lo, hi, anchor)), pa.array(sure, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def scan_runs(x: np.ndarray, stops: np.ndarray, docs: np.ndarray, shifts: np.ndarray, width: int, k: int) -> pa.RecordBatch | None:
    """Runs of windows with one anchor in texts laid end to end; ``shifts`` is each text's place in its document."""
    if len(x) < width:
        return None
    starts = np.concatenate([[0], stops[:-1]])
    roll = Rolling(x, 0)
    anchors = roll.every(k)
    at = sliding_argmin(anchors, width - k + 1)
    text = np.searchsorted(stops, np.arange(len(at)), "right")
    valid = np.arange(len(at)) + width <= stops[text]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(at)) - 1
    keep = valid[lo]
    lo, hi = lo[keep], hi[keep]
    if not len(lo):
        return None
    q, t = at[lo], text[lo]
    name = Rolling(x, 1).of(lo, hi + width) ^ ((q - lo).astype(np.uint64) * np.uint64(0x9E3779B1) + (hi - lo).astype(np.uint64))
    base = starts[t] - shifts[t]
    return items(anchors[q], name, docs[t], lo - base, hi - base, q - base, np.zeros(len(lo), bool))


def runs(texts: DataFrame, width: int, k: int) -> DataFrame:
    """(core, name, doc, lo, hi, anchor, sure) of all runs; texts shorter than a window have none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, size = [], 0
            for key, body in [*zip(batch.column(0).to_pylist(), batch.column(1)), (None, None)]:
                if body is None or size >= AT_ONCE:
                    if group:
                        raw, docs, shifts = zip(*group)
                        found = scan_runs(np.concatenate(raw), np.cumsum([len(r) for r in raw]), np.array(docs), np.array(shifts), width, k)
                        if found is not None:
                            yield found
                    group, size = [], 0
                if body is None or not body.is_valid:
                    continue
                x = np.frombuffer(body.as_buffer(), np.uint8)
                for a in range(0, max(1, len(x) - width + 1), AT_ONCE):
                    part = x[a : a + AT_ONCE + width - 1]
                    if len(part) >= width:
                        # parts of one text are laid out as texts of their own
                        if size + len(part) > 3 * AT_ONCE:
                            raw, docs, shifts = zip(*group)
                            found = scan_runs(np.concatenate(raw), np.cumsum([len(r) for r in raw]), np.array(docs), np.array(shifts), width, k)
                            if found is not None:
                                yield found
                            group, size = [], 0
                        group.append((part, key, a))
                        size += len(part)

    return texts.mapInArrow(scan, ITEM)


def block_items(x: np.ndarray, todo: list, width: int) -> tuple:
    lo, hi, q = (np.array([t[f] for t in todo], np.int64) for f in ("lo", "hi", "anchor"))
    sure = np.array([t["sure"] for t in todo], bool)
    first, last = (q - hi) // BLOCK, (q - lo) // BLOCK
    which = np.repeat(np.arange(len(todo)), last - first + 1)
    number = np.arange(len(which)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[which]
    # windows by their distance to the anchor
    near = np.maximum(number * BLOCK, (q - hi)[which])
    far = np.minimum(number * BLOCK + BLOCK - 1, (q - lo)[which])
    a, b, q = q[which] - far, q[which] - near, q[which]
    shared = q - number * BLOCK
    core = Rolling(x, 0).of(shared, shared + width - BLOCK + 1)
    name = Rolling(x, 1).of(a, b + width) ^ (near.astype(np.uint64) * np.uint64(0x9E3779B1) + far.astype(np.uint64))
    return core, name, a, b, q, sure[which]


def window_items(x: np.ndarray, todo: list, width: int) -> tuple:
    lo, hi, q = (np.array([t[f] for t in todo], np.int64) for f in ("lo", "hi", "anchor"))
    sure = np.array([t["sure"] for t in todo], bool)
    n = hi - lo + 1
    which = np.repeat(np.arange(len(todo)), n)
    a = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return Rolling(x, 0).of(a, a + width), Rolling(x, 1).of(a, a + width), a, a, q[which], sure[which]


def cut_finer(texts: DataFrame, open_: DataFrame, width: int, cut) -> DataFrame:
    """Items of the next level for the runs or blocks of ``open_``, from their documents' texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, body, todo in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                core, name, lo, hi, q, sure = cut(np.frombuffer(body.as_buffer(), np.uint8), todo, width)
                yield items(core, name, np.full(len(lo), key), lo, hi, q, sure)

    todo = open_.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi", "anchor", "sure")).alias("todo"))
    return texts.join(todo, "doc").select("doc", "body", "todo").mapInArrow(work, ITEM)


def refine(found: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(intervals that repeat as a whole, one item of each name whose core has several names, some of them single).

    Counts are written before they are joined, so that both sides of a join are shuffled for it and Spark can split
    the rows of a name that is everywhere.
    """
    loc = F.struct("doc", "lo", "hi", "anchor")
    names = found.groupBy("core", "name").agg(F.count(F.lit(1)).alias("n"), F.max("sure").alias("known"), F.min(loc).alias("at"))
    names = materialise(names.select("core", "name", "at", ((F.col("n") > 1) | F.col("known")).alias("sure")), f"repeats-names-{level}")
    cores = names.groupBy("core").agg(F.count(F.lit(1)).alias("names"), F.min("sure").alias("all_sure")).where("names > 1 and not all_sure").select("core")
    cores = materialise(cores, f"repeats-cores-{level}")
    whole = found.where("not sure").join(names.where("sure").select("core", "name"), ["core", "name"], "left_semi").select("doc", "lo", "hi")
    whole = materialise(whole, f"repeats-whole-{level}")
    open_ = materialise(names.join(cores, "core", "left_semi").select("at.*", "sure"), f"repeats-open-{level}")
    discard(names, cores)
    return whole, open_


def repeated_windows(texts: DataFrame, width: int = 200, k: int = 64) -> DataFrame:
    """(doc, lo, hi): starts of all ``width``-byte strings that start anywhere else too, as intervals."""
    spark = texts.sparkSession
    often = materialise(runs(texts, width, k).select("core").groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "repeats-anchors")
    release(spark)
    found = materialise(runs(texts, width, k).join(often, "core", "left_semi"), "repeats-runs")
    discard(often)
    release(spark)
    parts = []
    for level, cut in enumerate((block_items, window_items)):
        whole, open_ = refine(found, level)
        parts.append(whole)
        discard(found)
        release(spark)
        found = materialise(cut_finer(texts, open_, width, cut), f"repeats-finer-{level}")
        discard(open_)
        release(spark)
    same = found.groupBy("core", "name").agg(F.count(F.lit(1)).alias("n"), F.max("sure").alias("known")).where("n > 1 or known").select("core", "name")
    same = materialise(same, "repeats-windows")
    parts.append(found.where("not sure").join(same, ["core", "name"], "left_semi").select("doc", "lo", "hi"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def cut_out(n: int, spans: list, width: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows whose starts are given as intervals."""
    if not spans:
        return []
    lo, hi = (np.array([s[f] for s in spans], np.int64) for f in ("lo", "hi"))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi + width, -1)
    covered = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
    turn = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, *, width: int = 200, k: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) of every row; ``kept`` is binary.

    Null texts are empty; texts shorter than ``width`` keep all bytes; copies, repeated rows too, lose all of
    theirs if they are as long as that.  Cut bytes can split characters, so the rest is not always valid UTF-8.
    Other columns of ``docs`` don't matter.  An empty table gives an empty result.  Long texts are scanned in parts; what
    repeats in one is refined and cut out with about 60 bytes of memory for each of its bytes.  Strings count as equal
    when two 64-bit fingerprints of different polynomials agree; they are not compared byte by byte.
    """
    if not BLOCK < width - k + 1 or k < 1 or width < 2 * BLOCK:
        raise ValueError("the width leaves too few places for anchors")
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body")), "id", "doc")
    texts = rows.select("doc", "body")
    spans = repeated_windows(texts, width, k).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = bytes(body.as_buffer())
                gone = cut_out(len(raw), found or [], width)
                edges = [0, *(e for g in gone for e in g), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(raw), sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest(), [{"start": a, "stop": b} for a, b in gone], kept))
            n, removed, count, sha, where, kept = zip(*out) if out else ([],) * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary())
            columns = [pa.array(v, kind) for v, kind in zip((n, removed, count, sha, where, kept), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *OUT, "spans", "kept"])

    kind = rows.select("id").dtypes[0][1]
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    joined = rows.join(spans, "doc", "left").select("id", "body", "spans")
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
