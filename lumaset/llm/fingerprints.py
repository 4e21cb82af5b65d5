"""Document fingerprints by randomised edit embedding.

A walk over a text reads, at each step, the character under its cursor and moves on or stays, as a shared random
bit of the step and the character says.  The characters read, in step order, form an embedding in which texts at a
small edit distance meet again after each edit, so that their Hamming distance is small.  A fingerprint samples the
embedding at shared random steps, four bits each; fingerprints are banded to find candidates, and candidates are
verified on all samples.  All texts of a batch walk in lockstep.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered
from .components import components
from .near_dups import LIST, in_blocks, per_group
from .shared import keyed, materialise, partitions, release
from .windows import mix

#: Samples in a fingerprint, random bits before they recur, classes of characters that share them.
SAMPLES, PERIOD, CLASSES = 192, 4096, 64
#: Code points that walk at once, unless a single text is longer.
AT_ONCE = 1 << 23
#: Steps up to which embeddings are cut into blocks of three, of four; samples from which they have bands in rows.
SHORTEST, SHORT, LONG = 15, 240, 150
#: Fingerprints that others equal or are linked with, up to which they (about 110 bytes each) are broadcast.
BROADCAST_ROWS = 100_000
_tables: dict = {}


def _steps() -> np.ndarray:
    """Steps that a character of a class takes from a step on: one more than the zero bits that come first."""
    if "steps" not in _tables:
        bits = np.random.default_rng(20240601).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
        bits[:, PERIOD - 1] = True
        steps = np.ones((CLASSES, PERIOD), np.int64)
        for at in range(PERIOD - 2, -1, -1):
            steps[:, at] = np.where(bits[:, at], 1, steps[:, at + 1] + 1)
        _tables["steps"] = steps.ravel()
    return _tables["steps"]


def _sampled(scale: int) -> np.ndarray:
    """Steps below 2**scale that come first in a shared random order, in that order.

    Each range [2**b, 2**(b+1)) contributes its 4 * SAMPLES first steps; their places in the order are drawn as the
    least of as many uniform numbers as the range has steps.
    """
    if ("sampled", scale) not in _tables:
        steps, places = [np.zeros(1, np.int64)], [np.random.default_rng(7).random(1)]
        for b in range(scale):
            rng, size = np.random.default_rng([11, b]), 1 << b
            m = min(size, 4 * SAMPLES)
            if m == size:
                steps.append(size + np.arange(size))
                places.append(rng.random(size))
            else:
                picked = np.unique(rng.integers(0, size, 2 * m))
                steps.append(size + rng.permutation(picked)[:m])
                places.append(np.cumsum(rng.exponential(size=m)) / size)
        steps, places = np.concatenate(steps), np.concatenate(places)
        _tables["sampled", scale] = steps[np.argsort(places, kind="stable")]
    return _tables["sampled", scale]


def sample_steps(length: int) -> np.ndarray:
    """The first SAMPLES steps below ``length`` in the shared order; all of them where there are fewer."""
    order = _sampled(max(1, (max(1, length) - 1).bit_length()))
    return order[order < length][:SAMPLES]


def walk(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(steps taken, four-bit samples in the shared order) of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(-lengths, kind="stable")
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = mix(cps.astype(np.uint64) + np.uint64(1))
    rows = (mixed >> np.uint64(58)).astype(np.int64) * PERIOD
    nibbles = (mixed & np.uint64(15)).astype(np.uint8)
    base = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = _steps()
    at = np.empty(len(cps), np.int64)
    now = np.zeros(len(texts), np.int64)
    # texts are in order of falling length, so those that still walk come first
    still = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
    for i, n in enumerate(still.tolist()):
        place, step = base[:n] + i, now[:n]
        at[place] = step
        now[:n] = step + steps[rows[place] + (step & (PERIOD - 1))]
    out: list = [None] * len(texts)
    for k, (text, b, size) in enumerate(zip(order.tolist(), base.tolist(), sizes.tolist(), strict=True)):
        taken = int(now[k])
        if not size:
            out[text] = (0, np.zeros(0, np.uint8))
            continue
        read = np.searchsorted(at[b : b + size], sample_steps(taken), "right") - 1
        out[text] = (taken, nibbles[b + read])
    return out


def spelled(taken: int, samples: np.ndarray) -> str:
    return f"{taken:x}:" + "".join("0123456789abcdef"[v] for v in samples.tolist())


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    out, batch, size = [], [], 0
    for text in [*texts, None]:
        if batch and (text is None or size + len(text) > AT_ONCE):
            out += walk(batch)
            batch, size = [], 0
        if text is not None:
            batch.append(text)
            size += len(text)
    return out


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of samples that agree beyond chance, of the samples of the longer embedding; 1 for equal fingerprints."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    if not len(a[1]) or not len(b[1]):
        return 0.0
    if a[0] == b[0]:
        agree = int((a[1] == b[1]).sum())
    else:
        _, i, j = np.intersect1d(sample_steps(a[0]), sample_steps(b[0]), assume_unique=True, return_indices=True)
        agree = int((a[1][i] == b[1][j]).sum())
    share = agree / max(len(a[1]), len(b[1]))
    return max(0.0, min(1.0, (share - 1 / 16) / (1 - 1 / 16)))


def next_rows(docs: DataFrame, id_col: str, text_col: str, rows_each: int = 2048) -> DataFrame:
    """(bucket, extra, id, body) sorted so that each row's next is the following one, by descending id.

    Ranges of ids are dealt to tasks; each range ends with a copy (``extra``) of the first row of the next range,
    the last range with the first row of all.  Equal ids are in order of their texts; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    starts = ordered.bounds(rows, "id", ordered.range_count(rows, rows_each, partitions(spark)))
    where = ordered.bucket(F.col("id"), starts)
    lowest = F.lit(-(2**63)).cast("bigint")
    # one row for each range
    tops = sorted((r["b"], r["top"]) for r in rows.groupBy(where.alias("b")).agg(F.max(F.coalesce("id", lowest)).alias("top")).collect())
    wanted = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    halo = F.broadcast(spark.createDataFrame(wanted, "top bigint, bucket int"))
    extra = rows.join(halo, F.coalesce("id", lowest) == F.col("top")).select("bucket", F.lit(True).alias("extra"), "id", "body")
    placed = rows.select(where.alias("bucket"), F.lit(False).alias("extra"), "id", "body").unionByName(extra)
    # the range's number is the task's: nothing has to be sampled
    dealt = placed.withColumn("bucket", F.col("bucket").cast("int")).repartitionById(len(starts) + 1, "bucket")
    return dealt.sortWithinPartitions("bucket", "extra", F.col("id").desc_nulls_last(), "body")


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last half of its code points replaced by as many first ones of the next document by
    descending id.  Null texts are empty; an empty text's fingerprint is ``0:``, which only equals itself.  A table
    of one row is its own next.  Rows that repeat an id come in order of their texts.  Other columns don't matter.
    A text walks whole, whatever its length: one step of the batch for each of its characters, 30 bytes of memory each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = held + list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            lo, size = 0, 0
            for i in range(len(rows)):
                size += len(rows[i][3])
                if size > AT_ONCE // 2 and i > lo:
                    yield paired(rows[lo : i + 1])
                    lo, size = i, len(rows[i][3])
            if len(rows) - lo > 1:
                yield paired(rows[lo:])
            held = rows[-1:]

    def paired(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[3] for r in rows]
        # what is a copy has no next one here; several copies of a range's first id may follow each other
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1]]
        edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in pairs]
        own, other = fingerprints(texts), fingerprints(edited)
        out = [
            (rows[i][2], len(texts[i]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), spelled(*own[i]), spelled(*o), likeness(own[i], o), likeness(own[i], own[i + 1]))
            for i, e, o in zip(pairs, edited, other, strict=True)
        ]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    return next_rows(docs, id_col, text_col).mapInArrow(work, schema)


def packed(fingerprint: Column) -> Column:
    """A spelled fingerprint as bytes: eight for the steps taken, then two samples in each."""
    samples = F.substring_index(fingerprint, ":", -1)
    even = F.when(F.length(samples) % 2 == 1, F.concat(samples, F.lit("0"))).otherwise(samples)
    return F.unhex(F.concat(F.lpad(F.substring_index(fingerprint, ":", 1), 16, "0"), even))


def unpacked(raw) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(raw, np.uint8)
    taken = int.from_bytes(raw[:8].tobytes(), "big")
    samples = np.stack([raw[8:] >> 4, raw[8:] & 15], 1).ravel()
    return taken, samples[: min(taken, SAMPLES)]


@functools.lru_cache(1 << 13)
def _places(taken: int, bands: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(tag of each band, places in the fingerprint of its samples) for embeddings of ``taken`` steps.

    Tags are of step numbers, so that embeddings of unequal length share bands.  Long ones have bands of ``width``
    samples in a row of the shared order, from the ``bands`` steps of least hash on.  Short ones, whose samples are
    all steps, are cut into blocks of so few steps that more lie below the shorter length than may disagree.
    """
    order = sample_steps(taken)
    out = []
    if len(order) >= LONG:
        starts = np.argsort(mix(order[: len(order) - width + 1].astype(np.uint64)), kind="stable")[:bands]
        out.append((0, order[starts], starts[:, None] + np.arange(width)))
    blocks = []
    if taken <= SHORTEST:
        blocks.append((1, np.arange(taken // 3)[:, None] * 3 + np.arange(3)))
    if 4 <= taken <= SHORT:
        # whole windows of 16 steps are cut into strides; the windows that a text as like may end in also into runs
        full, tail = np.arange(taken // 16 * 4), np.arange(int(0.8125 * taken) // 16 * 4, taken // 4)
        blocks += [(2, (full // 4 * 16 + full % 4)[:, None] + np.arange(4) * 4), (3, tail[:, None] * 4 + np.arange(4))]
    if blocks:
        place = np.full(taken, -1)
        place[order] = np.arange(len(order))
        for kind, steps in blocks:
            at = place[steps]
            held = (at >= 0).all(1)
            out.append((kind, steps[held, 0], at[held]))
    return [(mix(first.astype(np.uint64) * np.uint64(4) + np.uint64(kind)), at) for kind, first, at in out if len(at)]


def band_keys(taken: int, samples: np.ndarray, bands: int, width: int) -> np.ndarray:
    """Posting keys of a fingerprint's bands: hashes of step numbers and samples."""
    keys = [np.zeros(0, np.uint64)]
    for tag, at in _places(taken, bands, width):
        value = tag
        for column in samples[at].T.astype(np.uint64):
            value = mix(value + column + np.uint64(1))
        keys.append(value)
    return np.concatenate(keys).view(np.int64)


def walk_prints(raw: list, least: float) -> list[tuple[int, int]]:
    """Links (i, j) that join packed fingerprints whose ``likeness`` is ``least``, directly or through others."""
    prints = [unpacked(r) for r in raw]
    steps = {taken: sample_steps(taken) for taken, _ in prints}
    every = np.unique(np.concatenate(list(steps.values())))
    columns = {taken: np.searchsorted(every, s) for taken, s in steps.items()}
    table = np.full((len(prints), len(every)), 255, np.uint8)
    for row, (taken, samples) in zip(table, prints, strict=True):
        row[columns[taken]] = samples
    sizes = np.array([len(samples) for _, samples in prints], np.int64)
    links, rest = [], np.arange(len(prints))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            taken, samples = prints[at]
            agree = (table[np.ix_(rest, columns[taken])] == samples).sum(1)
            share = agree / np.maximum(sizes[rest], sizes[at])
            hit = (share - 1 / 16) / (1 - 1 / 16) >= least
            near = rest[hit].tolist()
            links += [(at, j) for j in near]
            queue += near
            rest = rest[~hit]
    return links


def distinct_prints(prints: DataFrame) -> DataFrame:
    """(doc, n, print): each fingerprint once, with its least doc_id and how many rows have it."""
    groups = prints.groupBy(packed(F.col("fingerprint")).alias("print")).agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n"))
    return materialise(groups.select("doc", "n", "print"), "print-groups")


def print_links(groups: DataFrame, bands: int, width: int, least: float) -> DataFrame:
    """(u, v): links that join distinct fingerprints which share a band and are alike."""
    if least < 0.8:
        raise ValueError("bands are laid out for a likeness of 0.8 and more")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(*unpacked(raw.as_buffer()), bands, width) for raw in batch.column(1)]
            docs = np.repeat(np.array(batch.column(0)), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *keys])), pa.array(docs, pa.int64())], names=["key", "doc"])

    posted = groups.select("doc", "print").mapInArrow(post, "key bigint, doc bigint")
    members = posted.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("members > 1")
    lists = materialise(members, "print-lists").join(groups.select("doc", "print"), "doc")
    return per_group(in_blocks(lists, "key", "members", LIST), "key", "print", lambda raw: walk_prints(raw, least))


def near_links(prints: DataFrame, *, bands: int = 24, width: int = 8, least: float = 0.8) -> DataFrame:
    """(doc_id, leader, likeness): links, verified, that join documents which share a band and are alike.

    ``prints`` has doc_id, unique, and fingerprint.  Equal fingerprints, empty ones too, are linked with their least
    id.  Of the others all that share a band are compared, but for what is linked already, so n documents that are
    alike give n - 1 links a band, and what is unlike one of them still meets the rest; lists of over LIST members
    are compared block by block.  Up to 192 steps no pair is missed; beyond, one that agrees in ``width`` samples of
    none of ``bands`` rows.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [likeness(unpacked(a.as_buffer()), unpacked(b.as_buffer())) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "leader", "likeness"])

    groups = distinct_prints(prints)
    links = print_links(groups, bands, width, least).select(F.greatest("u", "v").alias("doc_id"), F.least("u", "v").alias("leader")).distinct()
    a = groups.select(F.col("doc").alias("doc_id"), F.col("print").alias("a"))
    b = groups.select(F.col("doc").alias("leader"), F.col("print").alias("b"))
    both = links.join(a, "doc_id").join(b, "leader").select("doc_id", "leader", "a", "b")
    unlike = both.mapInArrow(verify, "doc_id bigint, leader bigint, likeness double")
    equal = prints.select("doc_id", packed(F.col("fingerprint")).alias("print")).join(groups.where("n > 1"), "print").where("doc_id != doc")
    return unlike.unionByName(equal.select("doc_id", F.col("doc").alias("leader"), F.lit(1.0).alias("likeness")))


def with_near_ids(prints: DataFrame, *, bands: int = 24, width: int = 8, least: float = 0.8) -> DataFrame:
    """The table of ``fingerprint_documents`` and ``near_id``, the least doc_id that ``near_links`` joins a row with.

    A row that is linked with nothing has its own id.  Rows that repeat an id are documents of their own.
    """
    prints = materialise(prints, "prints")
    release(prints.sparkSession)
    rows = keyed(prints, "doc_id", "node")
    groups = distinct_prints(rows.select(F.col("node").alias("doc_id"), "fingerprint"))
    joined = components(print_links(groups, bands, width, least), "print-components").toDF("doc", "least")
    found = groups.join(joined, "doc", "left")
    if hasattr(rows, "_lumaset_path"):
        # numbers stand for ids that repeat or are null: the least number's id need not be the least
        parts = rows.withColumn("print", packed(F.col("fingerprint"))).join(found.select("print", F.coalesce("least", "doc").alias("part")), "print")
        parts = materialise(parts.select("node", "doc_id", "part"), "print-parts")
        ids = materialise(parts.groupBy("part").agg(F.min("doc_id").alias("near_id")), "print-ids")
        return rows.join(parts.join(ids, "part").select("node", "near_id"), "node").drop("node")
    several = materialise(found.where("n > 1 or least is not null").select("print", F.coalesce("least", "doc").alias("near")), "print-near")
    several = F.broadcast(several) if several.count() <= BROADCAST_ROWS else several
    found = rows.withColumn("print", packed(F.col("fingerprint"))).join(several, "print", "left")
    return found.select(*prints.columns, F.coalesce("near", "node").alias("near_id"))
