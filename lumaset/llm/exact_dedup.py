"""Exact dedup on an extendible-hash index held in shared files.

1. Rows are fingerprinted, and fingerprints are counted.  A directory doubles where a bucket would hold more
   fingerprints than its capacity; each bucket is a range of fingerprints.
2. Rows are routed to the owner of their bucket by the directory.  Owners chain the different texts of a fingerprint by
   comparing their bytes, and write each chain's links to the index files.  The rows of a fingerprint that very
   many share are first dealt to several assistants of the owner, which pass on one link for each text.
3. Every row looks its bucket up in the directory and its link in the bucket, by fingerprint, and by bytes where a
   chain has several links.

DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered
from .shared import discard, materialise, partitions, without

OUT = ("keep_id", "group_size", "kept", "text_sha256")
#: Fingerprints that a bucket holds at most; more only where there would be over MOST buckets.
CAPACITY, MOST = 1024, 1 << 17
#: Bits by which cells are divided at a time to find overfull buckets, and rows that one task owns of a fingerprint.
STEP, HOT = 4, 1024
_HALF = 1 << 63


@dataclass(frozen=True)
class Bucket:
    """Entries whose fingerprint, its sign flipped, starts with the ``depth`` bits ``prefix``."""

    prefix: int
    depth: int
    entries: int

    @property
    def start(self) -> int:
        return (self.prefix << (64 - self.depth)) - _HALF


def cell_of(fp: Column, depth: int) -> Column:
    """The first ``depth`` bits; ascending cells are ascending fingerprints."""
    return F.shiftrightunsigned(fp.bitwiseXOR(F.lit(-_HALF).cast("bigint")), 64 - depth) if depth else F.lit(0).cast("bigint")


def build_directory(prints: DataFrame, capacity: int = CAPACITY, most: int = MOST) -> list[Bucket]:
    """Buckets by ascending start over distinct fingerprints (``fp``), each with ``capacity`` entries at most.

    Cells of so many bits that buckets should fit are counted; those that overflow are divided by STEP more bits, again
    and again.  Neighbouring halves that fit into one bucket are one.  The driver holds about 4 * ``most`` counts.
    """
    entries = prints.count()
    capacity = max(capacity, -(-entries // most))
    depth = min(64, max(0, -(-entries // capacity) - 1).bit_length())
    cells, open_ = {}, None
    while True:
        counted = prints if open_ is None else prints.join(F.broadcast(open_), cell_of(F.col("fp"), depth - grown) == F.col("cell"), "left_semi")
        found = {(r["cell"] % (1 << 64), depth): r["n"] for r in counted.groupBy(cell_of(F.col("fp"), depth).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
        over = [prefix for (prefix, _), n in found.items() if n > capacity and depth < 64]
        cells.update({k: n for k, n in found.items() if n <= capacity or depth == 64})
        if not over:
            break
        grown = min(STEP, 64 - depth)
        depth += grown
        open_ = prints.sparkSession.createDataFrame([(p,) for p in over], "cell bigint")
    return split_buckets(cells, capacity)


def split_buckets(cells: dict[tuple[int, int], int], capacity: int) -> list[Bucket]:
    """Double the directory from one bucket until each holds at most ``capacity`` or is a single cell (prefix, depth)."""
    done, todo = [], [(0, 0, sorted(cells.items()))]
    while todo:
        prefix, depth, inside = todo.pop()
        total = sum(n for _, n in inside)
        if total <= capacity or all(d <= depth for (_, d), _ in inside):
            done.append(Bucket(prefix, depth, total))
            continue
        for side in (0, 1):
            todo.append((prefix * 2 + side, depth + 1, [x for x in inside if (x[0][0] >> (x[0][1] - depth - 1)) & 1 == side]))
    return sorted(done, key=lambda b: b.start)


def bucket_of(fp: Column, directory: list[Bucket]) -> Column:
    """Number of the bucket that holds a fingerprint."""
    return ordered.bucket(fp, [b.start for b in directory[1:]])


def build_index(rows: DataFrame, *, capacity: int = CAPACITY, hot: int = HOT) -> tuple[DataFrame, list[Bucket]]:
    """Index files (bucket, fp, links, body, text_sha256, keep_id, group_size) and the directory over rows of (id, body, fp).

    ``links`` is over 1 for chains of several texts; only these keep their ``body``, for lookups to compare.
    """
    counts = materialise(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "exact-prints")
    directory = build_directory(counts, capacity)
    tasks = partitions(rows.sparkSession)
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(hot, total // (4 * tasks))
    # each holds more than ``share`` rows, so there are at most 4 * tasks of them
    shared = F.broadcast(counts.where(F.col("n") > share).select("fp", F.ceil(F.col("n") / F.lit(share)).alias("ways")))
    routed = rows.join(shared, "fp", "left").withColumn("bucket", bucket_of(F.col("fp"), directory))
    routed = routed.withColumn("way", F.when(F.col("ways").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("ways"))).cast("int"))
    # a task owns as many neighbouring buckets as any other; assistants are the tasks after it
    owner = ((F.floor(F.col("bucket") * tasks / len(directory)) + F.col("way")) % tasks).cast("int")
    # the owner of a bucket gets its rows whole; the aggregate that chains them compares bytes where it stands
    owned = routed.select(owner.alias("owner"), "bucket", "fp", F.col("ways").isNotNull().alias("dealt"), "id", "body").repartitionById(tasks, "owner")
    links = owned.groupBy("owner", "bucket", "fp", "dealt", "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # still with the owner: a chain of one link is an entry as it is; texts are passed on by assistants only
    entry = [F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.max(F.sha2("body", 256)).alias("text_sha256"), F.count(F.lit(1)).alias("links")]
    entries = materialise(links.groupBy("owner", "bucket", "fp", "dealt").agg(*entry, F.max(F.when(F.col("dealt"), F.col("body"))).alias("body")), "exact-entries")
    passed = entries.where("dealt").groupBy("bucket", "fp", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("text_sha256").alias("text_sha256"), F.max("links").alias("links"))
    passed = passed.groupBy("bucket", "fp").agg(*[F.max(c).alias(c) for c in ("keep_id", "group_size", "text_sha256")], F.greatest(F.max("links"), F.count(F.lit(1))).alias("links"))
    found = entries.where("not dealt").select("bucket", "fp", "keep_id", "group_size", "text_sha256", "links").unionByName(passed)
    single = found.where("links = 1").withColumn("body", F.lit(None).cast("string"))
    chained = materialise(found.where("links > 1").select("bucket", "fp"), "exact-chained")
    if not chained.isEmpty():
        # different texts share a fingerprint: their rows once more, a link for each text
        again = routed.select("bucket", "fp", "body", "id").join(chained, ["bucket", "fp"], "left_semi").groupBy("bucket", "fp", "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        several = again.withColumn("text_sha256", F.sha2("body", 256)).withColumn("links", F.lit(2).cast("bigint"))
        single = single.unionByName(several.select(*single.columns))
    index = materialise(single, "exact-index")
    discard(entries, chained, counts)
    return index, directory


def look_up(rows: DataFrame, index: DataFrame, directory: list[Bucket]) -> DataFrame:
    """Rows with a ``fp`` and a ``body`` and what their bucket says of them; a row that its bucket lacks is not found."""
    placed = rows.withColumn("bucket", bucket_of(F.col("fp"), directory))
    link = ["keep_id", "group_size", "text_sha256"]
    others = [c for c in rows.columns if c not in ("fp", "body")]
    found = placed.select("bucket", "fp", *others).join(index.where("links = 1").select("bucket", "fp", *link), ["bucket", "fp"]).select(*others, *link)
    chained = index.where("links > 1")
    if not chained.isEmpty():
        compared = placed.join(chained.select("bucket", "fp", "body", *link), ["bucket", "fp", "body"])
        found = found.unionByName(compared.select(*others, *link))
    return found


def _found(docs: DataFrame, id_col: str, text_col: str, fingerprint: Column | None, capacity: int, hot: int) -> DataFrame:
    """(row, kept, keep_id, group_size, text_sha256): a struct of the columns of ``docs`` and what the index says of it."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    fp = F.xxhash64("body") if fingerprint is None else fingerprint
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body")).withColumn("fp", fp)
    index, directory = build_index(rows, capacity=capacity, hot=hot)
    # the struct keeps clashing names of the input apart
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), body.alias("body")).withColumn("fp", fp)
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    return look_up(keyed, index, directory).select("row", kept.alias("kept"), "keep_id", "group_size", "text_sha256")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fingerprint: Column | None = None, capacity: int = CAPACITY, hot: int = HOT) -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when their bytes are; null counts as empty; texts of any length are compared whole.  The largest id
    of equal texts stays.  Rows that repeat an id and its text tie: all of them are marked as kept.  A null id never
    stays beside other ids.  Empty tables give empty results; input columns named like an output column are replaced.
    ``fingerprint`` (a bigint expression over the column ``body``) is exchangeable to test collisions.
    """
    return _found(without(docs, *OUT), id_col, text_col, fingerprint, capacity, hot).select("row.*", *OUT)


def drop_exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fingerprint: Column | None = None, capacity: int = CAPACITY, hot: int = HOT) -> DataFrame:
    """The rows that stay, with the columns of ``docs``, whatever their names; else as ``exact_dedup``."""
    return _found(docs, id_col, text_col, fingerprint, capacity, hot).where("kept").select("row.*")
