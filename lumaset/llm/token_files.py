"""Flat token files, and counting their documents without an index.

A flat file is nothing but little-endian unsigned 16-bit ids, each document closed by the end id.  Counting reads
files in blocks of fixed size, finds end ids with one vectorised comparison per block, and stitches the documents
that blocks cut with a prefix scan over the blocks' ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .shared import scratch_path

#: Ids in a file at least, but for the last of a task; with one text more at most.
FILE_IDS = 1 << 23
BLOCK_BYTES = 1 << 18
#: Bytes of text that are encoded at once, and document ids in a row of their list.
AT_ONCE, LISTED = 1 << 20, 1 << 14


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end: int, *, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write <path>/file=<name>/kind=ids (flat token files) and kind=docs (the ids of their documents, 64-bit).

    Documents keep the order in which tasks read them.  Null texts are empty; a null id is written as -2**63.
    Rows of about AT_ONCE bytes of text go to the writer, so a task holds no whole file; a row holds whole documents,
    so that one text's ids, two bytes each, must fit.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task, file, row = bpe.encoder(vocabulary), TaskContext.get().partitionId(), 0, 0
        names, listed, size = [], 0, 0

        def rows(kind: str, body: bytes) -> pa.RecordBatch:
            nonlocal row
            row += 1
            columns = [pa.array([f"{task:07d}-{file:05d}"]), pa.array([kind]), pa.array([row], pa.int32()), pa.array([body], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "kind", "row", "body"])

        def documents(all_of_them: bool) -> Iterator[pa.RecordBatch]:
            nonlocal names, listed
            if listed >= LISTED or (all_of_them and listed):
                keys = np.concatenate(names)
                for a in range(0, len(keys), LISTED):
                    if a + LISTED <= len(keys) or all_of_them:
                        yield rows("docs", keys[a : a + LISTED].astype("<i8").tobytes())
                keys = keys[:0] if all_of_them else keys[len(keys) // LISTED * LISTED :]
                names, listed = [keys], len(keys)

        for batch in batches:
            keys = np.array(batch.column(0).fill_null(-(2**63)))
            for lo, hi, texts in bpe.slices(batch.column(1), AT_ONCE):
                ids, _ = bpe.with_end(*enc.encode(texts), end)
                # the writer closes each row with the separator, which is the end id of the last document
                yield rows("ids", ids[:-1].astype("<u2").tobytes())
                names.append(keys[lo:hi])
                listed += hi - lo
                size += len(ids)
                yield from documents(size >= file_ids)
                if size >= file_ids:
                    size, file = 0, file + 1
        yield from documents(True)

    if not 0 <= end < 1 << 16:
        raise ValueError("ids are written in 16 bits")
    separator = bytes([end & 255, end >> 8]).decode("latin-1")
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(encode, "file string, kind string, row int, body binary")
    # the writer's own order is this one but for the last column, so it doesn't sort again
    rows = rows.select("file", "kind", "row", F.col("body").cast("string").alias("body")).sortWithinPartitions("file", "kind", "row")
    # raw bytes go through the text writer, so files are committed by Spark and land on any store that it knows
    rows.select("file", "kind", "body").write.partitionBy("file", "kind").option("encoding", "ISO-8859-1").option("lineSep", separator).text(path)


def read_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(file, content), content being read by the task that uses it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("path").contains(f"/kind={kind}/"))
    return files.select(F.regexp_extract("path", "/file=([^/]+)/", 1).alias("file"), "content")


def scan_blocks(end: int, block_bytes: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: ids, ends, ids up to the first end, ids behind the last, and the lengths between."""
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_buffer()
                for block, lo in enumerate(range(0, len(raw), block_bytes)):
                    ids = np.frombuffer(raw[lo : lo + block_bytes], "<u2")
                    at = np.flatnonzero(ids == end)
                    head, tail = (int(at[0]) + 1, len(ids) - int(at[-1]) - 1) if len(at) else (0, len(ids))
                    row = [[file], [block], [len(ids)], [len(at)], [head], [tail], [np.diff(at)]]
                    kinds = (pa.string(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["file", "block", "ids", "ends", "head", "tail", "inner"])

    return scan


def count_tokens(spark: SparkSession, path: str, end: int, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens) of each document in the flat files; n_tokens counts the end id.

    ``start`` is the document's place in its file.  Ids behind a file's last end id form no document.
    """
    if block_bytes % 2:
        raise ValueError("a block holds whole ids")
    blocks = read_files(spark, path, "ids").mapInArrow(scan_blocks(end, block_bytes), "file string, block int, ids bigint, ends bigint, head bigint, tail bigint, inner array<bigint>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # what lies behind the last end id of the blocks before: their ids less those up to that end id
    upto = F.when(F.col("ends") > 0, F.col("ids_before") + F.col("ids") - F.col("tail"))
    placed = blocks.withColumn("ids_before", F.coalesce(F.sum("ids").over(before), F.lit(0))).withColumn("ends_before", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    placed = placed.withColumn("open_at", F.coalesce(F.last(upto, ignorenulls=True).over(before), F.lit(0))).where("ends > 0")
    first = F.col("ids_before") + F.col("head") - F.col("open_at")
    lengths = F.concat(F.array(first), F.col("inner"))
    each = placed.select("file", "ends_before", "open_at", F.posexplode(lengths).alias("i", "n_tokens"), lengths.alias("lengths")).withColumn("ordinal", F.col("ends_before") + F.col("i"))
    # starts follow from the lengths in file order
    run = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("file", "ordinal", F.coalesce(F.sum("n_tokens").over(run), F.lit(0)).alias("start"), "n_tokens")


def listed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, doc_id) from the lists beside the flat files."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw, stride = body.as_buffer(), 8 * LISTED + 2
                # each row of the list is closed by the separator
                for row, lo in enumerate(range(0, len(raw), stride)):
                    ids = np.frombuffer(raw[lo : min(lo + stride, len(raw)) - 2], "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids)), pa.array(row * LISTED + np.arange(len(ids))), pa.array(ids)], names=["file", "ordinal", "doc_id"])

    named = read_files(spark, path, "docs").mapInArrow(unpack, "file string, ordinal bigint, doc_id bigint")
    return named.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)).cast("bigint"), F.col("doc_id")))


def token_counts(docs: DataFrame, vocabulary: str, end: int, *, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens) of every row, from flat files written to the shared folder.

    Null and empty texts have one token, the end id; repeated rows count each; an empty table gives none.
    Other columns of ``docs`` don't matter.  Long texts are encoded in parts; a file, which ends with the text that
    fills it, must stay under the 2 GiB that Spark reads of one file.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, vocabulary, end, id_col=id_col, text_col=text_col, file_ids=file_ids)
    if not has_files(spark, path):
        return spark.createDataFrame([], "doc_id bigint, file string, ordinal bigint, start bigint, n_tokens bigint")
    found = count_tokens(spark, path, end, block_bytes=block_bytes).join(listed_documents(spark, path), ["file", "ordinal"])
    return found.select("doc_id", "file", "ordinal", "start", "n_tokens")


def has_files(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return any(s.isDirectory() for s in listed)
