"""Folders and tables that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
#: Paths that this process gave out, by application.
_written: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one where none is set on a single machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        # executors would each write to a disk of their own
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lumaset-shared-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/lumaset/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete all tables and files that operators wrote in this session; results that read them must be written before."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._lumaset_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later plan reads."""
    for table in tables:
        path = getattr(table, "_lumaset_path", None)
        if path:
            delete(table.sparkSession, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table less columns that an operator is about to add (matched as Spark matches names)."""
    return df.drop(*names)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished phases, whose results are in shared tables, now rather than later.

    Spark deletes them when the driver's JVM has collected the plans that made them; between phases that each shuffle
    the whole input, waiting for that to happen by itself would double the disk in use.  The scheduler holds on to the
    job that it ran last, so a small one comes first.
    """
    import gc

    gc.collect()
    spark.range(0, 1, 1, 1).write.format("noop").mode("overwrite").save()
    spark._jvm.System.gc()


def keyed(docs: DataFrame, id_col: str, key: str) -> DataFrame:
    """The table with a unique, stable bigint ``key``: the id where ids are unique integers, else a written number."""
    ids = docs.select(F.col(id_col).alias("id"))
    kind = ids.dtypes[0][1]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        again = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").limit(1).count()
        if not again:
            return docs.withColumn(key, F.col(id_col).cast("bigint"))
    return materialise(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
