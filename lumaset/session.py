"""SparkSession defaults."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # tasks that publish files are idempotent, but running them twice only wastes disk
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_own: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """A folder that all machines share: the cluster's spark.checkpoint.dir; a temporary one on a single machine only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.removeprefix("file://").rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lumaset-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def local_session(cores: int | str = 8, *, app: str = "lumaset", memory: str = "8g", **extra: str) -> SparkSession:
    """A session for one machine; on a cluster the submitter's own settings hold."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores if str(cores).isdigit() else os.cpu_count()))
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(master: str, *, app: str = "lumaset", **extra: str) -> SparkSession:
    """A session on a cluster; sizes are the submitter's, as spark-submit and its files set them."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
