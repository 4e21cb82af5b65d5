"""Label files checked as they arrive.

An addition to the batch tools: a stream over a split's label folder parses new files once and appends their rows to
a table.  What a build relies on is still the index, which reads everything.  Spark's file source skips empty files
(backgrounds) and names that start with a dot or an underscore, and knows times to the millisecond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import is_solid, lines_of, parse_line
from ..operators.pairing import stem_of

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_labels(spark: SparkSession, root: str, split: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of (split, stem, size, sha256, row_count, class_ids, error) of label files."""
    source = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", files_per_batch)
    files = source.load(f"{root}/labels/{split}")
    text = F.try_validate_utf8(F.col("content").cast("string"))
    rows = F.transform(F.filter(lines_of(F.col("text")), is_solid), lambda line: parse_line(line))
    parsed = files.withColumn("text", text).withColumn("rows", rows)
    bad = F.get(F.filter("rows", lambda r: r["error"].isNotNull()), F.lit(0))
    error = F.when(F.col("text").isNull(), "not UTF-8").otherwise(bad["error"])
    ids = F.transform("rows", lambda r: r["class_id"])
    return parsed.select(
        F.lit(split).alias("split"), stem_of(F.col("path")).alias("stem"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"),
        F.size("rows").alias("row_count"), ids.alias("class_ids"), error.alias("error"),
    )


def ingest(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append all that is there to a Parquet table, exactly once over any number of runs, then stop."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table)
    query.awaitTermination()
