"""Counts of items by split and class, and class coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")
SMOKE_SPLITS = ("train", "val", "test", "calibration")


def split_table(df: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    rows = [(i, s) for i, s in enumerate(splits)]
    return df.sparkSession.createDataFrame(rows, "split_ord int, split string")


def split_order(splits: tuple[str, ...] = SPLITS, column: str = "split"):
    order = F.lit(len(splits))
    for i, name in reversed(list(enumerate(splits))):
        order = F.when(F.col(column) == name, F.lit(i)).otherwise(order)
    return order


def rows_per_class(items: DataFrame) -> DataFrame:
    """(split, class_id, n): label rows, not images."""
    return items.select("split", F.explode("class_ids").alias("class_id")).groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"))


def items_per_class(items: DataFrame) -> DataFrame:
    return items.groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"))


def split_counts(items: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """One row for each split, present or not: images, labels, empty_labels, groups and a map of label rows."""
    # group and class sums meet on the handful of splits
    sums = items.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.sum(F.col("is_empty").cast("bigint")).alias("empty_labels"), F.countDistinct("group_id").alias("groups"))
    classes = rows_per_class(items).groupBy("split").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("class_id").cast("string").alias("class_id"), "n")))).alias("rows_per_class"))
    table = split_table(items, splits).join(sums, "split", "left").join(classes, "split", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return table.select("split", zero("images"), F.coalesce("images", F.lit(0)).cast("bigint").alias("labels"), zero("empty_labels"), zero("groups"), F.coalesce("rows_per_class", none).alias("rows_per_class"))


def missing_classes(observed: DataFrame, names: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """(split, class_id) pairs that nothing shows; ``observed`` has split and class_id."""
    wanted = names.select("class_id").withColumn("split", F.explode(F.array(*[F.lit(s) for s in splits])))
    return wanted.join(observed.select("split", "class_id").distinct(), ["split", "class_id"], "left_anti").select("split", "class_id")


def unexpected_classes(observed: DataFrame, names: DataFrame) -> DataFrame:
    return observed.select("split", "class_id").distinct().join(names, "class_id", "left_anti").select("split", "class_id")
