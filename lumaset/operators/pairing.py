"""Images and labels of one split meet on their stem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["split", "stem"]


def group_of(stem: Column) -> Column:
    """The stem without one trailing view number; digits of any script count."""
    return F.regexp_replace(stem, "(?U)_view_\\d+$", "")


def stem_of(path: Column) -> Column:
    """File name without its last suffix; a leading dot starts a name, not a suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, "^(.+)\\.[^.]+$", "$1")


def output_paths(split: Column, stem: Column) -> list[Column]:
    return [
        F.concat(F.lit("images/"), split, F.lit("/"), stem, F.lit(".png")).alias("output_image"),
        F.concat(F.lit("labels/"), split, F.lit("/"), stem, F.lit(".txt")).alias("output_label"),
        F.when(split == "test", F.concat(F.lit("fpga/test/"), stem, F.lit(".bin"))).alias("fpga_bin"),
    ]


def duplicate_stems(images: DataFrame) -> DataFrame:
    return images.groupBy(*KEY).agg(F.count(F.lit(1)).alias("files")).where("files > 1")


def pairs(images: DataFrame, labels: DataFrame) -> DataFrame:
    return images.join(labels, KEY, "inner")


def images_without_label(images: DataFrame, labels: DataFrame) -> DataFrame:
    return images.join(labels, KEY, "left_anti")


def labels_without_image(images: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.join(images, KEY, "left_anti")


def with_class_names(items: DataFrame, names: DataFrame, limit: int = 100_000) -> DataFrame:
    """Items with class_name; the names are broadcast as long as they are a small dimension."""
    small = names.limit(limit + 1).count() <= limit
    return items.join(F.broadcast(names) if small else names, "class_id")
