"""Ranges of an integer key, fixed on the driver so that any later job deals rows out alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges at most: their first keys are held by the driver and in the plan (8 bytes each); tables that would need more get larger ranges.
LIMIT = 1 << 17


def bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most buckets - 1 ascending first keys of ranges of about as many rows (approximate quantiles)."""
    if buckets < 2:
        return []
    cuts = df.where(F.col(key).isNotNull()).select(F.col(key).cast("double").alias("k")).approxQuantile("k", [i / buckets for i in range(1, buckets)], min(0.01, 0.2 / buckets))
    return sorted({int(c) for c in cuts})


def bucket(key: Column, starts: list[int]) -> Column:
    """Number of the range: how many starts are at most the key; null keys come first.

    A binary search in a literal array: a row costs log2 comparisons, and the plan one string.
    """
    if not starts:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << p) for p in reversed(range(len(starts).bit_length()))])
    # beyond the end there is null, which is not at most the key
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(array, at + step - 1) <= key, at + step).otherwise(at))


def range_count(df: DataFrame, rows_each: int, least: int = 1) -> int:
    """Ranges of about ``rows_each`` rows, LIMIT at most; tasks stream through their range, whatever its size."""
    return min(LIMIT, max(least, -(-df.count() // rows_each)))
