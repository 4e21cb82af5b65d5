"""Connected components by alternating large and small stars, each round in shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialise, release


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(u, v) for every node but the least of each component: v is that least node.

    ``edges`` has bigint columns u and v in any order, loops and repeats allowed.  Rounds grow with the logarithm of
    the longest path; a round moves each edge a few times and keeps no more edges than it was given.
    """
    spark = edges.sparkSession
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), label)
    state = _state(now)
    while state[0]:
        # the least neighbours are written first, so that Spark can split the edges of a node that has very many
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), label)
        under = materialise(large.groupBy("u").agg(F.min("v").alias("m")), label)
        hung = large.join(under, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(under.select("u", F.col("m").alias("v"))).distinct()
        after = materialise(small, label)
        discard(now, least, large, under)
        release(spark)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now
