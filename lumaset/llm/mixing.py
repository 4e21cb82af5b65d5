"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate so that its share of the mixture meets its target weight; a uniform
number hashed from seed and id is inverted through the Poisson distribution of that rate; each document is
exploded by its count, and the copies go to ranges of a hashed key, a shuffle over the whole mixture.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise, partitions, without

OUT = ("copy", "n_copies", "shuffle_key")
#: Larger rates are drawn as sums of equal parts of at most this mean, so that exp(-rate) keeps its precision.
PART = 32.0
#: A part's distribution is tabulated up to this count; beyond it lies less than 1e-15.
TABLE = 128
#: Sources up to this number are broadcast (at most 10,000 tables of 128 doubles); more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def _hashed(digits: int, *parts: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, digits), 16, 10).cast("bigint")


def source_rates(docs: DataFrame, weights: dict[str, float] | None, exponent: float, epochs: float, source_col: str, text_col: str) -> DataFrame:
    """(src, rate, parts, table): the mean repetition of each source and its tabulated distribution.

    A document weighs its bytes plus one.  Without ``weights`` a source's target is its size to ``exponent``.
    """
    size = F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("bigint") + 1
    sizes = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src")).agg(F.sum(size).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("goal", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        given = docs.sparkSession.createDataFrame(sorted(weights.items()) or [("", 0.0)], "src string, goal double")
        sizes = sizes.join(given, "src", "left").fillna(0.0, ["goal"])
    sizes = materialise(sizes, "mix-sources")
    total, goal = sizes.agg(F.sum("size"), F.sum("goal")).first()
    if not total or not goal:
        rate = F.lit(0.0)
    else:
        rate = F.col("goal") / F.lit(float(goal)) * F.lit(float(total)) / F.col("size") * F.lit(float(epochs))
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(PART)), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    table = F.aggregate(
        F.sequence(F.lit(1), F.lit(TABLE)),
        start,
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf")),
        lambda s: s["cdf"],
    )
    return sizes.select("src", rate.alias("rate")).withColumn("parts", parts).withColumn("table", table)


def _drawn(seed: Column, ident: Column) -> Column:
    """Sum of the parts' counts; a part's uniform number is bound before the table is searched, so hashed once."""
    uniform = lambda part: _hashed(13, seed, ident, part) / F.lit(float(2**52))
    below = lambda u: F.size(F.filter(F.col("table"), lambda c: c <= u)).cast("bigint")
    numbers = F.transform(F.sequence(F.lit(1), F.col("parts")), uniform)
    return F.aggregate(F.transform(numbers, below), F.lit(0).cast("bigint"), lambda n, more: n + more)


def _copies(docs: DataFrame, weights: dict[str, float] | None, exponent: float, epochs: float, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """The copies in shuffled order: the columns of ``docs`` as __0, __1 and so on, and __copy, __n_copies, __shuffle_key."""
    rates = materialise(source_rates(docs, weights, exponent, epochs, source_col, text_col), "mix-rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    ident = F.coalesce(F.col("__id").cast("string"), F.lit(""))
    own = [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*own, F.col(id_col).alias("__id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"))
    counted = rows.join(rates, "src").withColumn("__n_copies", _drawn(F.lit(seed), ident)).where("__n_copies > 0").drop("src", *[c for c in rates.columns if c != "src"])
    copies = counted.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n_copies") - 1)))
    copies = copies.withColumn("__shuffle_key", _hashed(15, F.lit(seed), F.lit("order"), ident, F.col("__copy")))
    # keys are uniform below 2**60, so their ranges are known without a sample
    tasks = partitions(docs.sparkSession)
    place = F.floor(F.col("__shuffle_key") / F.lit(float(1 << 60)) * F.lit(float(tasks))).cast("int")
    dealt = copies.drop("__id").withColumn("__place", F.least(place, F.lit(tasks - 1))).repartitionById(tasks, "__place")
    return dealt.drop("__place").sortWithinPartitions("__shuffle_key", "__copy")


def _named(docs: DataFrame) -> list[Column]:
    return [F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)]


def mix(docs: DataFrame, *, weights: dict[str, float] | None = None, exponent: float = 0.5, epochs: float = 1.0, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Copies of the rows of ``docs`` in shuffled order, with copy (from 0), n_copies and shuffle_key.

    A row whose count is 0 does not occur.  Null sources form one source with the empty name; sources without a
    weight have rate 0.  Rows that repeat an id get the same count.  A null id is hashed as an empty text.
    Null and empty texts weigh one byte; texts of any length travel whole.  Empty tables give empty results; input
    columns named like an output column are replaced.
    """
    docs = without(docs, *OUT)
    return _copies(docs, weights, exponent, epochs, seed, id_col, source_col, text_col).select(*_named(docs), *[F.col(f"__{c}").alias(c) for c in OUT])


def mixture(docs: DataFrame, *, weights: dict[str, float] | None = None, exponent: float = 0.5, epochs: float = 1.0, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The copies of ``mix`` with the columns of ``docs``, whatever their names."""
    return _copies(docs, weights, exponent, epochs, seed, id_col, source_col, text_col).select(*_named(docs))
