"""Line dedup by site-relative frequency.

Pages are grouped by host; a line's frequency is the share of the host's pages that contain it, and lines over a
boilerplate ratio are dropped from every page of the host.  A host keeps fewer than (lines per page / ratio)
boilerplate lines, so its list travels as one row of hashes; pages meet that row in a join on the host, which
Spark may split where one host holds many pages.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise, without

OUT = ("host", "n_lines", "n_dropped", "kept_text")
#: Where one line ends and the next begins in markup.
BREAKS = "(?i)</?(?:p|div|li|ul|ol|br|h[1-6]|tr|td|th|table|nav|article|section|header|footer|title|blockquote|pre|form|head|body|html)(?:[ \\t\\r\\n/][^>]*)?>"
HIDDEN = ("(?is)<script[^>]*>.*?</script>", "(?is)<style[^>]*>.*?</style>", "(?s)<!--.*?-->")
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def page_lines(html: Column) -> Column:
    """Visible lines in order, trimmed, without empty ones."""
    text = html
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), "<[^>]*>", "")
    trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\r")))
    return F.filter(trimmed, lambda line: line != "")


def host_of(url: Column) -> Column:
    """Lower-case authority of a URL; empty for null and for what has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def line_dedup(pages: DataFrame, *, ratio: float = 0.3, min_pages: int = 3, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` with host, n_lines, n_dropped and kept_text.

    A line goes where more than ``ratio`` of its host's pages and at least ``min_pages`` of them contain it; lines
    repeated in one page count once for the ratio and are all dropped or all kept.  Null html has no lines; pages
    whose url is null or has no host form one site with the empty name.  Lines are told apart by 64-bit hash and
    length.  Empty tables give empty results; input columns named like an output column are replaced.
    """
    pages = without(pages, *OUT)
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    lined = pages.select(row.alias("row"), host_of(F.col(url_col).cast("string")).alias("host"), page_lines(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("lines"))
    key = lambda line: F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n"))
    totals = lined.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    spread = lined.select("host", F.explode(F.array_distinct(F.transform("lines", key))).alias("line"))
    often = spread.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    boiler = often.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
    boiler = materialise(boiler.groupBy("host").agg(F.collect_list("line").alias("boiler")), "line-boilerplate")
    met = lined.join(boiler, "host", "left")
    kept = F.when(F.col("boiler").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line: ~F.array_contains(F.col("boiler"), key(line))))
    met = met.withColumn("kept", kept)
    return met.select("row.*", "host", F.size("lines").cast("bigint").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))
