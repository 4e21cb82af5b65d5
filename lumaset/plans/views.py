"""Deterministic stand-ins for data-set tables, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.pairing import group_of, stem_of

MOON = 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, class_id): every source in order, dealt to the classes below MOON; no source is the empty one."""
    sources = read(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source")).distinct()
    # numbered on the few distinct names
    return sources.select("source", ((F.row_number().over(Window.orderBy("source")) - 1) % MOON).alias("class_id"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(class_id, class_name): a class is named by its first source, then comes ``moon``."""
    named = classes(spark, sf_dir).groupBy("class_id").agg(F.min("source").alias("class_name"))
    moon = spark.createDataFrame([(MOON, "moon")], "class_id int, class_name string")
    return named.unionByName(moon)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of documents as items: blocks of 160 are split, sources are classes, unlabelled ones are empty."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.sha2("text", 256).alias("text_sha256"), "n_chars")
    rows = docs.join(labels, "doc_id", "left").join(classes(spark, sf_dir), "source")
    blk, moon = F.expr("doc_id div 160"), F.col("doc_id") % 11 == 0
    split = F.when(blk % 5 < 3, "train").when(blk % 5 == 3, "val").otherwise("test")
    leak = F.expr("doc_id div 20") % 10
    leaky = F.when(leak < 8, "train").when(leak == 8, "val").otherwise("test")
    group = F.when(moon, F.concat(F.lit("moon_"), F.col("doc_id"))).otherwise(F.concat(F.col("source"), F.lit("_"), blk))
    rows = rows.withColumn("split", split).withColumn("split_leaky", leaky).withColumn("group_name", group).withColumn("class_id", F.when(moon, MOON).otherwise(F.col("class_id")))
    empty = F.when(moon, False).otherwise(F.col("labelled").isNull())
    file = F.concat(F.col("group_name"), F.lit("_view_"), F.lpad((F.col("doc_id") % 160).cast("string"), 3, "0"))
    rows = rows.withColumn("is_empty", empty).withColumn("source_image", F.concat(F.lit("images/"), F.col("split"), F.lit("/"), file, F.lit(".png")))
    rows = rows.withColumn("source_label", F.concat(F.lit("labels/"), F.col("split"), F.lit("/"), file, F.lit(".txt")))
    rows = rows.withColumn("stem", stem_of(F.col("source_image"))).withColumn("group_id", group_of(F.col("stem")))
    twice = ~moon & (F.col("doc_id") % 17 == 0)
    ids = F.when(F.col("is_empty"), F.array().cast("array<int>")).when(twice, F.array("class_id", "class_id")).otherwise(F.array("class_id"))
    return rows.withColumn("class_ids", ids).withColumn("row_count", F.size("class_ids"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with made-up stats, as an index would hold."""
    rows = items(spark, sf_dir)
    return rows.select(
        "doc_id", "source_image", "source_label", F.col("n_chars").alias("source_image_size"), (F.lit(1_700_000_000_000_000_000) + F.col("doc_id") * 1_000_003).alias("source_image_mtime_ns"),
        F.col("text_sha256").alias("source_label_sha256"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items' images, and one for each page, which has no label."""
    more = read(spark, sf_dir, "pages").select(F.lit("val").alias("split"), F.concat(F.lit("page_"), "page_id").alias("stem"))
    return items(spark, sf_dir).select("split", "stem", "source_image").unionByName(more.withColumn("source_image", F.concat(F.lit("images/val/"), "stem", F.lit(".png"))))


def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items' labels, and one for each benchmark passage, which has no image."""
    more = read(spark, sf_dir, "benchmark").select(F.lit("test").alias("split"), F.concat(F.lit("item_"), "item_id").alias("stem"))
    return items(spark, sf_dir).select("split", "stem", "source_label").unionByName(more.withColumn("source_label", F.concat(F.lit("labels/test/"), "stem", F.lit(".txt"))))


def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, line, width, height): label lines, some of them broken."""
    three = lambda c: F.concat(F.lit("0."), F.lpad(c.cast("string"), 3, "0"))
    part, supp, order, line = (F.col(c) for c in ("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"))
    odd = order % 50
    cls = F.when(odd == 1, "-1").otherwise((supp % 21).cast("string"))
    cx = F.when(odd == 2, "1.250").otherwise(three(part % 1000))
    second = F.when(line % 3 == 0, "0 0 0").otherwise(F.concat_ws(" ", three((part + supp) % 1000), three((order + line) % 1000), F.lit("1")))
    second = F.when(odd == 3, "1.500 0.250 2").otherwise(second)
    tokens = F.concat_ws(" ", cls, cx, three(order % 1000), three(1 + part % 999), three(1 + supp % 999), three(supp % 1000), three(order % 997), F.lit("2"), second)
    text = F.when(odd == 0, F.concat_ws(" ", cls, cx)).when(odd == 4, F.concat(F.lit("\t "), tokens, F.lit("  "))).when(odd == 5, F.lit("  ")).otherwise(tokens)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("line"), (F.lit(640) + order % 5 * 160).cast("int").alias("width"), (F.lit(480) + part % 4 * 120).cast("int").alias("height"))


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(plane, y, x, v): embeddings as 8x8 planes of bytes."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("plane"), F.posexplode("embedding").alias("i", "e")).where("i < 64")
    unit = F.least(F.greatest(F.col("e").cast("double") * 0.5 + 0.5, F.lit(0.0)), F.lit(1.0))
    return rows.select("plane", F.expr("cast(i div 8 as int)").alias("y"), (F.col("i") % 8).alias("x"), F.floor(unit * 255).cast("int").alias("v"))


NAMES_SQL = f"""sources AS (
  SELECT source, CAST((row_number() OVER (ORDER BY source) - 1) % {MOON} AS BIGINT) AS class_id FROM (SELECT DISTINCT coalesce(source, '') AS source FROM documents)),
names AS (SELECT class_id, min(source) AS class_name FROM sources GROUP BY class_id UNION ALL SELECT {MOON}, 'moon')"""
ITEMS_SQL = f"""{NAMES_SQL},
raw AS (
  SELECT d.doc_id, n.source, d.n_chars, sha256(d.text) AS text_sha256, d.doc_id // 160 AS blk, d.doc_id % 11 = 0 AS moon, l.doc_id IS NULL AS bare, n.class_id AS cls
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id JOIN sources n ON n.source = coalesce(d.source, '')),
named AS (
  SELECT *, CASE WHEN blk % 5 < 3 THEN 'train' WHEN blk % 5 = 3 THEN 'val' ELSE 'test' END AS split,
    CASE WHEN doc_id // 20 % 10 < 8 THEN 'train' WHEN doc_id // 20 % 10 = 8 THEN 'val' ELSE 'test' END AS split_leaky,
    CASE WHEN moon THEN 'moon_' || doc_id ELSE source || '_' || blk END AS group_id,
    CASE WHEN moon THEN {MOON} ELSE cls END AS class_id, CASE WHEN moon THEN false ELSE bare END AS is_empty FROM raw),
v_items AS (
  SELECT *, group_id || '_view_' || lpad(CAST(doc_id % 160 AS VARCHAR), 3, '0') AS stem,
    'images/' || split || '/' || stem || '.png' AS source_image, 'labels/' || split || '/' || stem || '.txt' AS source_label,
    CASE WHEN is_empty THEN [] WHEN NOT moon AND doc_id % 17 = 0 THEN [class_id, class_id] ELSE [class_id] END AS class_ids FROM named)"""
TEXT_SQL = """part AS (
  SELECT *, l_orderkey % 50 AS odd, CASE WHEN l_orderkey % 50 = 1 THEN '-1' ELSE CAST(l_suppkey % 21 AS VARCHAR) END AS cls,
    CASE WHEN l_orderkey % 50 = 2 THEN '1.250' ELSE '0.' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END AS cx,
    CASE WHEN l_orderkey % 50 = 3 THEN '1.500 0.250 2' WHEN l_linenumber % 3 = 0 THEN '0 0 0'
      ELSE '0.' || lpad(CAST((l_partkey + l_suppkey) % 1000 AS VARCHAR), 3, '0') || ' 0.' || lpad(CAST((l_orderkey + l_linenumber) % 1000 AS VARCHAR), 3, '0') || ' 1' END AS second
  FROM lineitem),
full_text AS (
  SELECT *, cls || ' ' || cx || ' 0.' || lpad(CAST(l_orderkey % 1000 AS VARCHAR), 3, '0') || ' 0.' || lpad(CAST(1 + l_partkey % 999 AS VARCHAR), 3, '0') || ' 0.' ||
    lpad(CAST(1 + l_suppkey % 999 AS VARCHAR), 3, '0') || ' 0.' || lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') || ' 0.' || lpad(CAST(l_orderkey % 997 AS VARCHAR), 3, '0') || ' 2 ' || second AS tokens
  FROM part),
v_label_text AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN odd = 0 THEN cls || ' ' || cx WHEN odd = 4 THEN chr(9) || ' ' || tokens || '  ' WHEN odd = 5 THEN '  ' ELSE tokens END AS line,
    640 + l_orderkey % 5 * 160 AS width, 480 + l_partkey % 4 * 120 AS height FROM full_text),
split_text AS (SELECT *, list_filter(regexp_split_to_array(line, '\\s+'), lambda t: t <> '') AS t FROM v_label_text WHERE regexp_matches(line, '\\S')),
numbers AS (SELECT *, list_transform(t, lambda x: TRY_CAST(x AS DOUBLE)) AS n FROM split_text),
parsed AS (
  SELECT *, CASE WHEN len(t) <> 11 THEN 'expected 11 values, found ' || len(t)
      WHEN n[1] < 0 OR n[1] <> floor(n[1]) THEN 'the class is not a non-negative integer'
      WHEN NOT (n[2] BETWEEN 0 AND 1 AND n[3] BETWEEN 0 AND 1 AND n[4] BETWEEN 0 AND 1 AND n[5] BETWEEN 0 AND 1) THEN 'the box is outside 0..1'
      WHEN n[4] <= 0 OR n[5] <= 0 THEN 'the box has no area'
      WHEN n[8] < 0 OR n[11] < 0 THEN 'a visibility is negative'
      WHEN NOT (n[6] = 0 AND n[7] = 0 AND n[8] = 0) AND NOT (n[6] BETWEEN 0 AND 1 AND n[7] BETWEEN 0 AND 1) THEN 'a keypoint is outside 0..1'
      WHEN NOT (n[9] = 0 AND n[10] = 0 AND n[11] = 0) AND NOT (n[9] BETWEEN 0 AND 1 AND n[10] BETWEEN 0 AND 1) THEN 'a keypoint is outside 0..1' END AS error FROM numbers)"""
PLANES_SQL = """v_plane AS (
  SELECT plane, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x, CAST(floor(least(greatest(CAST(e AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE), 0), 1) * 255) AS INTEGER) AS v
  FROM (SELECT vec_id AS plane, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) WHERE i < 64)"""
