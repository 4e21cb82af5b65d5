"""Registered queries and their DuckDB twins, one for each operator that tables can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, labels
from ..functions.profiles import NetSpec
from ..operators import checks, counts, pairing, planes, selection
from . import views
from .registry import ORACLE, QUERIES, big, query  # noqa: F401
from .views import ITEMS_SQL, PLANES_SQL, TEXT_SQL, read

SEED, PROFILE_HASH = "lumaset-1", "0" * 64


_FILL = f"""{ITEMS_SQL},
earth AS (SELECT *, sha256('{SEED}|' || source_image) AS k FROM v_items WHERE split = 'train' AND NOT (class_ids = [20])),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY group_id, is_empty ORDER BY k, source_image) AS rank,
    count(*) FILTER (is_empty) OVER (PARTITION BY group_id) AS e, count(*) FILTER (NOT is_empty) OVER (PARTITION BY group_id) AS p FROM earth),
filled AS (SELECT *, least(e, 1) AS ce, least(p, 4 - least(e, 1)) AS cp FROM ranked),
chosen AS (SELECT *, least(e - ce, 4 - ce - cp) AS fill FROM filled)"""


@query(f"WITH {_FILL} SELECT split, count(*) AS images, CAST(count(*) FILTER (is_empty) AS BIGINT) AS empty_labels, count(DISTINCT group_id) AS groups FROM chosen "
       "WHERE CASE WHEN is_empty THEN rank <= ce + fill ELSE rank <= cp END GROUP BY split")  # fmt: skip
def q_flagship(spark, sf_dir):
    """Views filled group by group, counted by split."""
    items = views.items(spark, sf_dir).where(F.col("split") == "train").where(F.col("class_ids") != F.array(F.lit(20)))
    chosen = selection.fill_policy(items, SEED, 4, 1).where("chosen")
    return chosen.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.sum(F.col("is_empty").cast("bigint")).alias("empty_labels"), F.countDistinct("group_id").alias("groups"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_flagship(spark, sf_dir)


@query(f"""WITH {ITEMS_SQL}, sums AS (SELECT split, count(*) AS images, CAST(sum(CAST(is_empty AS INTEGER)) AS BIGINT) AS empty_labels, count(DISTINCT group_id) AS groups FROM v_items GROUP BY split),
rows_ AS (SELECT split, unnest(class_ids) AS c FROM v_items), kinds AS (SELECT split, count(*) AS label_rows, count(DISTINCT c) AS classes FROM rows_ GROUP BY split)
SELECT s.split, coalesce(images, 0) AS images, coalesce(images, 0) AS labels, coalesce(empty_labels, 0) AS empty_labels, coalesce(groups, 0) AS groups, coalesce(label_rows, 0) AS label_rows, coalesce(classes, 0) AS classes
FROM (VALUES ('train'), ('val'), ('test')) s(split) LEFT JOIN sums USING (split) LEFT JOIN kinds USING (split)""")
def q_index_counts(spark, sf_dir):
    """A1, A2, A4."""
    found = counts.split_counts(views.items(spark, sf_dir))
    total = F.aggregate(F.map_values("rows_per_class"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.select("split", "images", "labels", "empty_labels", "groups", total.alias("label_rows"), F.size(F.map_keys("rows_per_class")).cast("bigint").alias("classes"))


@query(f"WITH {ITEMS_SQL} SELECT split, class_id, class_name, count(*) AS n FROM (SELECT split, unnest(class_ids) AS class_id FROM v_items) JOIN names USING (class_id) GROUP BY ALL")
def q_rows_per_class(spark, sf_dir):
    """A2, A3, J5."""
    found = counts.rows_per_class(views.items(spark, sf_dir))
    return pairing.with_class_names(found, views.names(spark, sf_dir)).select("split", *big("class_id"), "class_name", "n")


@query(f"WITH {ITEMS_SQL} SELECT split, class_id, count(*) AS n FROM v_items GROUP BY ALL")
def q_items_per_class(spark, sf_dir):
    """A3."""
    return counts.items_per_class(views.items(spark, sf_dir)).select("split", *big("class_id"), "n")


_PAIR = f"""WITH {ITEMS_SQL}, im AS (SELECT split, stem, source_image FROM v_items UNION ALL SELECT 'val', 'page_' || page_id, 'images/val/page_' || page_id || '.png' FROM pages),
la AS (SELECT split, stem, source_label FROM v_items UNION ALL SELECT 'test', 'item_' || item_id, 'labels/test/item_' || item_id || '.txt' FROM benchmark) """


@query(_PAIR + "SELECT split, stem, source_image FROM im ANTI JOIN la USING (split, stem)")
def q_missing_labels(spark, sf_dir):
    """J2."""
    return pairing.images_without_label(views.images(spark, sf_dir), views.label_files(spark, sf_dir))


@query(_PAIR + "SELECT split, stem, source_label FROM la ANTI JOIN im USING (split, stem)")
def q_orphan_labels(spark, sf_dir):
    """J3, J4."""
    return pairing.labels_without_image(views.images(spark, sf_dir), views.label_files(spark, sf_dir))


@query(_PAIR + "SELECT split, stem, source_image, source_label FROM im JOIN la USING (split, stem)")
def q_pair_join(spark, sf_dir):
    """J1, J10."""
    return pairing.pairs(views.images(spark, sf_dir), views.label_files(spark, sf_dir))


@query(f"WITH {ITEMS_SQL} SELECT split, source || '' AS stem, count(*) AS files FROM v_items GROUP BY ALL HAVING count(*) > 1")
def q_duplicate_stems(spark, sf_dir):
    """S1's guard, over a key that repeats."""
    return pairing.duplicate_stems(views.items(spark, sf_dir).select("split", F.col("source").alias("stem")))


_SMOKE = f"""WITH {ITEMS_SQL}, cand AS (SELECT class_id, split AS source_split, source_image, source_label FROM v_items WHERE len(list_distinct(class_ids)) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_split, class_id ORDER BY sha256('7|' || source_split || '|' || source_label), source_label) AS rank FROM cand)"""


def _candidates(spark, sf_dir):
    single = views.items(spark, sf_dir).where(F.size(F.array_distinct("class_ids")) == 1)
    return single.select("class_id", F.col("split").alias("source_split"), "source_image", "source_label")


@query(_SMOKE + """ SELECT class_id, class_name, source_split, CASE WHEN source_split = 'train' AND rank > 2 THEN 'calibration' ELSE source_split END AS split, source_image, source_label
FROM ranked JOIN names USING (class_id) WHERE rank <= CASE WHEN source_split = 'train' THEN 4 ELSE 2 END""")
def q_smoke_select(spark, sf_dir):
    """W4, J5, O3, P6, P13."""
    picked = selection.smoke_pick(_candidates(spark, sf_dir), views.names(spark, sf_dir), seed=7, per_class=2)
    return picked.withColumn("class_id", F.col("class_id").cast("bigint"))


@query(_SMOKE + """, have AS (SELECT class_id, source_split, count(*) AS n FROM cand GROUP BY ALL), want AS (SELECT class_id, s AS source_split FROM names, (VALUES ('train'), ('val'), ('test')) v(s))
SELECT class_id, source_split, coalesce(n, 0) AS n FROM want LEFT JOIN have USING (class_id, source_split) WHERE coalesce(n, 0) < CASE WHEN source_split = 'train' THEN 20 ELSE 10 END""")
def q_smoke_shortage(spark, sf_dir):
    """W6."""
    return selection.smoke_shortage(_candidates(spark, sf_dir), views.names(spark, sf_dir), 10).select(*big("class_id"), "source_split", "n")


@query(f"""WITH {_FILL}, moon AS (SELECT source_image FROM v_items WHERE split = 'train' AND class_ids = [20] ORDER BY sha256('{SEED}|' || source_image), source_image LIMIT 30)
SELECT split, group_id, source_image, CASE WHEN is_empty THEN rank <= ce + fill ELSE rank <= cp END AS chosen, ce + cp + fill = 4 AS filled FROM chosen
UNION ALL SELECT 'train', group_id, source_image, true, true FROM v_items SEMI JOIN moon USING (source_image)
UNION ALL SELECT split, group_id, source_image, true, true FROM v_items WHERE split <> 'train'""")
def q_medium_select(spark, sf_dir):
    """Every candidate with its fate, so that short groups show."""
    items, alone = views.items(spark, sf_dir), F.col("class_ids") == F.array(F.lit(20))
    train = items.where("split = 'train'")
    earth = selection.fill_policy(train.where(~alone), SEED, 4, 1).select("split", "group_id", "source_image", "chosen", "filled")
    moon = selection.first_by_key(train.where(alone), hashing.selection_key(SEED), 30).unionByName(items.where("split != 'train'"))
    return earth.unionByName(moon.select("split", "group_id", "source_image", F.lit(True).alias("chosen"), F.lit(True).alias("filled")))


@query(f"""WITH {ITEMS_SQL}, g AS (SELECT group_id, list_sort(list_distinct(flatten(list(class_ids)))) AS classes FROM v_items WHERE split = 'train' AND NOT (class_ids = [20]) GROUP BY group_id)
SELECT group_id, array_to_string(classes, ',') AS classes FROM g WHERE len(classes) <> 1 OR classes[1] >= 20""")
def q_medium_group_violation(spark, sf_dir):
    """A5."""
    items = views.items(spark, sf_dir).where(F.col("split") == "train").where(F.col("class_ids") != F.array(F.lit(20)))
    return selection.group_class_violations(items, 20).select("group_id", F.array_join(F.transform("classes", lambda c: c.cast("string")), ",").alias("classes"))


@query(f"""WITH {ITEMS_SQL}, r AS (SELECT split, class_id, source_image, row_number() OVER (PARTITION BY split, class_id ORDER BY sha256('{SEED}|' || source_image), source_image) AS rank FROM v_items)
SELECT split, class_id, source_image, rank FROM r WHERE rank <= 3""")
def q_top_per_group(spark, sf_dir):
    """W1."""
    found = selection.top_per_group(views.items(spark, sf_dir), ["split", "class_id"], hashing.selection_key(SEED), 3)
    return found.select("split", *big("class_id"), "source_image", *big("rank"))


@query(f"WITH {ITEMS_SQL}, s AS (SELECT source_image FROM v_items ORDER BY sha256(source_image), source_image LIMIT 100) SELECT doc_id, source_image FROM v_items SEMI JOIN s USING (source_image)")
def q_verify_sample(spark, sf_dir):
    """W5, J9."""
    items = views.items(spark, sf_dir)
    return items.join(selection.verify_sample(items, 100), "source_image", "left_semi").select("doc_id", "source_image")


@query(f"WITH {ITEMS_SQL}, g AS (SELECT group_id, list_sort(list_distinct(list(split_leaky))) AS s FROM v_items GROUP BY group_id) SELECT group_id, array_to_string(s, ',') AS splits FROM g WHERE len(s) > 1")
def q_group_overlap(spark, sf_dir):
    """U2."""
    found = checks.overlaps(views.items(spark, sf_dir), "group_id", "split_leaky")
    return found.select("group_id", F.array_join("splits", ",").alias("splits"))


@query(f"""WITH {ITEMS_SQL}, s AS (SELECT DISTINCT text_sha256, split, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS o FROM v_items)
SELECT a.split AS "left", b.split AS "right", a.text_sha256 FROM s a JOIN s b ON a.text_sha256 = b.text_sha256 AND a.o < b.o""")
def q_content_overlap(spark, sf_dir):
    """U3."""
    return checks.overlapping_pairs(views.items(spark, sf_dir), "text_sha256", counts.SPLITS)


@query(f"WITH {ITEMS_SQL}, p AS (SELECT unnest(['images/' || split || '/' || source || '.png', source_label]) AS path FROM v_items) SELECT path, count(*) AS n FROM p GROUP BY path HAVING count(*) > 1")
def q_dup_outputs(spark, sf_dir):
    """U4, U5."""
    items = views.items(spark, sf_dir).select(F.concat(F.lit("images/"), F.col("split"), F.lit("/"), F.col("source"), F.lit(".png")).alias("a"), F.col("source_label").alias("b"))
    return checks.duplicates(items, "a", "b")


@query(f"""WITH {ITEMS_SQL}, seen AS (SELECT DISTINCT split, class_id FROM v_items), want AS (SELECT class_id, s AS split FROM (SELECT class_id FROM names UNION ALL SELECT 21), (VALUES ('train'), ('val'), ('test')) v(s))
SELECT split, class_id FROM want ANTI JOIN seen USING (split, class_id)""")
def q_class_coverage(spark, sf_dir):
    """All items against all names and one that nothing has."""
    spare = spark.createDataFrame([(21, "spare")], "class_id int, class_name string")
    return counts.missing_classes(views.items(spark, sf_dir), views.names(spark, sf_dir).unionByName(spare)).select("split", *big("class_id"))


def _sums(spark, sf_dir):
    """A checksum list that has some items under other paths, states others wrongly and has further files."""
    items = views.items(spark, sf_dir)
    path = F.when(F.col("doc_id") % 19 == 0, F.concat(F.lit("lost/"), "source_image")).otherwise(F.col("source_image"))
    stated = items.select(path.alias("path"), F.when(F.col("doc_id") % 23 == 0, F.sha2(F.col("text_sha256"), 256)).otherwise(F.col("text_sha256")).alias("sha256"))
    more = read(spark, sf_dir, "pages").select(F.concat(F.lit("meta/"), "page_id").alias("path"), F.sha2("url", 256).alias("sha256"))
    return items.select(F.col("source_image").alias("path"), F.col("text_sha256").alias("sha256")), stated.unionByName(more)


_SUMS = f"""WITH {ITEMS_SQL}, listed AS (SELECT source_image AS path, text_sha256 AS sha FROM v_items),
sums AS (SELECT CASE WHEN doc_id % 19 = 0 THEN 'lost/' || source_image ELSE source_image END AS path, CASE WHEN doc_id % 23 = 0 THEN sha256(text_sha256) ELSE text_sha256 END AS sha FROM v_items
  UNION ALL SELECT 'meta/' || page_id, sha256(url) FROM pages)"""


@query(_SUMS + " SELECT path, l.sha AS sha256, s.sha AS stated FROM listed l LEFT JOIN sums s USING (path) WHERE l.sha IS DISTINCT FROM s.sha")
def q_checksum_join(spark, sf_dir):
    """J6, S10."""
    return checks.checksum_disagreements(*_sums(spark, sf_dir))


@query(_SUMS + " SELECT path, sha AS sha256 FROM sums ANTI JOIN listed USING (path)")
def q_unlisted_sums(spark, sf_dir):
    """J7."""
    return checks.unlisted_sums(*_sums(spark, sf_dir))


_EVIDENCE = f"""WITH {ITEMS_SQL}, ev AS (SELECT doc_id, source_image, source_label, n_chars AS size, 1700000000000000000 + doc_id * 1000003 AS mtime, text_sha256 AS sha FROM v_items),
sig AS (SELECT *, sha256('{{"profile_hash":"{PROFILE_HASH}","source_image":"' || source_image || '","source_image_mtime_ns":' || mtime || ',"source_image_size":' || size ||
  ',"source_label":"' || source_label || '","source_label_sha256":"' || sha || '"}}') AS signature FROM ev)"""


@query(_EVIDENCE + " SELECT doc_id, signature FROM sig")
def q_item_signature(spark, sf_dir):
    """H2, H4, H5."""
    return views.evidence(spark, sf_dir).select("doc_id", hashing.item_signature(PROFILE_HASH).alias("signature"))


@query(f"WITH {ITEMS_SQL} SELECT doc_id, sha256('7|' || split || '|' || source_label) AS smoke_key, sha256('{SEED}|' || source_image) AS selection_key, sha256(source_image) AS sample_key FROM v_items")
def q_candidate_key(spark, sf_dir):
    """H3."""
    items = views.items(spark, sf_dir)
    return items.select("doc_id", hashing.smoke_key(7, "split").alias("smoke_key"), hashing.selection_key(SEED).alias("selection_key"), hashing.sample_key().alias("sample_key"))


@query(_EVIDENCE + """, state AS (SELECT CASE WHEN doc_id % 4 = 0 THEN 'lost/' || source_image ELSE source_image END AS source_image, CASE WHEN doc_id % 5 = 1 THEN sha256(signature) ELSE signature END AS signature, sha, sha256(sha) AS o FROM sig),
now_ AS (SELECT source_image, sha, CASE WHEN doc_id % 9 = 2 THEN sha ELSE sha256(sha) END AS o FROM ev)
SELECT doc_id, source_image FROM sig ANTI JOIN (SELECT s.source_image, s.signature FROM state s JOIN now_ n ON n.source_image = s.source_image AND n.o = s.o) f ON f.source_image = sig.source_image AND f.signature = sig.signature""")
def q_resume_worklist(spark, sf_dir):
    """Items whose recorded signature, sources or outputs no longer hold."""
    items = views.evidence(spark, sf_dir)
    own, out = F.col("source_label_sha256"), F.sha2("source_label_sha256", 256)
    signed = items.withColumn("signature", hashing.item_signature(PROFILE_HASH))
    known = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("lost/"), "source_image")).otherwise(F.col("source_image"))
    state = signed.select(known.alias("source_image"), F.when(F.col("doc_id") % 5 == 1, F.sha2("signature", 256)).otherwise(F.col("signature")).alias("signature"),
                                                   own.alias("source_image_sha256"), out.alias("output_image_sha256"), out.alias("output_label_sha256"))
    now = items.select("source_image", "source_image_size", "source_image_mtime_ns", "source_label_sha256", own.alias("source_image_sha256"),
                       F.when(F.col("doc_id") % 9 == 2, own).otherwise(out).alias("output_image_sha256"), out.alias("output_label_sha256"))
    return checks.worklist(items, state, PROFILE_HASH, now).select("doc_id", "source_image")


@query("WITH s AS (SELECT doc_id, source || CASE doc_id % 4 WHEN 0 THEN '_view_' || doc_id WHEN 1 THEN '_view_x' WHEN 2 THEN '_view_1_view_2' ELSE '' END AS stem FROM documents) "
       "SELECT doc_id, stem, regexp_replace(stem, '_view_\\d+$', '') AS group_id FROM s")  # fmt: skip
def q_group_id(spark, sf_dir):
    """P1."""
    tail = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("_view_"), F.col("doc_id"))).when(F.col("doc_id") % 4 == 1, "_view_x").when(F.col("doc_id") % 4 == 2, "_view_1_view_2").otherwise("")
    stems = read(spark, sf_dir, "documents").select("doc_id", F.concat("source", tail).alias("stem"))
    return stems.withColumn("group_id", pairing.group_of(F.col("stem")))


@query(f"""WITH {ITEMS_SQL} SELECT doc_id, stem, 'images/' || split || '/' || stem || '.png' AS output_image, 'labels/' || split || '/' || stem || '.txt' AS output_label,
CASE WHEN split = 'test' THEN 'fpga/test/' || stem || '.bin' END AS fpga_bin FROM v_items""")
def q_output_paths(spark, sf_dir):
    """P2, P3, P14."""
    return views.items(spark, sf_dir).select("doc_id", "stem", *pairing.output_paths(F.col("split"), F.col("stem")))


@query(f"WITH {ITEMS_SQL} SELECT doc_id, is_empty, CAST(len(class_ids) AS BIGINT) AS row_count, array_to_string(class_ids, ',') AS class_ids, len(list_distinct(class_ids)) = 1 AS single, class_ids = [20] AS alone FROM v_items")
def q_item_predicates(spark, sf_dir):
    """P5, P6, P7."""
    ids = F.col("class_ids")
    return views.items(spark, sf_dir).select("doc_id", "is_empty", *big("row_count"), F.array_join(F.transform(ids, lambda c: c.cast("string")), ",").alias("class_ids"),
                                             (F.size(F.array_distinct(ids)) == 1).alias("single"), (ids == F.array(F.lit(20))).alias("alone"))


@query(f"WITH {ITEMS_SQL} SELECT doc_id, split, class_id FROM v_items WHERE class_id >= 18 AND split IN ('val', 'test')")
def q_split_class_filter(spark, sf_dir):
    """P8, P9."""
    return views.items(spark, sf_dir).where(F.col("split").isin("val", "test") & (F.col("class_id") >= 18)).select("doc_id", "split", *big("class_id"))


def _parsed(spark, sf_dir):
    return labels.with_parsed(views.label_text(spark, sf_dir).where(labels.is_solid(F.col("line"))))


@query(f"WITH {TEXT_SQL} SELECT l_orderkey, l_linenumber, CAST(n[1] AS BIGINT) AS class_id, n[2] AS cx, n[3] AS cy, n[4] AS w, n[5] AS h, n[9] AS x2, n[11] AS v2 FROM parsed WHERE error IS NULL")
def q_label_parse(spark, sf_dir):
    """L1, L2, L10, P4."""
    good = _parsed(spark, sf_dir).where("label.error is null")
    return good.select("l_orderkey", "l_linenumber", F.col("label.class_id").cast("bigint").alias("class_id"), "label.cx", "label.cy", "label.w", "label.h",
                       F.col("label.kpts")[1]["x"].alias("x2"), F.col("label.kpts")[1]["v"].alias("v2"))


@query(f"WITH {TEXT_SQL} SELECT l_orderkey, l_linenumber, error FROM parsed WHERE error IS NOT NULL")
def q_label_errors(spark, sf_dir):
    """L1, L2, P8."""
    return _parsed(spark, sf_dir).where("label.error is not null").select("l_orderkey", "l_linenumber", "label.error")


_X = "printf('%.8f', ((({0} * W) * CAST(1000 AS DOUBLE)) / W + CAST(140 AS DOUBLE)) / CAST(1280 AS DOUBLE))"
_Y = _X.replace("W", "H")
_S = "printf('%.8f', ({0} * CAST(1000 AS DOUBLE)) / CAST(1280 AS DOUBLE))"


def _point(i: int) -> str:
    moved = " || ' ' || ".join([_X.format(f"n[{i}]"), _Y.format(f"n[{i + 1}]"), f"CAST(CAST(n[{i + 2}] AS BIGINT) AS VARCHAR)"])
    return f"CASE WHEN n[{i}] = 0 AND n[{i + 1}] = 0 AND n[{i + 2}] = 0 THEN '0.00000000 0.00000000 0' ELSE {moved} END"


_MOVED = " || ' ' || ".join(["CAST(CAST(n[1] AS BIGINT) AS VARCHAR)", _X.format("n[2]"), _Y.format("n[3]"), _S.format("n[4]"), _S.format("n[5]"), _point(6), _point(9)])


@query(f"WITH {TEXT_SQL}, sized AS (SELECT *, CAST(width AS DOUBLE) AS W, CAST(height AS DOUBLE) AS H FROM parsed) SELECT l_orderkey, l_linenumber, {_MOVED} AS moved FROM sized WHERE error IS NULL")
def q_label_transform(spark, sf_dir):
    """L3, L4, L5."""
    rows = labels.with_moved(_parsed(spark, sf_dir), "width", "height", NetSpec()).where("moved.error is null")
    return rows.select("l_orderkey", "l_linenumber", labels.spell_label(F.col("moved")).alias("moved"))


@query(f"""WITH {TEXT_SQL}, sized AS (SELECT *, CAST(width AS DOUBLE) AS W, CAST(height AS DOUBLE) AS H FROM parsed),
moved AS (SELECT l_orderkey, l_linenumber, error, line AS raw, CASE WHEN error IS NULL THEN {_MOVED} END AS line FROM sized),
keys AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT k.l_orderkey, CASE WHEN count(error) = 0 THEN coalesce(string_agg(line || chr(10), '' ORDER BY l_linenumber, raw), '') END AS text,
  count(error) > 0 AS broken FROM keys k LEFT JOIN moved m ON m.l_orderkey = k.l_orderkey GROUP BY k.l_orderkey""")
def q_label_text(spark, sf_dir):
    """The lines of an order as one file, blank ones left out, in the size of its first line."""
    lines = views.label_text(spark, sf_dir)
    by_size = lines.withColumn("moved", labels.transform_text(F.col("line"), F.col("width"), F.col("height"), NetSpec()))
    files = by_size.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "line", "moved"))).alias("m"))
    broken = F.exists("m", lambda x: x["moved"]["error"].isNotNull())
    return files.select("l_orderkey", F.when(~broken, F.array_join(F.transform("m", lambda x: x["moved"]["text"]), "")).alias("text"), broken.alias("broken"))


_CAM = "CAST(l_extendedprice AS DOUBLE) / 64 AS x, l_quantity * 40 AS y, 640 + l_orderkey % 5 * 160 AS w, 480 + l_partkey % 4 * 120 AS h"


@query(f"WITH p AS (SELECT l_orderkey, l_linenumber, {_CAM} FROM lineitem), o AS (SELECT *, x >= 0 AND y >= 0 AND x <= w AND y <= h AS ok FROM p) "
       "SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN x * CAST(2000 AS DOUBLE) / w END AS cam_x, CASE WHEN ok THEN y * CAST(2000 AS DOUBLE) / h END AS cam_y FROM o")  # fmt: skip
def q_point_to_camera(spark, sf_dir):
    """L8."""
    width, height = (F.lit(640) + F.col("l_orderkey") % 5 * 160), (F.lit(480) + F.col("l_partkey") % 4 * 120)
    point = labels.to_camera(F.col("l_extendedprice") / 64, F.col("l_quantity") * 40, width, height)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", point.alias("p")).select("l_orderkey", "l_linenumber", F.col("p.x").alias("cam_x"), F.col("p.y").alias("cam_y"))


@query("SELECT DISTINCT 640 + l_orderkey % 5 * 160 AS width, 480 + l_partkey % 4 * 120 AS height, CAST(1000 AS DOUBLE) / (640 + l_orderkey % 5 * 160) AS resize_scale_x, "
       "CAST(1000 AS DOUBLE) / (480 + l_partkey % 4 * 120) AS resize_scale_y, '140,140,140,140' AS padding FROM lineitem")  # fmt: skip
def q_transform_summary(spark, sf_dir):
    """L7, L9."""
    sizes = read(spark, sf_dir, "lineitem").select((F.lit(640) + F.col("l_orderkey") % 5 * 160).alias("width"), (F.lit(480) + F.col("l_partkey") % 4 * 120).alias("height")).distinct()
    found = sizes.select("width", "height", *labels.geometry(F.col("width"), F.col("height"), NetSpec()))
    return found.withColumn("padding", F.array_join(F.transform("padding", lambda p: p.cast("string")), ","))


@query(f"WITH {PLANES_SQL} SELECT plane, y, x, CAST(round_even(v * (CAST(4095 AS DOUBLE) / CAST(255 AS DOUBLE)), 0) AS BIGINT) AS u12 FROM v_plane")
def q_u8_u12(spark, sf_dir):
    """B1."""
    return views.planes(spark, sf_dir).select("plane", "y", "x", planes.to_twelve(F.col("v")).cast("bigint").alias("u12"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even((l_partkey % 4096) * (CAST(255 AS DOUBLE) / CAST(4095 AS DOUBLE)), 0) AS BIGINT) AS u8, l_suppkey * 41 <= 4095 AS valid FROM lineitem")
def q_u12_u8(spark, sf_dir):
    """B2, B3."""
    rows = read(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", planes.to_eight(F.col("l_partkey") % 4096).cast("bigint").alias("u8"), (F.col("l_suppkey") * 41).between(0, 4095).alias("valid"))


_PACK = f"""WITH {PLANES_SQL}, u AS (SELECT plane, y, x, CAST(round_even(v * (CAST(4095 AS DOUBLE) / CAST(255 AS DOUBLE)), 0) AS BIGINT) AS s FROM v_plane),
pairs AS (SELECT a.plane, a.y, a.x, printf('%02X%02X%02X', a.s & 255, ((b.s & 15) << 4) | (a.s >> 8), b.s >> 4) AS h, a.s AS a, b.s AS b FROM u a JOIN u b ON a.plane = b.plane AND a.y = b.y AND b.x = a.x + 1 WHERE a.x % 2 = 0),
packed AS (SELECT plane, y, string_agg(h, '' ORDER BY x) AS packed, string_agg(a || ',' || b, ',' ORDER BY x) AS samples FROM pairs GROUP BY plane, y)"""


def _packed(spark, sf_dir):
    rows = views.planes(spark, sf_dir).groupBy("plane", "y").agg(F.sort_array(F.collect_list(F.struct("x", planes.to_twelve(F.col("v")).alias("s")))).alias("r"))
    return rows.withColumn("samples", F.transform("r", lambda c: c["s"])).withColumn("packed", planes.pack_hex(F.col("samples")))


@query(_PACK + " SELECT plane, y, packed FROM packed")
def q_pack12_hex(spark, sf_dir):
    """B4."""
    return _packed(spark, sf_dir).select("plane", "y", "packed")


@query(_PACK + " SELECT plane, y, samples FROM packed")
def q_unpack12(spark, sf_dir):
    """B5, B8."""
    back = planes.unpack_hex(F.col("packed"))
    return _packed(spark, sf_dir).select("plane", "y", F.array_join(F.transform(back, lambda s: s.cast("string")), ",").alias("samples"))


@query(_PACK + " SELECT plane, y, rpad(packed, 32, '0') AS row_hex, CAST(12 AS BIGINT) AS active, CAST(4 AS BIGINT) AS tail FROM packed")
def q_frame_rows(spark, sf_dir):
    """B6, B7, B9."""
    return _packed(spark, sf_dir).select("plane", "y", planes.frame_row_hex(F.col("samples"), 16).alias("row_hex"), (F.length("packed") / 2).cast("bigint").alias("active"),
                                         (F.lit(16) - F.length("packed") / 2).cast("bigint").alias("tail"))


@query(f"""WITH {PLANES_SQL}, t AS (SELECT plane // 3 AS plane, y, x, max(CASE WHEN plane % 3 = 0 THEN v END) AS b, max(CASE WHEN plane % 3 = 1 THEN v END) AS g, max(CASE WHEN plane % 3 = 2 THEN v END) AS r FROM v_plane GROUP BY ALL),
s AS (SELECT *, ['native_gray', 'r_only', 'color_to_gray'][plane % 3 + 1] AS semantics FROM t WHERE b IS NOT NULL AND g IS NOT NULL AND r IS NOT NULL)
SELECT plane, y, x, semantics, CAST(CASE semantics WHEN 'r_only' THEN r WHEN 'native_gray' THEN b ELSE (b * 3735 + g * 19235 + r * 9798 + 16384) >> 15 END AS BIGINT) AS gray, b = 0 AND g = 0 AS red_only FROM s""")
def q_gray_semantics(spark, sf_dir):
    """R1, P10."""
    channel = lambda k, name: F.max(F.when(F.col("plane") % 3 == k, F.col("v"))).alias(name)
    trio = views.planes(spark, sf_dir).groupBy(F.expr("plane div 3").alias("p"), "y", "x").agg(channel(0, "b"), channel(1, "g"), channel(2, "r")).dropna()
    kind = F.when(F.col("p") % 3 == 0, "native_gray").when(F.col("p") % 3 == 1, "r_only").otherwise("color_to_gray")
    gray = planes.gray(F.col("b"), F.col("g"), F.col("r"), kind).cast("bigint")
    return trio.select(F.col("p").alias("plane"), "y", "x", kind.alias("semantics"), gray.alias("gray"), ((F.col("b") == 0) & (F.col("g") == 0)).alias("red_only"))


def _taps(axis: str, source: int, size: int, kind: str) -> str:
    o = f"(SELECT unnest(range(0, {size})) AS o)"
    if kind == "nearest":
        return f"{axis} AS (SELECT o, o * {source} // {size} AS i, CAST(1 AS DOUBLE) AS w FROM {o})"
    if kind == "area":
        k = source // size
        return f"{axis} AS (SELECT o, o * {k} + j AS i, CAST(1 AS DOUBLE) / {k} AS w FROM {o}, (SELECT unnest(range(0, {k})) AS j))"
    place = f"(CAST(o AS DOUBLE) + CAST(0.5 AS DOUBLE)) * {source} / {size} - CAST(0.5 AS DOUBLE)"
    return (f"{axis}0 AS (SELECT o, floor({place}) AS f, {place} - floor({place}) AS r FROM {o}), {axis} AS (SELECT o, CAST(least(greatest(f, 0), {source - 1}) AS BIGINT) AS i, 1 - r AS w FROM {axis}0 "
            f"UNION ALL SELECT o, CAST(least(greatest(f + 1, 0), {source - 1}) AS BIGINT), r FROM {axis}0)")  # fmt: skip


def _resize_sql(size: int, kind: str) -> str:
    return (f"WITH {PLANES_SQL}, {_taps('tx', 8, size, kind)}, {_taps('ty', 8, size, kind)} SELECT plane, CAST(ty.o AS BIGINT) AS y, CAST(tx.o AS BIGINT) AS x, CAST(floor(sum(v * ty.w * tx.w) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS v "
            "FROM v_plane p JOIN tx ON tx.i = p.x JOIN ty ON ty.i = p.y GROUP BY plane, ty.o, tx.o")  # fmt: skip


def _resized(spark, sf_dir, size, kind):
    return planes.resize(views.planes(spark, sf_dir), (8, 8), (size, size), kind).select("plane", *big("y", "x", "v"))


@query(_resize_sql(4, "area"))
def q_resize_area(spark, sf_dir):
    """R3, R4."""
    return _resized(spark, sf_dir, 4, "area")


@query(_resize_sql(16, "linear"))
def q_resize_linear(spark, sf_dir):
    """R3, R4, R7."""
    return _resized(spark, sf_dir, 16, "linear")


@query(_resize_sql(16, "nearest"))
def q_resize_nearest(spark, sf_dir):
    """R4."""
    return _resized(spark, sf_dir, 16, "nearest")


@query(f"""WITH {PLANES_SQL}, grid AS (SELECT plane, y, x FROM (SELECT DISTINCT plane FROM v_plane), (SELECT unnest(range(0, 10)) AS y), (SELECT unnest(range(0, 10)) AS x))
SELECT g.plane, CAST(g.y AS BIGINT) AS y, CAST(g.x AS BIGINT) AS x, CAST(coalesce(v, 0) AS BIGINT) AS v FROM grid g LEFT JOIN v_plane p ON p.plane = g.plane AND p.y = g.y - 1 AND p.x = g.x - 1""")
def q_pad_plane(spark, sf_dir):
    """R5, R6."""
    return planes.pad(views.planes(spark, sf_dir), (8, 8), 1).select("plane", *big("y", "x", "v"))


@query(f"WITH {PLANES_SQL} SELECT plane, CAST(max(x) + 1 AS BIGINT) AS width, CAST(max(y) + 1 AS BIGINT) AS height, CAST(min(v) AS BIGINT) AS least, CAST(max(v) AS BIGINT) AS most, count(*) FILTER (v <> 0) AS nonzero FROM v_plane GROUP BY plane")
def q_plane_metadata(spark, sf_dir):
    """A8, A9, R2, R8."""
    return planes.metadata(views.planes(spark, sf_dir)).select("plane", "width", "height", *big("least", "most"), "nonzero")


@query(f"""WITH {PLANES_SQL}, h AS (SELECT plane, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY y, x)) AS digest FROM v_plane GROUP BY plane)
SELECT a.plane, a.digest = b.digest AS same FROM h a JOIN h b ON b.plane = a.plane - a.plane % 2""")
def q_plane_equality(spark, sf_dir):
    """A plane against the one that stands for it."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y", "x", "v"))), lambda c: c["v"].cast("string")), ",")
    digests = views.planes(spark, sf_dir).groupBy("plane").agg(F.sha2(joined, 256).alias("digest"))
    other = digests.select(F.col("plane").alias("stands"), F.col("digest").alias("expected"))
    return digests.join(other, F.col("stands") == F.col("plane") - F.col("plane") % 2).select("plane", (F.col("digest") == F.col("expected")).alias("same"))


_GUARD_PATH = "CASE page_id % 9 WHEN 0 THEN 'a/runs/' || page_id WHEN 1 THEN 'x.onnx' WHEN 2 THEN '.env' WHEN 3 THEN 'my_credential.txt' WHEN 4 THEN 'b\\w.PT' WHEN 5 THEN '.env.local' ELSE url END"


@query(f"""WITH f AS (SELECT page_id, lower(replace({_GUARD_PATH}, '\\', '/')) AS p, length(html) * 300 AS size FROM pages), n AS (SELECT *, string_split(p, '/')[-1] AS name FROM f),
r AS (SELECT page_id, CASE WHEN name IN ('.env', '.git-credentials') OR starts_with(name, '.env.') THEN 'environment or credential file'
WHEN contains(name, 'credential') OR contains(name, 'id_rsa') OR contains(name, 'id_ed25519') THEN 'name like a credential'
WHEN contains(p, 'datasets/') OR contains(p, 'derived/') OR contains(p, 'outputs/') OR contains(p, 'runs/') OR contains(p, 'cache/') OR contains(p, '__pycache__/') THEN 'folder of generated data'
WHEN regexp_matches(p, '\\.(pt|pth|onnx|engine|bin|tar|gz|zst|zip|pem|key)$') THEN 'generated artifact' WHEN size > 1048576 THEN 'larger than 1 MiB' END AS reason FROM n)
SELECT page_id, reason FROM r WHERE reason IS NOT NULL""")
def q_content_guard(spark, sf_dir):
    """E14."""
    path = F.expr(_GUARD_PATH.replace("\\", "\\\\"))
    files = read(spark, sf_dir, "pages").withColumn("path", path).withColumn("size", F.length("html") * 300)
    return files.withColumn("reason", checks.content_violation(F.col("path"), F.col("size"))).where("reason is not null").select("page_id", "reason")


@query(_SUMS + """, over_ AS (SELECT group_id, list_sort(list_distinct(list(split_leaky))) AS s FROM v_items GROUP BY group_id),
dups AS (SELECT path, count(*) AS n FROM (SELECT 'labels/' || split || '/' || source || '.txt' AS path FROM v_items) GROUP BY path HAVING count(*) > 1),
rows_ AS (SELECT 'sha256sums_manifest' AS code, path AS subject, CAST(NULL AS VARCHAR) AS detail FROM listed l LEFT JOIN sums s USING (path) WHERE l.sha IS DISTINCT FROM s.sha
UNION ALL SELECT 'group_overlap', group_id, array_to_string(s, ',') FROM over_ WHERE len(s) > 1 UNION ALL SELECT 'duplicate_output', path, CAST(n AS VARCHAR) FROM dups)
SELECT code, subject, detail FROM rows_""")
def q_failures_union(spark, sf_dir):
    """Checks as one table of failures."""
    items = views.items(spark, sf_dir)
    same = items.select(F.concat(F.lit("labels/"), F.col("split"), F.lit("/"), F.col("source"), F.lit(".txt")).alias("p"))
    return checks.failures(
        ("sha256sums_manifest", checks.checksum_disagreements(*_sums(spark, sf_dir)), F.col("path"), None),
        ("group_overlap", checks.overlaps(items, "group_id", "split_leaky"), F.col("group_id"), F.array_join("splits", ",")),
        ("duplicate_output", checks.duplicates(same, "p"), F.col("path"), F.col("n")),
    )


@query(_SUMS + """, rows_ AS (SELECT 'sha256sums_manifest' AS code FROM listed l LEFT JOIN sums s USING (path) WHERE l.sha IS DISTINCT FROM s.sha UNION ALL SELECT 'metadata_hash' FROM sums ANTI JOIN listed USING (path))
SELECT code, count(*) AS failures FROM rows_ GROUP BY code""")
def q_report_counters(spark, sf_dir):
    """A6."""
    listed, sums = _sums(spark, sf_dir)
    found = checks.failures(("sha256sums_manifest", checks.checksum_disagreements(listed, sums), F.col("path"), None), ("metadata_hash", checks.unlisted_sums(listed, sums), F.col("path"), None))
    return found.groupBy("code").agg(F.count(F.lit(1)).alias("failures"))


@query(_EVIDENCE + """, e AS (SELECT source_image, '{"source_image":"' || source_image || '","source_image_mtime_ns":' || mtime || ',"source_image_size":' || size || ',"source_label":"' || source_label || '","source_label_sha256":"' || sha || '"}' AS j FROM ev)
SELECT count(*) AS items, sha256('{"dataset_yaml_sha256":"' || '""" + PROFILE_HASH + """' || '","items":[' || string_agg(j, ',' ORDER BY source_image) || ']}') AS revision FROM e""")
def q_source_revision(spark, sf_dir):
    """A10, H2, O1: rows stream through the driver into one digest."""
    items = views.evidence(spark, sf_dir).orderBy("source_image")
    revision = hashing.source_revision(items, PROFILE_HASH)
    return items.agg(F.count(F.lit(1)).alias("items")).withColumn("revision", F.lit(revision))


@query("SELECT page_id, replace(replace(url, '://', '/'), '/', chr(1)) AS place FROM pages")
def q_component_order(spark, sf_dir):
    """A sort by path components, not by characters; the separator sorts before all of them."""
    path = F.replace("url", F.lit("://"), F.lit("/"))
    return read(spark, sf_dir, "pages").orderBy(F.split(path, "/"), "page_id").select("page_id", F.replace(path, F.lit("/"), F.lit("\x01")).alias("place"))


from . import kernels, trees  # noqa: E402, F401 - they register queries of their own
