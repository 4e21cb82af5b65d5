"""Pose labels as Column expressions: parse, check, transform, format.

A label line is ``class cx cy w h`` and K times ``x y v``.  Everything is evaluated in binary64, left to right, so
that texts come out digit for digit; nothing leaves the JVM.

Tables with a line a row are parsed and moved by ``with_parsed`` and ``with_moved``: plain columns, each computed once.
Lines inside arrays take ``parse_line`` and ``transform_label``, the same expressions inside ``let``.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profiles import NetSpec

#: Line ends and white space as Python's str methods see them.
LINE_ENDS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SOLID = "(?U)[^\\s\\x1c-\\x1f]"
NUMBER = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
POINT = "struct<x:double,y:double,v:double>"


def lines_of(text: Column) -> Column:
    return F.split(text, LINE_ENDS, -1)


def is_solid(line: Column) -> Column:
    return line.rlike(SOLID)


def tokens_of(line: Column) -> Column:
    return F.array_remove(F.split(F.translate(line, SPACES, " " * len(SPACES)), " "), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(token: Column) -> Column:
    return F.when(token.rlike(NUMBER), token.try_cast("double"))


def parse_line(line: Column, keypoints: int = 2) -> Column:
    """struct(class_id, cx, cy, w, h, kpts, error); error is null for a valid line."""
    size = 5 + 3 * keypoints

    def read(tokens: Column) -> Column:
        numbers = F.struct(*[_number(F.get(tokens, F.lit(i))).alias(f"n{i}") for i in range(size)])
        return let(numbers, lambda n: _checked(F.size(tokens), [n[f"n{i}"] for i in range(size)]))

    return let(tokens_of(line), read)


def with_parsed(rows: DataFrame, line: str = "line", name: str = "label", keypoints: int = 2) -> DataFrame:
    """The rows with ``parse_line`` of a column, every part of it computed once a row."""
    size, kept = 5 + 3 * keypoints, [F.col(c) for c in rows.columns if c != name]
    split = rows.withColumn("__tokens", tokens_of(F.col(line)))
    numbers = split.select(*kept, F.size("__tokens").alias("__size"), *[_number(F.get("__tokens", F.lit(i))).alias(f"__n{i}") for i in range(size)])
    return _settled(numbers.select(*kept, _checked(F.col("__size"), [F.col(f"__n{i}") for i in range(size)]).alias(name)), name)


def _settled(rows: DataFrame, name: str) -> DataFrame:
    """The rows; filters on the column are not pushed below, where they would compute it a second time."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(name)).alias(name))


def _label(class_id: Column, box: list[Column], points: list[Column], error: Column) -> Column:
    kpts = F.array(*points) if points else F.array().cast(f"array<{POINT}>")
    return F.struct(class_id.alias("class_id"), *[v.alias(n) for v, n in zip(box, ("cx", "cy", "w", "h"))], kpts.alias("kpts"), error.alias("error"))


def _checked(count: Column, n: list[Column]) -> Column:
    """The label that ``count`` tokens with the values ``n`` (null for what is no number) make."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    unit = lambda v: (v >= 0) & (v <= 1)
    every = lambda tests: reduce(lambda a, b: a & b, tests)
    cls, box = n[0], n[1:5]
    points = [(n[i], n[i + 1], n[i + 2]) for i in range(5, len(n), 3)]
    seen = [((x == 0) & (y == 0) & (v == 0)) | (unit(x) & unit(y)) for x, y, v in points]
    error = (
        F.when(count != len(n), F.concat(F.lit(f"expected {len(n)} values, found "), count.cast("string")))
        .when(~every([finite(v) for v in n]), F.lit("a value is not a finite number"))
        .when((cls < 0) | (cls != F.floor(cls)), F.lit("the class is not a non-negative integer"))
        .when(~every([unit(v) for v in box]), F.lit("the box is outside 0..1"))
        .when((box[2] <= 0) | (box[3] <= 0), F.lit("the box has no area"))
    )
    if points:
        error = error.when(~every([v >= 0 for _, _, v in points]), F.lit("a visibility is negative")).when(~every(seen), F.lit("a keypoint is outside 0..1"))
    return _label(cls.try_cast("int"), box, [F.struct(x.alias("x"), y.alias("y"), v.alias("v")) for x, y, v in points], error)


def placed(value: Column, source: Column, resized: int, pad: int, output: int) -> Column:
    """A normalised coordinate through resize and border; the order of operations fixes the last digit."""
    return (((value * source) * F.lit(float(resized))) / source + F.lit(float(pad))) / F.lit(float(output))


def scaled(value: Column, resized: int, output: int) -> Column:
    return (value * F.lit(float(resized))) / F.lit(float(output))


def _moved(one: Column, width: Column, height: Column, spec: NetSpec, keypoints: int) -> Column:
    x_of = lambda v: placed(v, width, spec.resize_width, spec.pad_left, spec.output_width)
    y_of = lambda v: placed(v, height, spec.resize_height, spec.pad_top, spec.output_height)

    def point(p: Column) -> Column:
        moved = F.struct(x_of(p["x"]).alias("x"), y_of(p["y"]).alias("y"), p["v"].alias("v"))
        return F.when((p["x"] == 0) & (p["y"] == 0) & (p["v"] == 0), p).otherwise(moved)

    box = [x_of(one["cx"]), y_of(one["cy"]), scaled(one["w"], spec.resize_width, spec.output_width), scaled(one["h"], spec.resize_height, spec.output_height)]
    return _label(one["class_id"], box, [point(F.get(one["kpts"], F.lit(k))) for k in range(keypoints)], one["error"])


def _inside(m: Column, width: Column, height: Column) -> Column:
    box = reduce(lambda a, b: a & b, [(m[c] >= 0) & (m[c] <= 1) for c in ("cx", "cy", "w", "h")])
    error = F.when(m["error"].isNotNull(), m["error"]).when((width <= 0) | (height <= 0), F.lit("the source has no area")).when(~box, F.lit("the moved box is outside 0..1"))
    return F.struct(*[m[f].alias(f) for f in ("class_id", "cx", "cy", "w", "h", "kpts")], error.alias("error"))


def transform_label(label: Column, width: Column, height: Column, spec: NetSpec, keypoints: int = 2) -> Column:
    """A parsed label in output coordinates; absent keypoints (0 0 0) stay as they are."""
    width, height = width.cast("double"), height.cast("double")
    return let(label, lambda one: let(_moved(one, width, height, spec, keypoints), lambda m: _inside(m, width, height)))


def with_moved(rows: DataFrame, width: str, height: str, spec: NetSpec, label: str = "label", name: str = "moved", keypoints: int = 2) -> DataFrame:
    """The rows with ``transform_label`` of a column, computed once a row."""
    w, h = F.col(width).cast("double"), F.col(height).cast("double")
    moved = rows.withColumn(name, _moved(F.col(label), w, h, spec, keypoints))
    return _settled(moved.withColumn(name, _inside(F.col(name), w, h)), name)


def eight_decimals(value: Column) -> Column:
    return F.format_number(value, 8)


def general(value: Column) -> Column:
    """Six significant digits without trailing zeros, as C's %g prints them."""
    size = F.abs(value)
    whole = (value > 0) & (value < 1e6) & (value == F.floor(value))
    fixed = F.lit(None).cast("string")
    for power in range(-4, 6):
        # a number that rounds up to the next power of ten is printed the same with one digit less
        pattern = "0" + ("." + "#" * (5 - power) if power < 5 else "")
        fixed = F.when((size >= 10.0**power) & (size < 10.0 ** (power + 1)), F.call_function("format_number", value, F.lit(pattern))).otherwise(fixed)
    wide = F.regexp_replace(F.format_string("%.5e", value), "\\.?0+e", "e")
    near_million = (size >= 999999.5) & (size < 1e6)
    zero = F.when(F.signum(value).cast("string") == "-0.0", "-0").otherwise("0")
    return F.when(whole, F.floor(value).cast("string")).when(value == 0, zero).when(near_million | fixed.isNull(), wide).otherwise(fixed)


def spell_label(one: Column, keypoints: int = 2) -> Column:
    """The line of a label; the column is read many times, so it should be one that is already computed."""
    box = [eight_decimals(one[c]) for c in ("cx", "cy", "w", "h")]
    points = [F.get(one["kpts"], F.lit(k)) for k in range(keypoints)]
    return F.concat_ws(" ", one["class_id"].cast("string"), *box, *[part for p in points for part in (eight_decimals(p["x"]), eight_decimals(p["y"]), general(p["v"]))])


def format_label(label: Column, keypoints: int = 2) -> Column:
    return let(label, lambda one: spell_label(one, keypoints))


def transform_text(text: Column, width: Column, height: Column, spec: NetSpec, keypoints: int = 2) -> Column:
    """struct(text, error): all non-blank lines transformed; the first error carries its 1-based raw line number."""
    numbered = F.transform(lines_of(text), lambda line, i: F.struct(line.alias("line"), (i + 1).alias("no")))
    moved = F.transform(
        F.filter(numbered, lambda n: is_solid(n["line"])),
        lambda n: F.struct(n["no"].alias("no"), transform_label(parse_line(n["line"], keypoints), width, height, spec, keypoints).alias("label")),
    )

    def joined(rows: Column) -> Column:
        first = F.get(F.filter(rows, lambda m: m["label"]["error"].isNotNull()), F.lit(0))

        def ended(bad: Column) -> Column:
            error = F.when(bad.isNotNull(), F.concat(F.lit("line "), bad["no"].cast("string"), F.lit(": "), bad["label"]["error"]))
            out = F.array_join(F.transform(rows, lambda m: F.concat(format_label(m["label"], keypoints), F.lit("\n"))), "")
            return F.struct(F.when(bad.isNull(), out).alias("text"), error.alias("error"))

        return let(first, ended)

    return let(moved, joined)


def to_camera(x: Column, y: Column, width: Column, height: Column, camera_width: int = 2000, camera_height: int = 2000) -> Column:
    """struct(x, y): continuous source point in camera space, not rounded; null where it is not in the image."""
    valid = (width > 0) & (height > 0) & ~F.isnan(x) & ~F.isnan(y) & (x >= 0) & (y >= 0) & (x <= width) & (y <= height)
    return F.when(valid, F.struct((x * F.lit(float(camera_width)) / width).alias("x"), (y * F.lit(float(camera_height)) / height).alias("y")))


def geometry(width: Column, height: Column, spec: NetSpec) -> list[Column]:
    """Scales and border of a source size, as columns."""
    return [
        (F.lit(float(spec.resize_width)) / width).alias("resize_scale_x"),
        (F.lit(float(spec.resize_height)) / height).alias("resize_scale_y"),
        F.array(*[F.lit(p) for p in spec.padding]).alias("padding"),
    ]
