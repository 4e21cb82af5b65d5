"""Small planes as rows (plane, y, x, v): the raster operators as joins and aggregates.

Weights of an axis are a table (o, i, w): output cell o takes share w of source cell i.  The tables have as many
rows as a plane has cells along an axis, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.raster import GRAY_WEIGHTS


def to_twelve(v: Column) -> Column:
    return F.rint(v * F.lit(4095.0 / 255.0)).cast("int")


def to_eight(v: Column) -> Column:
    return F.rint(v * F.lit(255.0 / 4095.0)).cast("int")


def pack_hex(samples: Column) -> Column:
    """Hex of an array of 12-bit samples, two in three bytes; an odd last one is paired with zero."""
    pairs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(samples) / 2).cast("int") - 1), lambda k: F.struct(F.get(samples, 2 * k).alias("a"), F.coalesce(F.get(samples, 2 * k + 1), F.lit(0)).alias("b")))
    byte = lambda n: F.lpad(F.hex(n), 2, "0")

    def trio(p: Column) -> Column:
        a, b = p["a"].cast("bigint"), p["b"].cast("bigint")
        return F.concat(byte(a.bitwiseAND(F.lit(255))), byte(F.shiftleft(b.bitwiseAND(F.lit(15)), 4).bitwiseOR(F.shiftright(a, 8))), byte(F.shiftright(b, 4)))

    return F.when(F.size(samples) == 0, F.lit("")).otherwise(F.array_join(F.transform(pairs, trio), ""))


def unpack_hex(packed: Column) -> Column:
    """Samples of packed hex, always an even number."""
    number = lambda start: F.conv(F.substr(packed, start, F.lit(2)), 16, 10).cast("int")

    def pair(k: Column) -> Column:
        b0, b1, b2 = (number(k * 6 + 1 + 2 * i) for i in range(3))
        return F.array(b0 + F.lit(256) * b1.bitwiseAND(F.lit(15)), F.shiftright(b1, 4) + F.lit(16) * b2)

    return F.flatten(F.transform(F.sequence(F.lit(0), (F.length(packed) / 6).cast("int") - 1), pair))


def frame_row_hex(samples: Column, stride: int) -> Column:
    """A packed row with its zero tail up to the stride."""
    return F.rpad(pack_hex(samples), 2 * stride, "0")


def gray(b: Column, g: Column, r: Column, semantics: Column) -> Column:
    wb, wg, wr = GRAY_WEIGHTS
    mixed = F.shiftright(b * wb + g * wg + r * wr + (1 << 14), 15)
    return F.when(semantics == "r_only", r).when(semantics == "color_to_gray", mixed).when(semantics == "native_gray", b)


def axis_weights(df: DataFrame, source: int, size: int, kind: str) -> DataFrame:
    """Exact weights of one axis, for integer or dyadic ratios of sizes."""
    rows = []
    for o in range(size):
        if kind == "nearest":
            rows.append((o, min(source - 1, o * source // size), 1.0))
        elif kind == "area":
            lo, hi = o * source / size, (o + 1) * source / size
            rows += [(o, i, (min(hi, i + 1) - max(lo, i)) * size / source) for i in range(int(lo), min(source, -int(-hi // 1)))]
        else:
            place = (o + 0.5) * source / size - 0.5
            first = int(place // 1)
            rest = place - first
            taps = {max(0, min(source - 1, first)): 1 - rest}
            second = max(0, min(source - 1, first + 1))
            taps[second] = taps.get(second, 0.0) + rest
            rows += [(o, i, w) for i, w in taps.items() if w]
    return df.sparkSession.createDataFrame(rows, "o int, i int, w double")


def resize(plane: DataFrame, source: tuple[int, int], size: tuple[int, int], kind: str) -> DataFrame:
    """(plane, y, x, v) at the new (width, height); half values round up."""
    across = F.broadcast(axis_weights(plane, source[0], size[0], kind).toDF("xo", "x", "wx"))
    down = F.broadcast(axis_weights(plane, source[1], size[1], kind).toDF("yo", "y", "wy"))
    spread = plane.join(across, "x").join(down, "y")
    sums = spread.groupBy("plane", "yo", "xo").agg(F.sum(F.col("v") * F.col("wy") * F.col("wx")).alias("s"))
    return sums.select("plane", F.col("yo").alias("y"), F.col("xo").alias("x"), F.floor(F.col("s") + 0.5).cast("int").alias("v"))


def pad(plane: DataFrame, size: tuple[int, int], border: int, value: int = 0) -> DataFrame:
    """Planes inside a constant border: moved cells, and the border's own cells."""
    width, height = size[0] + 2 * border, size[1] + 2 * border
    moved = plane.select("plane", (F.col("y") + border).alias("y"), (F.col("x") + border).alias("x"), "v")
    inside = (F.col("y") >= border) & (F.col("y") < height - border) & (F.col("x") >= border) & (F.col("x") < width - border)
    cells = plane.select("plane").distinct().withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    return moved.unionByName(cells.where(~inside).withColumn("v", F.lit(value)))


def metadata(plane: DataFrame) -> DataFrame:
    return plane.groupBy("plane").agg(
        (F.max("x") + 1).cast("bigint").alias("width"), (F.max("y") + 1).cast("bigint").alias("height"), F.min("v").alias("least"), F.max("v").alias("most"),
        F.count_if(F.col("v") != 0).alias("nonzero"),
    )
