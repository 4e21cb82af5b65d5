import random

import pytest
from pyspark.sql import functions as F

from lumaset.functions import labels
from lumaset.functions.profiles import NetSpec

SPEC = NetSpec()


def moved(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, w int, h int")
    out = df.select("i", labels.transform_text(F.col("text"), F.col("w"), F.col("h"), SPEC).alias("m")).orderBy("i").collect()
    return [(r.m.text, r.m.error) for r in out]


def test_golden_line(spark):
    # The published golden line and what it becomes
    [(text, error)] = moved(spark, [("3 0.5 0.5 0.2 0.4 0.25 0.75 2 0 0 0", 640, 480)])
    assert error is None
    assert text == "3 0.50000000 0.50000000 0.15625000 0.31250000 0.30468750 0.69531250 2 0.00000000 0.00000000 0\n"


GOOD = "1 0.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2"
BAD = {
    "0 0.5": "line 1",
    "-1 0.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "class",
    "1.5 0.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "class",
    "1 1.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "box",
    "1 0.5 0.5 0 0.25 0.4 0.4 2 0.6 0.6 2": "area",
    "1 0.5 0.5 0.25 0.25 1.1 0.4 2 0.6 0.6 2": "keypoint",
    "1 0.5 0.5 0.25 0.25 0.4 0.4 -2 0.6 0.6 2": "visibility",
    "1 nan 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "finite",
    "1 inf 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "finite",
    "1 1e400 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "finite",
    "1d 0.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "finite",
    "0x1p3 0.5 0.5 0.25 0.25 0.4 0.4 2 0.6 0.6 2": "finite",
}


def test_errors(spark):
    found = moved(spark, [(f"\n{GOOD}\r\n{bad}" if i % 2 else bad, 10, 10) for i, bad in enumerate(BAD)])
    for i, ((text, error), want) in enumerate(zip(found, BAD.values(), strict=True)):
        assert text is None
        assert (f"line {3 if i % 2 else 1}" if want == "line 1" else want) in error
        assert error.startswith("line 3" if i % 2 else "line 1")


def test_blank_lines_and_line_ends(spark):
    lines = "1 0.500000 0.500000 0.156250 0.156250".split()
    assert len(lines) == 5
    cases = ["", "\n \n", f"{GOOD}\n\n\t{GOOD}  ", f"{GOOD}\x1c{GOOD}", f"{GOOD} {GOOD}", f"{GOOD}\x0b{GOOD}\x85", GOOD.replace(" ", "\x1f　")]
    assert [len((text or "").splitlines()) for text, _ in moved(spark, [(c, 8, 8) for c in cases])] == [0, 0, 2, 2, 2, 2, 1]
    assert moved(spark, [("", 8, 8)])[0] == ("", None)


def test_sentinels(spark):
    rows = [("0 0.5 0.5 0.2 0.2 0 0 1 -0 -0 -0", 7, 9)]
    [(text, _)] = moved(spark, rows)
    assert text.split()[5:] == ["0.10937500", "0.10937500", "1", "-0.00000000", "-0.00000000", "-0"]


def test_general_format(spark):
    values = [0.0, 1.0, 2.0, 0.5, 1e6, 1e-5, 123456.0, 1234567.0, 0.0001, 2.25, 0.1, 999999.0, 1e-4, 12.125]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.g for r in df.select("i", labels.general(F.col("v")).alias("g")).orderBy("i").collect()]
    assert got == [f"{v:g}" for v in values]


def reference(line, width, height):
    t = [float(x) for x in line.split()]
    x_of = lambda v: (((v * width) * 1000.0) / width + 140.0) / 1280.0
    y_of = lambda v: (((v * height) * 1000.0) / height + 140.0) / 1280.0
    out = [str(int(t[0])), *(f"{v:.8f}" for v in (x_of(t[1]), y_of(t[2]), t[3] * 1000.0 / 1280.0, t[4] * 1000.0 / 1280.0))]
    for k in (5, 8):
        x, y, v = t[k : k + 3]
        if (x, y, v) != (0, 0, 0):
            x, y = x_of(x), y_of(y)
        out += [f"{x:.8f}", f"{y:.8f}", f"{v:g}"]
    return " ".join(out) + "\n"


def test_digit_for_digit(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(5000):
        unit = lambda: f"{rnd.random():.{rnd.randint(1, 9)}f}"
        keypoint = lambda: "0 0 0" if rnd.random() < 0.2 else f"{unit()} {unit()} {rnd.choice(['0', '1', '2'])}"
        box = f"{unit()} {unit()} {rnd.uniform(0.01, 1):.6f} {rnd.uniform(0.01, 1):.6f}"
        rows.append((f"{rnd.randint(0, 20)} {box} {keypoint()} {keypoint()}", rnd.randint(1, 5000), rnd.randint(1, 5000)))
    for (text, error), row in zip(moved(spark, rows), rows, strict=True):
        assert error is None
        assert text == reference(*row)


def test_camera_points(spark):
    df = spark.createDataFrame([(560.5, 738.25, 2048, 2048), (-1.0, 0.0, 10, 10), (10.0, 10.0, 10, 10), (float("nan"), 0.0, 10, 10), (1.0, 1.0, 0, 10)], "x double, y double, w int, h int")
    got = [r.p for r in df.select(labels.to_camera(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("p")).collect()]
    assert (got[0].x, got[0].y) == (547.36328125, 720.947265625)
    assert got[1] is None
    assert (got[2].x, got[2].y) == (2000.0, 2000.0)
    assert got[3] is None
    assert got[4] is None


def test_spec():
    with pytest.raises(ValueError):
        NetSpec(pad_left=141).validate()
    assert SPEC.summary(500, 250)["scale_y"] == 4.0
