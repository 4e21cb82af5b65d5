"""Queries that run the kernels of builds and verification, each over all embeddings as 8 x 8 planes of bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import ContractError
from ..functions import frames, png, raster
from ..functions.profiles import CameraSpec, NetSpec
from .registry import query
from .views import read

NET, CAMERA = NetSpec(4, 4, 1, 1, 1, 1, 9, 6, 6), CameraSpec(width=16, height=16, stride=32, file_bytes=512)
GROWN = NetSpec(16, 16, 2, 2, 2, 2, 0, 20, 20)


def vectors(spark, sf_dir) -> DataFrame:
    """(plane, v): an embedding's first 64 numbers as bytes."""
    unit = lambda e: F.least(F.greatest(e.cast("double") * 0.5 + 0.5, F.lit(0.0)), F.lit(1.0))
    bytes_of = F.transform(F.slice("embedding", 1, 64), lambda e: F.floor(unit(e) * 255).cast("int"))
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("plane"), bytes_of.alias("v"))


def per_plane(planes: DataFrame, schema: str, solve: Callable[[int, np.ndarray], list[tuple]]) -> DataFrame:
    """The rows that ``solve`` makes of each plane (its number, 8 x 8 bytes)."""
    target = StructType.fromDDL(schema)

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(target)
        for batch in batches:
            rows = [r for n, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in solve(n, np.array(v, np.uint8).reshape(8, 8))]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    return planes.mapInArrow(work, target)


# planes as lists, and how lists are resized, in SQL; v[8 * y + x + 1] is a pixel
LISTS = "pl AS (SELECT vec_id AS plane, list_transform(embedding[1:64], lambda e: CAST(floor(least(greatest(CAST(e AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE), 0), 1) * 255) AS BIGINT)) AS v FROM embeddings)"


def hex_of(numbers: str) -> str:
    return f"array_to_string(list_transform({numbers}, lambda p: printf('%02x', p)), '')"


def sums_of(width: int, height: int, pixel: str) -> str:
    """A list of width * height pixels; ``pixel`` is an expression of x and y."""
    return f"list_transform(range(0, {width * height}), lambda o: {pixel.replace('{x}', f'(o % {width})').replace('{y}', f'(o // {width})')})"


def total(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


HALF = sums_of(4, 4, "(v[16 * {y} + 2 * {x} + 1] + v[16 * {y} + 2 * {x} + 2] + v[16 * {y} + 2 * {x} + 9] + v[16 * {y} + 2 * {x} + 10] + 2) >> 2")
QUARTER = sums_of(2, 2, "CAST(round_even(" + total([f"v[32 * {{y}} + 4 * {{x}} + {8 * i + j + 1}]" for i in range(4) for j in range(4)]) + " / CAST(16 AS DOUBLE), 0) AS BIGINT)")
# three output cells cover eight source cells: shares of an output cell in eighths
_THIRDS = "[[3, 3, 2, 0, 0, 0, 0, 0], [0, 0, 1, 3, 3, 1, 0, 0], [0, 0, 0, 0, 0, 2, 3, 3]]"
THIRD = sums_of(3, 3, "CAST(round_even(" + total([f"v[{8 * i + j + 1}] * {_THIRDS}[{{y}} + 1][{i + 1}] * {_THIRDS}[{{x}} + 1][{j + 1}]" for i in range(8) for j in range(8)]) + " / CAST(64 AS DOUBLE), 0) AS BIGINT)")
NEAREST = "list_transform(range(0, {n}), lambda o: v[8 * (o // {w} * 8 // {w}) + o % {w} * 8 // {w} + 1])"


def linear(size: int) -> str:
    """Two taps an axis in units of 1/2048; an output cell's place is (o + 1/2) * 8 / size - 1/2."""
    first = lambda o: f"CAST(greatest(floor((({o}) + 0.5::DOUBLE) * 8 / {size} - 0.5::DOUBLE), 0) AS BIGINT)"
    rest = lambda o: f"(CASE WHEN (({o}) + 0.5::DOUBLE) * 8 / {size} - 0.5::DOUBLE < 0 OR {first(o)} >= 7 THEN 0 ELSE CAST(round_even((((({o}) + 0.5::DOUBLE) * 8 / {size} - 0.5::DOUBLE) - {first(o)}) * 2048, 0) AS BIGINT) END)"
    at = lambda y, x: f"v[8 * least({y}, 7) + least({x}, 7) + 1]"
    row = lambda y: f"(({at(y, first('{x}'))} * (2048 - {rest('{x}')}) + {at(y, first('{x}') + ' + 1')} * {rest('{x}')}) >> 4)"
    pixel = f"(((({row(first('{y}'))} * (2048 - {rest('{y}')})) >> 16) + (({row(first('{y}') + ' + 1')} * {rest('{y}')}) >> 16) + 2) >> 2)"
    return sums_of(size, size, pixel)


def padded(inner: str, size: int, border: int, value: int) -> str:
    """A list of (size + 2 * border) squared pixels around the list ``inner``."""
    whole = size + 2 * border
    inside = f"(o // {whole}) BETWEEN {border} AND {border + size - 1} AND (o % {whole}) BETWEEN {border} AND {border + size - 1}"
    return f"list_transform(range(0, {whole * whole}), lambda o: CASE WHEN {inside} THEN ({inner})[(o // {whole} - {border}) * {size} + o % {whole} - {border} + 1] ELSE {value} END)"


_MIXED = "list_transform(range(1, 65), lambda i: CASE plane % 3 WHEN 0 THEN v[i] WHEN 1 THEN v[i] * 7 % 256 ELSE (v[i] * 3735 + v[65 - i] * 19235 + v[i] * 7 % 256 * 9798 + 16384) >> 15 END)"


@query(f"WITH {LISTS} SELECT plane, ['native_gray', 'r_only', 'color_to_gray'][plane % 3 + 1] AS semantics, {hex_of(_MIXED)} AS gray, plane % 5 = 0 OR list_max(v) = 0 AS red_only FROM pl")
def q_kernel_gray(spark, sf_dir):
    """The kernel that builds use, on images of one, three and four channels; wider samples are refused."""

    def solve(n, v):
        image = np.stack([v, v.ravel()[::-1].reshape(8, 8), v * np.uint8(7), v][: 3 + n % 2], 2)
        kind = raster.SEMANTICS[n % 3]
        gray = raster.to_gray(v[:, :, None] if n % 2 else v, kind) if n % 3 == 0 else raster.to_gray(image, kind)
        red = image.copy()
        red[:, :, :2] *= np.uint8(n % 5 != 0)
        try:
            raster.to_gray(image.astype(np.uint16), kind)
        except ContractError:
            return [(n, kind, gray.tobytes().hex(), raster.only_red(red))]
        return []

    return per_plane(vectors(spark, sf_dir), "plane bigint, semantics string, gray string, red_only boolean", solve)


_SIZES = [("area", 4, HALF), ("area", 2, QUARTER), ("area", 3, THIRD), ("linear", 4, HALF), ("linear", 5, linear(5)), ("linear", 16, linear(16)), *[("nearest", w, NEAREST.format(n=w * w, w=w)) for w in (3, 5, 16)]]


@query(f"WITH {LISTS} " + " UNION ALL ".join(f"SELECT plane, '{kind}' AS kind, CAST({w} AS BIGINT) AS width, {hex_of(pixels)} AS pixels FROM pl" for kind, w, pixels in _SIZES))
def q_kernel_resize(spark, sf_dir):
    """The kernels that builds use, with their own rounding."""
    solve = lambda n, v: [(n, kind, w, raster.resize(v, w, w, kind, kind).tobytes().hex()) for kind, w, _ in _SIZES]
    return per_plane(vectors(spark, sf_dir), "plane bigint, kind string, width bigint, pixels string", solve)


@query(f"WITH {LISTS} SELECT plane, {hex_of(padded(HALF, 4, 1, 9))} AS shrunk, {hex_of(padded('grown', 16, 2, 0))} AS grown FROM (SELECT *, {linear(16)} AS grown FROM pl)")
def q_kernel_net_plane(spark, sf_dir):
    """Red channel, resize and border as one, growing and shrinking."""

    def solve(n, v):
        image = np.stack([v * 0, v * 0, v], 2)
        return [(n, *(raster.net_plane(image, "r_only", spec.validate()).tobytes().hex() for spec in (NET, GROWN)))]

    return per_plane(vectors(spark, sf_dir), "plane bigint, shrunk string, grown string", solve)


_TWELVE = "list_transform({v}, lambda p: CAST(round_even(p * (CAST(4095 AS DOUBLE) / CAST(255 AS DOUBLE)), 0) AS BIGINT))"
_PACKED = "array_to_string(list_transform(range(0, len({s}) // 2), lambda k: printf('%02x%02x%02x', {s}[2 * k + 1] & 255, (({s}[2 * k + 2] & 15) << 4) | ({s}[2 * k + 1] >> 8), {s}[2 * k + 2] >> 4)), '')"


@query(f"WITH {LISTS}, t AS (SELECT plane, v, {_TWELVE.format(v='v')} AS s FROM pl) SELECT plane, array_to_string(s, ',') AS samples, {hex_of('v')} AS back, {_PACKED.format(s='s')} AS packed, array_to_string(s, ',') AS unpacked, plane % 2 = 0 AS accepted FROM t")
def q_kernel_depth(spark, sf_dir):
    """Both depths, packing and unpacking; samples of more than 12 bits are refused."""
    text = lambda a: ",".join(map(str, a.tolist()))

    def solve(n, v):
        samples = frames.to_twelve(v).ravel()
        packed = frames.pack(samples)
        try:
            frames.checked(samples.astype(np.int64) + (n % 2) * 4096)
            accepted = True
        except ContractError:
            accepted = False
        return [(n, text(samples), frames.to_eight(samples).tobytes().hex(), packed.hex(), text(frames.unpack(packed)), accepted)]

    return per_plane(vectors(spark, sf_dir), "plane bigint, samples string, back string, packed string, unpacked string, accepted boolean", solve)


_ROWS = "array_to_string(list_transform(range(0, 16), lambda y: " + _PACKED.format(s="s[16 * y + 1:16 * y + 16]").replace("lambda k", "lambda k") + " || repeat('0', 16)), '')"
_FRAME = f"WITH {LISTS}, big AS (SELECT plane, {linear(16)} AS g FROM pl), t AS (SELECT plane, {_TWELVE.format(v='g')} AS s FROM big), f AS (SELECT plane, s, {_ROWS} AS h FROM t)"


@query(_FRAME + " SELECT plane, h AS frame, sha256(from_hex(h)) AS digest, CASE plane % 4 WHEN 1 THEN 'a row tail holds data' WHEN 2 THEN 'a frame has 512 bytes, not 511' WHEN 3 THEN 'ok' ELSE 'ok' END AS broken, "
       "CAST(24 AS BIGINT) AS active, CAST(8 AS BIGINT) AS tail FROM f")  # fmt: skip
def q_kernel_frame(spark, sf_dir):
    """Whole frames, encoded and decoded again; tails that hold data and short frames are refused."""
    rest = CAMERA.summary()

    def solve(n, v):
        samples = raster.camera_plane(np.stack([v * 0, v * 0, v], 2), "r_only", CAMERA)
        payload = frames.encode_checked(samples, CAMERA)
        damaged = {1: payload[:24] + b"\x01" + payload[25:], 2: payload[:-1]}.get(n % 4, payload)
        try:
            frames.decode_frame(damaged, CAMERA)
            broken = "ok"
        except ContractError as bad:
            broken = str(bad)
        return [(n, payload.hex(), hashlib.sha256(payload).hexdigest(), broken, rest["active_bytes_per_row"], rest["padding_bytes_per_row"])]

    return per_plane(vectors(spark, sf_dir), "plane bigint, frame string, digest string, broken string, active bigint, tail bigint", solve)


@query(f"WITH {LISTS} SELECT plane, {hex_of('v')} AS pixels, CAST(8 AS BIGINT) AS width, CAST(8 AS BIGINT) AS height, CAST(8 AS BIGINT) AS depth, CAST(0 AS BIGINT) AS colour, 'uint8' AS dtype, list_min(v) AS least, list_max(v) AS most FROM pl")
def q_kernel_png(spark, sf_dir):
    """Gray files and back, at every compression level, with the header that the image contract asks for."""

    def solve(n, v):
        raw = png.encode_gray(v, n % 10)
        width, height, depth, colour, _ = png.header(raw)
        back = png.decode_image(raw)
        facts = raster.metadata(back)
        return [(n, back.tobytes().hex(), width, height, depth, colour, facts["dtype"], facts["min"], facts["max"])]

    return per_plane(vectors(spark, sf_dir), "plane bigint, pixels string, width bigint, height bigint, depth bigint, colour bigint, dtype string, least bigint, most bigint", solve)


@query(f"WITH {LISTS} SELECT plane, v = list_transform(v, lambda p: CASE WHEN plane % 2 = 1 THEN (p + 1) % 256 ELSE p END) AS same FROM pl")
def q_kernel_equality(spark, sf_dir):
    """Pixels of a written file against its plane, or against another one."""
    solve = lambda n, v: [(n, bool(np.array_equal(png.decode(png.encode_gray(v)), v + np.uint8(n % 2))))]
    return per_plane(vectors(spark, sf_dir), "plane bigint, same boolean", solve)
