"""Checks as queries: each returns the rows that offend."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import item_signature


def overlaps(items: DataFrame, value: str, split: str = "split") -> DataFrame:
    """(value, splits) of values in more than one split: one shuffle instead of a join for each pair of splits."""
    found = items.groupBy(value).agg(F.sort_array(F.collect_set(split)).alias("splits"))
    return found.where(F.size("splits") > 1)


def overlapping_pairs(items: DataFrame, value: str, splits: tuple[str, ...]) -> DataFrame:
    """(left, right, value) for each pair of splits that share a value, in the order of ``splits``."""
    both = overlaps(items, value)
    order = F.array(*[F.lit(s) for s in splits])
    present = F.filter(order, lambda s: F.array_contains("splits", s))
    pairs = F.flatten(F.transform(present, lambda a, i: F.transform(F.filter(present, lambda _b, j: j > i), lambda b: F.struct(a.alias("left"), b.alias("right")))))
    return both.select(F.explode(pairs).alias("pair"), F.col(value)).select("pair.left", "pair.right", value)


def duplicates(items: DataFrame, *paths: str) -> DataFrame:
    """(path, n) of paths that occur more than once over all path columns."""
    each = items.select(F.explode(F.array(*paths)).alias("path"))
    return each.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def checksum_disagreements(listed: DataFrame, sums: DataFrame) -> DataFrame:
    """Paths of ``listed`` (path, sha256) that SUMS lack or state otherwise."""
    stated = sums.select("path", F.col("sha256").alias("stated"))
    return listed.join(stated, "path", "left").where(~F.col("sha256").eqNullSafe(F.col("stated"))).select("path", "sha256", "stated")


def unlisted_sums(listed: DataFrame, sums: DataFrame) -> DataFrame:
    """Entries of SUMS that are no item's output: these files are hashed again."""
    return sums.join(listed.select("path"), "path", "left_anti")


def worklist(items: DataFrame, state: DataFrame, profile_hash: str, now: DataFrame | None = None) -> DataFrame:
    """Items without a valid finished state.

    ``state`` has source_image, signature and the hashes of sources and outputs when the item was finished; ``now``
    has the same hashes as they are, and stats; without it, only the signatures are compared.
    """
    wanted = items.withColumn("signature", item_signature(profile_hash))
    if now is None:
        return wanted.join(state, ["source_image", "signature"], "left_anti").drop("signature")
    hashes = ["source_image_sha256", "output_image_sha256", "output_label_sha256"]
    current = now.select("source_image", "source_image_size", "source_image_mtime_ns", "source_label_sha256", *hashes)
    # what was recorded and what is must agree in every hash and stat
    finished = wanted.join(state, ["source_image", "signature"]).select(*items.columns, *hashes)
    same = finished.join(current, ["source_image", "source_image_size", "source_image_mtime_ns", "source_label_sha256", *hashes], "left_semi")
    return items.join(same.select("source_image"), "source_image", "left_anti")


def failures(*checks: tuple[str, DataFrame, Column, Column | None]) -> DataFrame:
    """One table (code, subject, detail) of all checks: (code, offending rows, subject, detail)."""
    rows = [df.select(F.lit(code).alias("code"), subject.cast("string").alias("subject"), (F.lit(None) if detail is None else detail).cast("string").alias("detail")) for code, df, subject, detail in checks]
    return reduce(DataFrame.unionByName, rows)


# What may not be published.
FORBIDDEN_SUFFIXES = (".pt", ".pth", ".onnx", ".engine", ".bin", ".tar", ".gz", ".zst", ".zip", ".pem", ".key")
FORBIDDEN_NAMES = (".env", ".git-credentials")
FORBIDDEN_NAME_PARTS = ("credential", "id_rsa", "id_ed25519")
FORBIDDEN_FOLDERS = ("datasets/", "derived/", "outputs/", "runs/", "cache/", "__pycache__/")
MAX_BYTES = 1_048_576


def content_violation(path: Column, size: Column) -> Column:
    """Why a file may not be published, or null; the first reason counts."""
    lowered = F.lower(F.replace(path, F.lit("\\"), F.lit("/")))
    name = F.element_at(F.split(lowered, "/"), -1)
    any_of = lambda hits: reduce(lambda a, b: a | b, hits)
    return (
        F.when(name.isin(*FORBIDDEN_NAMES) | name.startswith(".env."), "environment or credential file")
        .when(any_of([name.contains(p) for p in FORBIDDEN_NAME_PARTS]), "name like a credential")
        .when(any_of([lowered.contains(p) for p in FORBIDDEN_FOLDERS]), "folder of generated data")
        .when(any_of([lowered.endswith(s) for s in FORBIDDEN_SUFFIXES]), "generated artifact")
        .when(size > MAX_BYTES, "larger than 1 MiB")
    )
