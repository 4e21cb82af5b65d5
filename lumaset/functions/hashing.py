"""Keys, signatures and revisions: hashes that define identity."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields of an item that its identity rests on, in the order of canonical JSON.
EVIDENCE = ("source_image", "source_image_mtime_ns", "source_image_size", "source_label", "source_label_sha256")


def seeded_key(*parts: Any) -> Column:
    """Hex SHA-256 of parts joined by bars; strings are column names, other values and columns are themselves."""
    columns = [F.col(p) if isinstance(p, str) else p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in columns]), 256)


def selection_key(seed: str, image: str = "source_image") -> Column:
    return seeded_key(F.lit(seed), image)


def smoke_key(seed: int, split: str = "source_split", label: str = "source_label") -> Column:
    return seeded_key(F.lit(seed), split, label)


def sample_key(image: str = "source_image") -> Column:
    return F.sha2(F.col(image), 256)


def evidence_json(extra: Mapping[str, Column] | None = None) -> Column:
    """Canonical JSON of an item's evidence, with further fields in their alphabetical place."""
    fields = {name: F.col(name) for name in EVIDENCE} | dict(extra or {})
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]))


def item_signature(profile_hash: str) -> Column:
    return F.sha2(evidence_json({"profile_hash": F.lit(profile_hash)}), 256)


def canonical_json(value: Any) -> bytes:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()


def canonical_hash(value: Any) -> str:
    return hashlib.sha256(canonical_json(value)).hexdigest()


def pretty_json(value: Any) -> bytes:
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True).encode() + b"\n"


def revision_of(evidence: Iterable[str], dataset_sha256: str) -> str:
    """Hash of the canonical JSON of all items' evidence in manifest order, in constant memory."""
    return revision_of_blocks(((b"," if i else b"") + one.encode() for i, one in enumerate(evidence)), dataset_sha256)


def revision_of_blocks(blocks: Iterable[bytes], dataset_sha256: str) -> str:
    """As ``revision_of``, from the bytes of the list between its brackets."""
    digest = hashlib.sha256(b'{"dataset_yaml_sha256":"' + dataset_sha256.encode() + b'","items":[')
    for block in blocks:
        digest.update(block)
    digest.update(b"]}")
    return digest.hexdigest()


def source_revision(ordered_items: DataFrame, dataset_sha256: str) -> str:
    """Revision of items that are in manifest order; rows stream through the driver one partition at a time."""
    rows = ordered_items.select(evidence_json().alias("e")).toLocalIterator(prefetchPartitions=True)
    return revision_of((r["e"] for r in rows), dataset_sha256)


def sha256_file(path: str | os.PathLike) -> str:
    with open(path, "rb", buffering=0) as stream:
        # small files are read as a whole, which takes no buffer
        if os.fstat(stream.fileno()).st_size <= 1 << 18:
            return hashlib.sha256(stream.readall()).hexdigest()
        return hashlib.file_digest(stream, "sha256").hexdigest()
