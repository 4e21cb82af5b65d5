"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; its result is written as Parquet and read again as the
next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumaset.llm import bpe, exact_dedup, mixing, near_dups, packing, quality
from lumaset.llm.shared import materialise, read


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, doesn't reject.

    Null and empty texts are judged alike, from zero statistics; long texts whole; repeated rows each, and equal texts
    alike; an empty table stays empty.  Columns keep their names and values, also those named like a score.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id.

    Null texts equal empty ones; long texts are compared whole; rows that repeat both id and text stay together; a null
    id stays only where all ids of its group are null; an empty table stays empty.  Columns keep their names and values.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id: five-word shingles, similarity of 0.8 and more.

    Texts without words, null and empty ones too, are like nothing and stay; long texts are compared whole; rows that
    repeat the least id stay together; an empty table stays empty.  Columns keep their names and values.
    """
    return near_dups.drop_near_duplicates(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, so that sources weigh as the square roots of their sizes.

    A null source is one with the empty name; null and empty texts weigh one byte; rows that repeat an id get as many
    copies each; an empty table stays empty.  Columns keep their names and values.
    """
    return mixing.mixture(docs, exponent=0.5, epochs=1.0, seed="mix")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' ids in sequences of 2048.

    Null and empty texts are one end id; only longer documents are cut; copies are packed each; an empty table gives
    no rows.  Columns but id and text don't matter.
    """
    return packing.pack_documents(docs, bpe.vocabulary("word_bpe_49k.json"), 2048, end=0)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("near-duplicate removal", drop_near_copies),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier, MinHash and packing stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
