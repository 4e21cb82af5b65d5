"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, fingerprints, grammar, line_dedup, mixing, near_dups, packing, quality, repeats, token_files
from .shared import read


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixture of all documents, target weights the square roots of the sources' sizes."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"), exponent=0.5, epochs=1.0, seed="mix")
    return mixed.select("doc_id", "source", "text", "copy", "n_copies", "shuffle_key")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeper, size and digest of each document's group of equal texts."""
    found = exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, fitted on labelled rows that are not held out."""
    found = quality.rate_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the lines that over 0.3 of their host's pages, three at least, contain."""
    found = line_dedup.line_dedup(read(spark, sf_dir, "pages"), ratio=0.3, min_pages=3)
    return found.select("page_id", "host", "n_lines", "n_dropped", "kept_text")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes that 200-byte strings which occur elsewhere cover."""
    found = repeats.remove_repeats(read(spark, sf_dir, "documents"), width=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of byte_bpe_50k, whose end id 50256 no text can yield."""
    return token_files.token_counts(read(spark, sf_dir, "documents"), bpe.vocabulary("byte_bpe_50k.json"), 50256)


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of all documents' ids, read back from grammar shards of byte_bpe_50k ids."""
    found = grammar.token_shards(read(spark, sf_dir, "documents"), bpe.vocabulary("byte_bpe_50k.json"), first=50257, end=0)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "bucket", "shard")


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' word_bpe_49k ids in sequences of 2048."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), bpe.vocabulary("word_bpe_49k.json"), 2048, end=0)


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of two words, similarity of 0.8 and more."""
    found = near_dups.near_duplicates(read(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and, in near_id, the least id of the documents that banding and verification join."""
    return fingerprints.with_near_ids(fingerprints.fingerprint_documents(read(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_suffix_dedup, op3_token_counts, op4_exact_dedup, op5_token_shards, op6_quality, op7_line_dedup, op8_pack_sequences, op9_near_dups, op10_fingerprints)}

_MIX = """
WITH RECURSIVE sizes AS (
  SELECT coalesce(source, '') AS src, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS size
  FROM documents GROUP BY 1),
goals AS (SELECT src, size, pow(CAST(size AS DOUBLE), 0.5) AS goal FROM sizes),
rates AS (
  SELECT src, goal / (SELECT sum(goal) FROM goals) * (SELECT CAST(sum(size) AS DOUBLE) FROM goals) / size AS rate FROM goals),
parts AS (SELECT src, rate, greatest(CAST(ceil(rate / 32.0) AS BIGINT), 1) AS parts FROM rates),
cdf AS (
  SELECT src, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM parts
  UNION ALL
  SELECT cdf.src, k + 1, p * (rate / parts) / (k + 1), c + p * (rate / parts) / (k + 1)
  FROM cdf JOIN parts ON cdf.src = parts.src WHERE k < 128),
tables AS (SELECT src, list(c ORDER BY k) AS cdf FROM cdf GROUP BY src),
drawn AS (
  SELECT doc_id, source, text,
         CAST(list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf, lambda c: c <=
           CAST('0x' || substr(sha256('mix|' || doc_id || '|' || i), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))))) AS BIGINT) AS n_copies
  FROM documents d JOIN parts p ON p.src = coalesce(d.source, '') JOIN tables t ON t.src = p.src)
SELECT doc_id, source, text, copy, n_copies,
       CAST('0x' || substr(sha256('mix|order|' || doc_id || '|' || copy), 1, 15) AS BIGINT) AS shuffle_key
FROM (SELECT *, unnest(range(0, n_copies)) AS copy FROM drawn)
"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_LINES = r"""
WITH shown AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script[^>]*>.*?</script>', '', 'g'),
           '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS t FROM pages),
lined AS (
  SELECT page_id, host, list_filter(list_transform(string_split(regexp_replace(regexp_replace(t,
    '(?i)</?(?:p|div|li|ul|ol|br|h[1-6]|tr|td|th|table|nav|article|section|header|footer|title|blockquote|pre|form|head|body|html)(?:[ \t\r\n/][^>]*)?>', chr(10), 'g'),
    '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS lines FROM shown),
totals AS (SELECT host, count(*) AS total FROM lined GROUP BY host),
often AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined) GROUP BY ALL),
boiler AS (
  SELECT host, list(line) AS boiler FROM often JOIN totals USING (host) WHERE n >= 3 AND n > 0.3 * total GROUP BY host),
met AS (SELECT page_id, host, lines, list_filter(lines, lambda x: boiler IS NULL OR NOT list_contains(boiler, x)) AS kept
        FROM lined LEFT JOIN boiler USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, coalesce(array_to_string(kept, chr(10)), '') AS kept_text FROM met
"""

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

ORACLE = {"op1_mix_sources": _MIX, "op4_exact_dedup": _EXACT, "op7_line_dedup": _LINES, "op9_near_dups": _NEAR}
