"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics come from vectorised passes over the UTF-8 bytes of whole texts.  Trees are grown on binned statistics
of a bounded sample of labelled rows and flattened into arrays; scoring walks all documents of a batch down every
tree at once with array indexing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .shared import without

#: Labelled rows that a classifier is fitted on at most.
SAMPLE = 16_000
BINS, TREES, DEPTH, RATE, LEAST, SMOOTH = 64, 120, 4, 0.1, 20, 5.0
FEATURES = (
    "bytes", "words", "lines", "word_length", "word_length_spread", "long_words", "short_words", "line_length", "line_length_spread",
    "upper", "digits", "spaces", "newlines", "commas", "stops", "marks", "symbols", "wide", "repeated_bytes", "word_variety", "pair_variety",
    "line_variety", "top_word", "top_line", "byte_entropy", "pipes", "capital_starts", "ended_lines", "digit_words", "symbol_words", "upper_words",
    "packed", "sentence_length", "letters_entropy", "longest_word",
)
_KIND = np.zeros(256, np.uint8)
UPPER, LOWER, DIGIT, BLANK, BREAK, COMMA, STOP, MARK, SYMBOL, WIDE = range(1, 11)
for _chars, _kind in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), (b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"0123456789", DIGIT), (b" \t\r\x0b\x0c", BLANK), (b"\n", BREAK), (b",;:", COMMA), (b".!?", STOP), (b"'\"()-", MARK)):
    _KIND[list(_chars)] = _kind
_KIND[128:] = WIDE
_KIND[_KIND == 0] = SYMBOL


def _variety(values: np.ndarray) -> tuple[float, float]:
    """Share of different values, and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    _, counts = np.unique(values, return_counts=True)
    return len(counts) / len(values), counts.max() / len(values)


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def statistics(raw: bytes | memoryview) -> list[float]:
    """Statistics of one text's bytes; an empty text has zeros."""
    x = np.frombuffer(raw, np.uint8)
    n = len(x)
    if not n:
        return [0.0] * len(FEATURES)
    kind = _KIND[x]
    share = np.bincount(kind, minlength=11) / n
    ws, we = _spans((kind != BLANK) & (kind != BREAK))
    ls, le = _spans(kind != BREAK)
    wl, ll = (we - ws), (le - ls)
    words, lines = max(1, len(ws)), max(1, len(ls))
    # 64-bit running sums of bytes times powers tell words and lines apart
    step = np.uint64(0x9E3779B97F4A7C15)
    keyed = np.zeros(n + 1, np.uint64)
    up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, step)]))
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up, out=keyed[1:])
    down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(pow(int(step), -1, 1 << 64)))]))
    wh = (keyed[we] - keyed[ws]) * down[ws] if len(ws) else np.zeros(0, np.uint64)
    lh = (keyed[le] - keyed[ls]) * down[ls] if len(ls) else np.zeros(0, np.uint64)
    word_variety, top_word = _variety(wh)
    line_variety, top_line = _variety(lh)
    pair_variety, _ = _variety(wh[1:] * np.uint64(3) + wh[:-1]) if len(wh) > 1 else (1.0, 1.0)
    freq = np.bincount(x, minlength=256)
    p = freq[freq > 0] / n
    low = freq[97:123] + freq[65:91]
    q = low[low > 0] / max(1, low.sum())
    first, last = kind[ws], kind[we - 1]
    of = lambda k: (np.add.reduceat(kind == k, ws) if len(ws) else np.zeros(0))
    digit_words, symbol_words, upper_words = (float(((c := of(k)) * 2 > wl[: len(c)]).mean()) if len(ws) else 0.0 for k in (DIGIT, SYMBOL, UPPER))
    stops = int((last == STOP).sum())
    return [
        np.log1p(n), np.log1p(len(ws)), np.log1p(len(ls)), wl.mean() if len(ws) else 0.0, wl.std() if len(ws) else 0.0,
        float((wl > 14).mean()) if len(ws) else 0.0, float((wl < 3).mean()) if len(ws) else 0.0, np.log1p(ll.mean()) if len(ls) else 0.0, np.log1p(ll.std()) if len(ls) else 0.0,
        share[UPPER], share[DIGIT], share[BLANK], share[BREAK], share[COMMA], share[STOP], share[MARK], share[SYMBOL], share[WIDE],
        float((x[1:] == x[:-1]).mean()) if n > 1 else 0.0, word_variety, pair_variety, line_variety, top_word, top_line, float(-(p * np.log2(p)).sum()),
        freq[124] / n, float((first == UPPER).mean()) if len(ws) else 0.0, float((kind[le - 1] == STOP).mean()) if len(ls) else 0.0, digit_words, symbol_words, upper_words,
        len(zlib.compress(raw, 1)) / n, min(200.0, words / max(1, stops)), float(-(q * np.log2(q)).sum()), np.log1p(wl.max(initial=0)),
    ]


def statistics_of(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text; null counts as empty."""
    out = np.empty((len(column), len(FEATURES)))
    for i, text in enumerate(column):
        out[i] = statistics(text.as_buffer() if text.is_valid else b"")
    return out


@dataclass
class Trees:
    """Flattened trees: node i of tree t tests ``feature``, goes to 2i + 1 or, over ``cut``, to 2i + 2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the log-odds of label 1; without both labels the score is the smoothed share of label 1."""
    inner = 2**DEPTH - 1
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if not len(y) or y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    offset = np.arange(x.shape[1]) * BINS
    margin = np.full(len(y), base)
    features, thresholds, values = [], [], []
    flat = binned + offset
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, cut, limit = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            cell = ((node - first)[:, None] * (BINS * x.shape[1]) + flat).ravel()
            size = width * BINS * x.shape[1]
            shape = (width, x.shape[1], BINS)
            hist = lambda w: np.bincount(cell, np.repeat(w, x.shape[1]), size).reshape(shape).cumsum(2)
            gl, hl, nl = hist(g), hist(h), hist(np.ones(len(y)))
            gt, ht, nt = (a[:, :, -1:] for a in (gl, hl, nl))
            gain = gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH) - gt**2 / (ht + SMOOTH)
            gain[(nl < LEAST) | (nt - nl < LEAST)] = -1
            best = gain.reshape(width, -1).argmax(1)
            for k, b in enumerate(best):
                f, at = divmod(int(b), BINS)
                if gain[k, f, at] > 1e-9 and at < len(cuts[f]):
                    feature[first + k], cut[first + k], limit[first + k] = f, cuts[f][at], at
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        value = RATE * gs / (hs + SMOOTH)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(cut)
        values.append(value)
    return Trees(np.stack(features), np.stack(thresholds), np.stack(values), base)


def held_out(id_col: str):
    """Whether crc32 of the id as text is a multiple of 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Trees:
    """Fit on ``sample`` labelled rows at most, the first by hash of the id, none of them held out.

    Rows that repeat an id are labelled by the larger label; null labels don't count.  The rows that are fitted on are
    the only ones that reach the driver, ``sample`` rows of statistics.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = usable.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    # at most ``sample`` pairs of numbers
    chosen = F.broadcast(chosen)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body")).join(chosen, "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics_of(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(found), pa.list_(pa.float64()))], names=["id", "label", "x"])

    # repeated ids can bring more rows than labels: still a bounded number of them
    got = rows.select(F.col("id").cast("string"), "label", "body").mapInArrow(measure, "id string, label int, x array<double>").limit(sample).collect()
    got.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["label"] for r in got], float))


def _scored(docs: DataFrame, trees: Trees, text_col: str, name: str) -> DataFrame:
    """``docs`` with a score under a name that it doesn't have."""
    at = [n.lower() for n in docs.columns].index(text_col.lower())

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = trees.score(statistics_of(batch.column(at).cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scored, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(rate, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, trees: Trees, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, score and predicted (1 where score >= threshold).

    Null and empty texts are scored from zero statistics.  Columns of these names in the input are replaced.
    """
    rated = _scored(without(docs, "held_out", "score", "predicted"), trees, text_col, "score")
    return rated.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def rate_documents(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, score and predicted, by a classifier fitted on ``labels``.

    Null and empty texts are scored from zero statistics, so alike; long texts are measured whole, at about 60 bytes of
    memory a byte of the longest.  Rows that repeat an id are scored each, by their own text; equal texts get equal
    scores.  Without usable labels, or with those of one kind, all scores are one number.  An empty table gives an
    empty result.  Input columns named held_out, score or predicted are replaced.
    """
    trees = train(docs, labels, label_col=label_col, id_col=id_col, text_col=text_col, sample=sample)
    return score(docs, trees, id_col=id_col, text_col=text_col, threshold=threshold)


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows that the classifier doesn't reject, with the columns of ``docs``, whatever their names; else as ``rate_documents``."""
    trees = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return _scored(docs, trees, text_col, "__rated").where(F.col("__rated") >= threshold).drop("__rated")
