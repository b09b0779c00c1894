"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned statistics and kept as complete binary trees in
flat arrays (feature, threshold, leaf value), so scoring walks all documents of a batch
one level at a time in numpy.

Fitting uses at most SAMPLE labelled rows (the smallest hashes of doc_id, so the sample
is the same on any layout); scoring covers every row and whole texts. Null or empty text
has statistics 0 and gets a score. Without labels of both kinds every score is the share
of good labels (0.5 without any). Repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm.common import prefix_hashes, prepare, remainder, substring_hashes, text_pieces, words

#: Most labelled rows the model is fitted on (a bound of the method, not of the data scored).
SAMPLE = 20_000
GOOD = 0.7

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_share", "repeat_share", "top_share",
    "upper", "digit", "punctuation", "symbol", "space", "high_bytes", "log_lines", "line_bytes", "repeated_lines",
    "symbol_words", "short_words", "long_words",
)

_CLASS = np.zeros(256, np.int64)  # 0: other lower-case
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_CLASS[[32, *range(9, 14)]] = 5
_CLASS[128:] = 6


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text laid end to end in ``raw``."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _CLASS[raw]
    row = np.repeat(np.arange(n), size)
    share = np.bincount(row * 7 + kind, minlength=7 * n).reshape(n, 7) / np.maximum(size, 1)[:, None]
    h, starts, ends, first = words(raw, offsets)
    count, length = np.diff(first), ends - starts
    word_row = np.repeat(np.arange(n), count)
    per = np.maximum(count, 1)
    by_row = lambda x: np.bincount(word_row, x, minlength=n)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, word_row, length)
    order = np.lexsort((h, word_row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (word_row[order][1:] != word_row[order][:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, word_row[order][at], np.diff(np.append(at, len(h))))
    marks = np.concatenate([[0], np.cumsum(kind == 4)])
    line = raw == 10
    lines = np.bincount(row, line, minlength=n) + (size > 0)
    repeated = np.zeros(n)
    cut = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(line) + 1, offsets[-1:]]))
    if len(cut) > 1:  # lines as sums of their bytes' positional values: equal lines, equal sums
        sums, inverse = prefix_hashes(raw)
        lh = substring_hashes(sums, inverse, cut[:-1], cut[1:])
        lr = np.searchsorted(offsets, cut[:-1], "right") - 1
        o = np.lexsort((lh, lr))
        dup = np.zeros(len(lh), bool)
        dup[1:] = (lh[o][1:] == lh[o][:-1]) & (lr[o][1:] == lr[o][:-1])
        repeated = np.bincount(lr[o], dup, minlength=n)[:n] / np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(count), by_row(length) / per, np.log1p(longest),
        np.bincount(word_row[order][at], minlength=n) / per, by_row(same) / per, top / per,
        *(share[:, k] for k in range(1, 7)), np.log1p(lines), np.log1p(size / np.maximum(lines, 1)), repeated,
        by_row(marks[ends] > marks[starts]) / per, by_row(length <= 3) / per, by_row(length >= 14) / per,
    ])


class BoostedTrees:
    """Gradient-boosted trees for log loss on binned features."""

    def __init__(self, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, leaf: float = 12, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.ridge = trees, depth, rate, bins, leaf, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        n, d = x.shape if x.size else (0, 1)
        share = float(y.mean()) if n else 0.5
        self.feature = np.zeros((0, 2**self.depth - 1), np.int64)
        self.threshold = np.zeros((0, 2**self.depth - 1))
        self.value = np.zeros((0, 2**self.depth))
        self.constant = share if not n or share in (0.0, 1.0) else None
        self.start = 0.0
        if self.constant is not None:
            return self
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(d)]
        binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
        flat = binned + np.arange(d) * self.bins
        f = np.full(n, self.start)
        grown = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            feature, threshold, node = [], [], np.zeros(n, np.int64)
            for level in range(self.depth):
                k, cells = 2**level, d * self.bins
                key = (node[:, None] * cells + flat).ravel()
                hist = [np.bincount(key, np.repeat(v, d), minlength=k * cells).reshape(k, d, self.bins).cumsum(2) for v in (g, h, np.ones(n))]
                gl, hl, cl = hist
                gt, ht, ct = (v[:, :, -1:] for v in hist)
                gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                gain = np.where((cl >= self.least) & (ct - cl >= self.least), gain, -1.0).reshape(k, cells)
                best = gain.argmax(1)
                good = gain[np.arange(k), best] > 1e-12
                j, b = best // self.bins, best % self.bins
                limit = np.array([edges[a][c] if ok and c < len(edges[a]) else np.inf for a, c, ok in zip(j, b, good)])
                feature.append(np.where(good, j, 0))
                threshold.append(limit)
                node = 2 * node + (x[np.arange(n), feature[-1][node]] > limit[node])
            gs, hs = (np.bincount(node, v, minlength=2**self.depth) for v in (g, h))
            value = -self.rate * gs / (hs + self.ridge)
            f += value[node]
            grown.append((np.concatenate(feature), np.concatenate(threshold), value))
        self.feature, self.threshold, self.value = (np.array(v) for v in zip(*grown))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows descend every flat tree one level at a time."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        f, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            f += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-f))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """Texts and labels of at most ``size`` training rows (crc32 remainder not 2)."""
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(size)
    )
    return docs.join(F.broadcast(picked), "doc_id")  # ``size`` rows of two numbers at most


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> BoostedTrees:
    """Fit on a bounded sample; executors turn its texts into statistics first."""
    d = len(STATISTICS)

    def run(batches):
        for batch in batches:
            x = np.zeros((len(batch), d))
            for k, raw, off in text_pieces(batch.column(1)):
                x[k : k + len(off) - 1] = statistics(raw, off)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "y": batch.column(2), "x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), d).cast(pa.list_(pa.float64()))})

    rows = (labelled_sample(docs, labels, "quality", size).select("doc_id", "text", "y")
            .mapInArrow(run, "doc_id long, y int, x array<double>").toPandas().sort_values(["doc_id", "y"], kind="stable"))
    return BoostedTrees().fit(np.array(rows["x"].tolist()), rows["y"].to_numpy(float))


def score_frame(docs: DataFrame, model: BoostedTrees) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = np.zeros(len(batch))
            for k, raw, off in text_pieces(batch.column(1)):
                score[k : k + len(off) - 1] = shared.value.score(statistics(raw, off))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(2), "score": pa.array(score)})

    split = docs.select("doc_id", "text", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    return split.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int"))


def keep_good(docs: DataFrame, model: BoostedTrees, least: float = GOOD) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores ``least`` or more."""
    prepare(docs.sparkSession)
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for k, raw, off in text_pieces(batch.column(at)):
                keep[k : k + len(off) - 1] = shared.value.score(statistics(raw, off)) >= least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
