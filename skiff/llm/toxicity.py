"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5 bytes, with word boundaries), so an
unseen misspelling shares the vectors of the n-grams it kept. Word vectors are the means
of their n-gram vectors, a passage of PASSAGE words the mean of its word vectors, and a
softmax over two labels reads the passage; vectors and softmax are trained jointly. A text
is as toxic as its most toxic passage, so a few words are not lost in a long text, and
every passage of the whole text is read.

Because mean and softmax are linear up to the last step, a word contributes one number
(the difference of the two logits), which is what scoring looks up for each n-gram.

Fitting uses at most SAMPLE labelled rows (smallest hashes of doc_id). Null or empty text
scores as a passage without words. Without labels of both kinds every score is the share
of toxic labels (0 without any). Repeated rows give repeated results.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm.common import _LOWER, mix64, remainder, text_pieces, words
from skiff.llm.quality import labelled_sample

#: Most labelled rows the model is fitted on (a bound of the method, not of the data scored).
SAMPLE = 16_000
TOXIC = 0.3
PASSAGE = 8
BUCKETS, DIMENSION = 1 << 16, 4
SIZES = (3, 4, 5)


def word_grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-gram buckets of each word, end to end, and the first one's number of each word."""
    size = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(starts)), size)
    inside = np.arange(first[-1]) - first[owner]
    text = np.full(first[-1], 2, np.uint64)  # 2: either end of a word
    middle = (inside > 0) & (inside < size[owner] - 1)
    text[middle] = raw[starts[owner[middle]] + inside[middle] - 1]
    left = size[owner] - inside
    grams, owners = [], []
    for n in SIZES:
        at = np.flatnonzero((left >= n) | ((n == SIZES[0]) & (inside == 0)))
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + text[np.minimum(at + k, len(text) - 1)]
        grams.append((mix64(h) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    gram, own = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return gram[order], np.searchsorted(own[order], np.arange(len(starts) + 1))


def _means(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Means of consecutive, non-empty groups of rows."""
    return np.add.reduceat(x, first[:-1], axis=0) / np.diff(first).reshape(-1, *[1] * (x.ndim - 1))


class SubwordSoftmax:
    def __init__(self, steps: int = 800, batch: int = 250, rate: float = 0.03, seed: int = 7):
        self.steps, self.batch, self.rate, self.seed = steps, batch, rate, seed

    def fit(self, grams, gram_first, word_of, doc_first, y) -> "SubwordSoftmax":
        """grams/gram_first: n-grams of distinct words; word_of: the distinct word of each
        token of the documents laid end to end; doc_first: each document's first token."""
        self.constant, self.word = None, np.zeros(BUCKETS)
        self.bias = 0.0
        n = np.diff(doc_first)
        share = float(y.mean()) if len(y) else 0.0
        if share in (0.0, 1.0) or not n.sum():
            self.constant = share
            return self
        rng = np.random.default_rng(self.seed)
        keep = np.flatnonzero(n > 0)
        y, starts, n = y[keep].astype(int), doc_first[:-1][keep], n[keep]
        passages = -(-n // PASSAGE)
        vec = rng.normal(0, 0.3, (BUCKETS, DIMENSION))
        out, bias = rng.normal(0, 0.3, (DIMENSION, 2)), np.array([np.log(1 - share), np.log(share)])
        moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (vec, out, bias)]
        step, parts = 0, max(1, len(y) // self.batch)
        epochs = max(4, -(-self.steps // parts))
        for epoch in range(epochs):
            if epoch < epochs // 4:
                picks = rng.integers(0, passages)
            else:  # each document's most toxic passage as the model now sees it
                picks = _passage_means(self._word_logits(vec @ out, grams, gram_first)[word_of], starts, n)[0]
            order = rng.permutation(len(y))
            for docs in np.array_split(order, parts):
                a = starts[docs] + picks[docs] * PASSAGE
                size = np.minimum(PASSAGE, starts[docs] + n[docs] - a)
                first = np.concatenate([[0], np.cumsum(size)])
                token = np.repeat(a - first[:-1], size) + np.arange(first[-1])
                used, at = np.unique(word_of[token], return_inverse=True)
                counts = gram_first[used + 1] - gram_first[used]
                gfirst = np.concatenate([[0], np.cumsum(counts)])
                g = grams[np.repeat(gram_first[used] - gfirst[:-1], counts) + np.arange(gfirst[-1])]
                h = _means(_means(vec[g], gfirst)[at], first)
                z = h @ out + bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(docs)), y[docs]] -= 1
                p /= len(docs)
                dh = np.repeat((p @ out.T) / size[:, None], size, axis=0)
                dword = np.column_stack([np.bincount(at, dh[:, k], minlength=len(used)) for k in range(DIMENSION)]) / counts[:, None]
                dgram = np.repeat(dword, counts, axis=0)
                dvec = np.column_stack([np.bincount(g, dgram[:, k], minlength=BUCKETS) for k in range(DIMENSION)])
                step += 1
                for value, grad, (m, v) in zip((vec, out, bias), (dvec, h.T @ p, p.sum(0)), moments):
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad**2 - v)
                    value -= self.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.word = (vec @ out) @ np.array([-1.0, 1.0])
        self.bias = float(bias[1] - bias[0])
        return self

    @staticmethod
    def _word_logits(logits, grams, gram_first):
        return _means((logits @ np.array([-1.0, 1.0]))[grams], gram_first)

    def score_texts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each text laid end to end in ``raw``."""
        n = len(offsets) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        h, starts, ends, first = words(raw, offsets)
        z = np.full(n, self.bias)
        if len(h):
            _, one, at = np.unique(h, return_index=True, return_inverse=True)
            grams, gfirst = word_grams(_LOWER[raw], starts[one], ends[one])
            s = _means(self.word[grams], gfirst)[at]
            count = np.diff(first)
            has = np.flatnonzero(count)
            z[has] += _passage_means(s, first[:-1][has], count[has])[1]
        return 1 / (1 + np.exp(-z))


def _passage_means(s: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and mean of the passage with the largest mean of each non-empty document."""
    per = -(-n // PASSAGE)
    first = np.concatenate([[0], np.cumsum(per)])
    number = np.arange(first[-1]) - np.repeat(first[:-1], per)
    a = np.repeat(starts, per) + number * PASSAGE
    size = np.minimum(PASSAGE, np.repeat(starts + n, per) - a)
    sums = np.concatenate([[0.0], np.cumsum(s)])
    # a mean over PASSAGE words, so that a short rest is not read louder than it is
    mean = (sums[a + size] - sums[a]) / np.maximum(size, np.minimum(PASSAGE, np.repeat(n, per)))
    best = np.maximum.reduceat(mean, first[:-1])
    hit = np.flatnonzero(mean == np.repeat(best, per))
    owner = np.repeat(np.arange(len(n)), per)[hit]
    _, one = np.unique(owner, return_index=True)
    return number[hit[one]], best


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> SubwordSoftmax:
    """Fit on a bounded sample of labelled rows, in one task: the driver gets the model only."""

    def train(table):
        table = table.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("text", "ascending")])
        return pa.table({"model": pa.array([pickle.dumps(fit_texts(table["text"], table["y"].to_numpy()))], pa.binary())})

    sample = labelled_sample(docs, labels, "toxic", size).select("doc_id", "text", "y")
    got = sample.groupBy(F.lit(0).alias("all")).applyInArrow(train, "model binary").collect()
    return pickle.loads(got[0].model) if got else fit_texts(pa.array([], pa.string()), np.zeros(0, np.int64))


def fit_texts(texts: pa.Array, y: np.ndarray) -> SubwordSoftmax:
    known: dict[int, int] = {}
    grams, gram_first, tokens, counts = [np.zeros(0, np.int32)], [0], [np.zeros(0, np.int32)], []
    for _, raw, off in text_pieces(texts):
        h, starts, ends, first = words(raw, off)
        value, one, at = np.unique(h, return_index=True, return_inverse=True)
        ids = np.array([known.setdefault(v, len(known)) for v in value.tolist()], np.int64)
        new = np.flatnonzero(ids >= len(gram_first) - 1)
        if len(new):
            g, gf = word_grams(_LOWER[raw], starts[one[new]], ends[one[new]])
            gram_first += (gf[1:] + gram_first[-1]).tolist()
            grams.append(g.astype(np.int32))
        tokens.append(ids[at].astype(np.int32))
        counts.append(np.diff(first))
    doc_first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return SubwordSoftmax().fit(np.concatenate(grams), np.array(gram_first), np.concatenate(tokens), doc_first, np.asarray(y))


def score_frame(docs: DataFrame, model: SubwordSoftmax) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = np.zeros(len(batch))
            for k, raw, off in text_pieces(batch.column(1)):
                score[k : k + len(off) - 1] = shared.value.score_texts(raw, off)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(2), "score": pa.array(score)})

    split = docs.select("doc_id", "text", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    return split.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= TOXIC).cast("int"))
