"""Cross-tokenizer alignment by coalescing the byte intervals of two tokenizations.

All A and B tokens of a piece of texts are sorted by start (lexsort); a running maximum of their
ends tells where a start reaches everything before it: there a group ends. Inside a group the
tokens overlap, and every A token is linked to every B token.

How many documents hold an id pair linked: each block of texts sends every distinct pair once with
its number of documents, Spark adds them up, and each block gets the totals of its own pairs back,
with a mark where the total is the highest of the pair's A id. So no key has more entries than there
are blocks. Blocks are written to the shared folder once; the counts are read from there.

Handled: null and empty texts, and texts whose tokens' bytes are not a space and the text (such as
those holding U+2581), have no tokens: zeros, and '' for groups_sha256. Each row is a document, so
repeated rows and ids count as often as they occur, and a missing id stays missing. Strings of
special tokens are plain text. Other columns are not read, an empty table stays empty, and a
group of many repeated tokens is expanded by its distinct ids.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm import bpe, piece_bpe
from skiff.llm.blocks import planes, run_folder, unplanes, written
from skiff.llm.common import give_back

#: Bytes of text aligned at once, and of a block (a longer text is a block of its own).
PIECE_BYTES, BLOCK_BYTES = 1 << 20, 6 << 20
#: Links of a group beyond which distinct ids are counted instead of token pairs.
MANY_LINKS = 1 << 12


class Aligner:
    """Two tokenizers, the byte length and the decimal digits of each id."""

    def __init__(self, a_content: str, b_content: bytes):
        self.a, self.b = bpe.BpeTokenizer(a_content), piece_bpe.PieceTokenizer(b_content)
        self.a.split = None  # strings of special tokens are plain text
        self.sizes = [np.array(list(map(len, t)), np.int64) for t in (self.a.pieces, self.b.surface)]
        self.n_b = len(self.b.surface)
        self.width = len(str(max(len(self.a.pieces), self.n_b)))
        ids = np.arange(max(len(self.a.pieces), self.n_b))
        self.digits = (ids[:, None] // 10 ** np.arange(self.width - 1, -1, -1) % 10 + 48).astype(np.uint8)
        self.leading = np.arange(self.width) < (self.width - np.char.str_len(ids.astype(str)))[:, None]

    def tokens(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides for each text; none where their bytes are not a space and the text.
        Both tokenizers keep every byte, but B reads U+2581 as a space."""
        texts = ["" if piece_bpe.SPACE in t else t for t in texts]
        a = self.a.encode_batch([" " + t if t else "" for t in texts])
        b = self.b.encode_batch(texts)
        return [np.frombuffer(x, "<u4") for x in a], [np.frombuffer(x, "<u4") for x in b]

    def forget(self) -> None:
        """Give the memory of remembered words back to the machine."""
        for memory in (self.a.known, self.b.known, self.b.words):
            memory.clear()
        give_back()

    def align(self, texts: list[str]) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
        """Counts and digests of each text, and (text, pair, links) of all distinct linked pairs,
        where pair is A id times the size of B's vocabulary plus B id."""
        a_of, b_of = self.tokens(texts)
        counts = [np.array(list(map(len, x)), np.int64) for x in (a_of, b_of)]
        a, b = (np.concatenate(x).astype(np.int64) for x in (a_of, b_of))
        text_a = np.repeat(np.arange(len(texts)), counts[0])
        a_end, b_end = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        start = np.concatenate([a_end - self.sizes[0][a], b_end - self.sizes[1][b]])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, start))
        reach = np.maximum.accumulate(np.concatenate([a_end, b_end])[order])
        begins = np.ones(len(order), bool)
        begins[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(begins) - 1
        n_groups = int(begins.sum())
        n_in = [np.bincount(g, minlength=n_groups) for g in (group[: len(a)], group[len(a) :])]
        first = [np.concatenate([[0], np.cumsum(n)[:-1]]) for n in n_in] if n_groups else [np.zeros(0, np.int64)] * 2
        text_of = text_a[first[0]] if n_groups else np.zeros(0, np.int64)
        links = n_in[0] * n_in[1]
        out = {
            "n_a": counts[0], "n_b": counts[1],
            "n_groups": np.bincount(text_of, minlength=len(texts)),
            "n_links": self._per_text(text_of, links, len(texts)),
            "groups_sha256": self._digests(a, b, group, n_in, first, text_of, len(texts)),
        }
        return out, *self._pairs(a, b, n_in, first, links, text_of)

    @staticmethod
    def _per_text(text_of, values, n):
        total = np.concatenate([[0], np.cumsum(values)])
        return total[np.searchsorted(text_of, np.arange(n), "right")] - total[np.searchsorted(text_of, np.arange(n), "left")]

    def _pairs(self, a, b, n_in, first, links, text_of):
        plain = np.flatnonzero(links <= MANY_LINKS)
        of = np.repeat(plain, links[plain])
        k = np.arange(len(of)) - np.repeat(np.cumsum(links[plain]) - links[plain], links[plain])
        keys = [a[first[0][of] + k // n_in[1][of]] * self.n_b + b[first[1][of] + k % n_in[1][of]]]
        texts, times = [text_of[of]], [np.ones(len(of), np.int64)]
        for g in np.flatnonzero(links > MANY_LINKS):
            (ids_a, many_a), (ids_b, many_b) = (np.unique(x[f[g] : f[g] + n[g]], return_counts=True) for x, f, n in zip((a, b), first, n_in))
            keys.append((ids_a[:, None] * self.n_b + ids_b).ravel())
            times.append((many_a[:, None] * many_b).ravel())
            texts.append(np.full(len(keys[-1]), text_of[g]))
        keys, texts, times = map(np.concatenate, (keys, texts, times))
        space = len(self.a.pieces) * self.n_b
        code = texts * space + keys
        order = np.argsort(code, kind="stable")
        code = code[order]
        cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        return code[cut] // space, code[cut] % space, np.add.reduceat(times[order], cut) if len(cut) else times

    def _digests(self, a, b, group, n_in, first, text_of, n_texts):
        """sha256 of each text's groups written as a1,a2|b1;a3|b2,b3."""
        n = len(a) + len(b)
        if not n:
            return [""] * n_texts
        base = np.cumsum(n_in[0] + n_in[1]) - n_in[0] - n_in[1]
        ga, gb = group[: len(a)], group[len(a) :]
        at_a = base[ga] + np.arange(len(a)) - first[0][ga]
        at_b = base[gb] + n_in[0][gb] + np.arange(len(b)) - first[1][gb]
        chars, keep = np.empty((n, self.width + 1), np.uint8), np.ones((n, self.width + 1), bool)
        for at, ids in ((at_a, a), (at_b, b)):
            chars[at, :-1], keep[at, :-1] = self.digits[ids], ~self.leading[ids]
        chars[:, -1] = ord(",")
        chars[base + n_in[0] - 1, -1] = ord("|")
        ends = base + n_in[0] + n_in[1] - 1
        chars[ends, -1] = ord(";")
        last = np.flatnonzero(np.concatenate([text_of[1:] != text_of[:-1], [True]]))
        keep[ends[last], -1] = False
        written_to = np.cumsum(keep.sum(1))
        data = chars[keep].tobytes()
        out, begin = [""] * n_texts, 0
        for t, end in zip(text_of[last].tolist(), written_to[ends[last]].tolist()):
            out[t] = hashlib.sha256(data[begin:end]).hexdigest()
            begin = end
        return out


@lru_cache(maxsize=1)
def _aligner(a_content: str, b_content: bytes) -> Aligner:
    return Aligner(a_content, b_content)


_PER_TEXT = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = ("block long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in _PER_TEXT)
          + ", groups_sha256 array<string>, n_pairs array<long>, at binary, links binary, pair array<long>, docs array<long>")
_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _pieces(batches):
    """(doc ids, texts) of at most PIECE_BYTES of characters, or of one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            t = t or ""
            if texts and size + len(t) > PIECE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts


def _block_row(block: int, parts: list) -> pa.RecordBatch:
    """One block: columns of its documents, its distinct pairs with their documents, and per
    document the places of its pairs among them with the number of links."""
    rows = [len(p[0]) for p in parts]
    text = np.concatenate([p[2] + sum(rows[:k]) for k, p in enumerate(parts)])
    pair, times = (np.concatenate([p[c] for p in parts]) for c in (3, 4))
    known, at, docs = np.unique(pair, return_inverse=True, return_counts=True)
    cols = {"block": [block], "doc_id": pa.array([[i for p in parts for i in p[0]]], pa.list_(pa.int64()))}
    for c in _PER_TEXT:
        cols[c] = [np.concatenate([p[1][c] for p in parts]).tolist()]
    cols["groups_sha256"] = pa.array([[s for p in parts for s in p[1]["groups_sha256"]]], pa.list_(pa.string()))
    cols["n_pairs"] = [np.bincount(text, minlength=sum(rows)).tolist()]
    for c, x in (("at", at), ("links", times)):
        cols[c] = pa.array([planes(x, max(1, -(-int(x.max(initial=0)).bit_length() // 8)))], pa.binary())
    for c, x in (("pair", known), ("docs", docs)):
        cols[c] = pa.array([x], pa.list_(pa.int64()))
    return pa.RecordBatch.from_pydict(cols)


def blocks(docs: DataFrame, a_content: str, b_content: bytes) -> DataFrame:
    """Aligned texts in blocks; a task forms its own, so nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((a_content, b_content))

    def run(batches):
        from pyspark import TaskContext

        aligner, block, size, parts = _aligner(*shared.value), TaskContext.get().partitionId() << 32, 0, []
        for ids, texts in _pieces(batches):
            parts.append((ids, *aligner.align(texts)))
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield _block_row(block, parts)
                block, size, parts = block + 1, 0, []
        if parts:
            yield _block_row(block, parts)
        parts.clear()
        aligner.forget()  # the worker waits for its next task while the counts are added up

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _BLOCK)


def _finish(block: pa.Table, totals: pa.Table) -> pa.Table:
    """Documents of a block, from its own row and the totals of its pairs."""
    if not block.num_rows:
        return pa.table({n.split()[0]: [] for n in _ROWS.split(", ")})
    row = block.to_pylist()[0]
    order = np.argsort(totals["pair"].to_numpy())
    n, top = totals["n"].to_numpy()[order], totals["top"].to_numpy()[order]
    ends = np.cumsum(row["n_pairs"]).astype(np.int64)
    at, links = (unplanes(row[c], max(1, len(row[c]) // max(1, ends[-1]))).astype(np.int64) for c in ("at", "links"))
    sums = [np.concatenate([[0], np.cumsum(links * v[at])]) for v in (n, top.astype(np.int64))]
    total, best = (s[ends] - s[ends - row["n_pairs"]] for s in sums)
    cols = {"doc_id": pa.array(row["doc_id"], pa.int64())} | {c: pa.array(row[c], pa.int64()) for c in _PER_TEXT}
    return pa.table(cols | {"n_best": best, "count_sum": total, "groups_sha256": pa.array(row["groups_sha256"], pa.string())})


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, top): documents that hold the pair, and whether no other pair of its A id has more."""
    n = (aligned.select(F.explode(F.arrays_zip("pair", "docs")).alias("p")).groupBy(F.col("p.pair").alias("pair"))
         .agg(F.sum("p.docs").alias("n")).withColumn("a", F.expr(f"pair div {n_b}")))
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    # one row an A id: no larger than the vocabulary, whatever the number of documents
    return n.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("top"))


def align(docs: DataFrame, a_content: str, b_content: bytes) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens of both sides, groups and links, the links whose
    pair is its A id's most frequent one, the sum of the links' document counts, and the digest
    of the groups. ``a_content``: a tokenizer file (bpe.load), ``b_content``: a model file
    (piece_bpe.load)."""
    n_b = len(piece_bpe.tokenizer(b_content).surface)
    folder = run_folder(docs, "align")
    aligned = written(blocks(docs, a_content, b_content), folder, "blocks")
    counts = written(pair_counts(aligned, n_b), folder, "pairs")
    sent = docs.sparkSession.read.parquet(f"{folder}/blocks").select("block", F.explode("pair").alias("pair"))
    totals = sent.join(counts.hint("merge"), "pair").select("block", "pair", "n", "top")
    rows = aligned.drop("pair", "docs").groupBy("block")
    return rows.cogroup(totals.groupBy("block")).applyInArrow(_finish, _ROWS)
