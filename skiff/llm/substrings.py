"""Exact substring dedup with suffix arrays from external induced sorting.

A byte is removed if a string of LENGTH bytes that covers it also starts in a document with a
smaller doc_id. Steps, over blocks of whole documents:

1. Every LENGTH-byte window elects an anchor, the GRAM-byte string in it with the smallest
   hash (leftmost on ties), so equal windows elect equal anchors. ``shared_keys`` finds the
   anchors of two documents or more; a window of another anchor cannot occur elsewhere.
2. Windows with the same shared anchor form a segment of at most 2 LENGTH - GRAM bytes. A block sends each
   distinct segment once, with the smallest doc_id that has it (so a passage in a third of
   all rows is one entry a block), to the shard of its anchor's key range.
3. A shard sorts the suffixes of its distinct segments by external induced sorting; suffixes
   with common prefixes of LENGTH or more are equal windows, whose smallest doc_id is the
   answer for all of them. The answers go back to the blocks in runs.
4. A block marks the windows of its documents whose answer is smaller than their doc_id.

Strings are judged on the input; matches never cross documents. Null reads as empty; texts
under LENGTH bytes keep all bytes. Equal rows of one doc_id are not smaller than each
other and stay; rows without an id count as larger than all ids. Every row gives a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skiff.llm.blocks import block_table, block_texts, is_shared, ranges, run_folder, shared_keys, short, written
from skiff.llm.common import mix64, prefix_hashes, substring_hashes
from skiff.llm.induced import suffix_array

LENGTH, GRAM = 50, 20
_PIECE = 1 << 16


def segments(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: (anchor's hash, text, first window, last window, hash of
    the bytes from the first window's start to the last one's end)."""
    parts, width = [], length - gram + 1
    k = 0
    while k < len(offsets) - 1:
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + _PIECE, "right")) - 1)
        base, off = offsets[k], offsets[k : end + 1] - offsets[k]
        piece = raw[base : offsets[end]]
        n = len(piece) - length + 1
        if n > 0:
            sums, inverse = prefix_hashes(piece)
            at = np.arange(len(piece) - gram + 1, dtype=np.uint64)
            least = (mix64((sums[gram:] - sums[:-gram]) * inverse[: len(at)]) & ~np.uint64(0xFFFFFFFF)) | at
            span = 1
            while span < width:  # sliding minimum by doubling; the position in the low bits breaks ties
                step = min(span, width - span)
                least = np.minimum(least[: len(least) - step], least[step:])
                span += step
            row = np.repeat(np.arange(end - k), np.diff(off))
            window = np.flatnonzero(row[:n] == row[length - 1 : length - 1 + n])
            if len(window):
                anchor = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]))
                lo, hi = window[cut], window[np.concatenate([cut[1:] - 1, [len(window) - 1]])]
                a = anchor[cut]
                # hashed once more: the smallest hashes would crowd the first key ranges
                parts.append((mix64(substring_hashes(sums, inverse, a, a + gram)), row[lo] + k, lo + base, hi + base,
                              substring_hashes(sums, inverse, lo, hi + length)))
        k = end
    if not parts:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of ranges laid end to end."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


def _shared_segments(ids, raw, off, bits, buckets, flags):
    """The block's segments with shared anchors, and its distinct ones in sending order."""
    key, row, lo, hi, content = segments(raw, off)
    hit = is_shared(key, bits, buckets, flags)
    key, row, lo, hi, content = (x[hit] for x in (key, row, lo, hi, content))
    order = np.lexsort((row, content, short(key, bits)))
    key, row, lo, hi, content = (x[order] for x in (key, row, lo, hi, content))
    cut = short(key, bits)
    new = np.concatenate([[True], (content[1:] != content[:-1]) | (cut[1:] != cut[:-1])]) if len(key) else np.zeros(0, bool)
    return cut, row, lo, hi, np.flatnonzero(new), np.cumsum(new) - 1


def _windows_of(data: np.ndarray, sizes: np.ndarray, least: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of the segments laid end to end, the smallest ``least`` over all segments that
    have an equal window."""
    sums, inverse = prefix_hashes(data)
    starts = np.cumsum(sizes) - sizes
    content = substring_hashes(sums, inverse, starts, starts + sizes)
    _, one, at = np.unique(content, return_index=True, return_inverse=True)
    low = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(low, at, least)
    size = sizes[one]
    first = np.cumsum(size + 1) - (size + 1)
    text = np.zeros(int((size + 1).sum()), np.uint8)
    text[_gather(first, size)] = data[_gather(starts[one], size)] + np.uint8(1)  # UTF-8 has no byte 255
    sa, lcp = suffix_array(text)
    group = np.cumsum(lcp < length)
    owner = np.repeat(np.arange(len(size)), size + 1)[sa]
    answer = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(answer, group, low[owner])
    by_place = np.empty(len(text), np.int64)
    by_place[sa] = answer[group]
    return by_place[_gather(first[at], sizes - length + 1)]


def repeated(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256."""
    folder = run_folder(docs, "substrings")
    table, bits = block_table(docs, folder)

    def anchors(raw, off):
        key, row, *_ = segments(raw, off)
        return key, row

    flags = written(shared_keys(table, anchors, bits), folder, "flags")

    def send(block, left, right):
        out = []
        if left.num_rows:
            ids, raw, off = block_texts(left)
            cut, row, lo, hi, one, at = _shared_segments(ids, raw, off, bits, right["bucket"].to_pylist(), right["flags"].to_pylist())
            if len(one):
                least = np.full(len(one), np.iinfo(np.int64).max)
                np.minimum.at(least, at, ids[row])
                sizes = hi[one] - lo[one] + LENGTH
                for b, a, e in ranges(cut[one], bits):
                    out.append((b, raw[_gather(lo[one[a:e]], sizes[a:e])].tobytes(), sizes[a:e].astype(np.uint8).tobytes(), least[a:e].tobytes()))
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int64()), "block": pa.array([block[0].as_py()] * len(out), pa.int64()),
                         **{c: pa.array([x[k] for x in out], pa.binary()) for k, c in ((1, "bytes"), (2, "sizes"), (3, "least"))}})

    def sort(bucket, group):
        sizes = [np.frombuffer(x, np.uint8).astype(np.int64) for x in group["sizes"].to_pylist()]
        data = np.frombuffer(b"".join(group["bytes"].to_pylist()), np.uint8)
        answer = _windows_of(data, np.concatenate(sizes), np.frombuffer(b"".join(group["least"].to_pylist()), np.int64))
        value, runs, at = [], [], 0
        for s in sizes:
            n = int((s - LENGTH + 1).sum())
            x = answer[at : at + n]
            first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            value.append(x[first].tobytes())
            runs.append(np.diff(np.append(first, n)).astype(np.uint32).tobytes())
            at += n
        return pa.table({"block": group["block"].combine_chunks(), "bucket": pa.array([bucket[0].as_py()] * len(sizes), pa.int64()),
                         "value": pa.array(value, pa.binary()), "runs": pa.array(runs, pa.binary())})

    def remove(block, left, right):
        if not left.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                             "n_spans": pa.array([], pa.int64()), "kept_sha256": pa.array([], pa.string())})
        ids, raw, off = block_texts(left)
        rows = list(zip(*(right[c].to_pylist() for c in ("bucket", "flags", "value", "runs"))))
        shared = [r for r in rows if r[1] is not None]
        answers = sorted((r for r in rows if r[1] is None), key=lambda r: r[0])
        cut, row, lo, hi, one, at = _shared_segments(ids, raw, off, bits, [r[0] for r in shared], [r[1] for r in shared])
        covered = np.zeros(len(raw) + 1, np.int64)
        if len(one):
            value = np.concatenate([np.repeat(np.frombuffer(r[2], np.int64), np.frombuffer(r[3], np.uint32)) for r in answers])
            count = hi - lo + 1
            first = np.cumsum(count[one]) - count[one]
            start = _gather(lo, count)
            hit = value[_gather(first[at], count)] < np.repeat(ids[row], count)
            np.add.at(covered, start[hit], 1)
            np.add.at(covered, start[hit] + LENGTH, -1)
        gone = np.cumsum(covered)[:-1] > 0
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        heads = off[:-1][np.diff(off) > 0]
        edge[heads] = gone[heads]
        sums, edges = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(edge)])
        kept = raw[~gone].tobytes()
        ends = off - sums[off]
        return pa.table({
            "doc_id": pa.array([None if i == (1 << 63) - 1 else i for i in ids.tolist()], pa.int64()), "n_bytes": pa.array(np.diff(off)),
            "n_removed": pa.array(np.diff(sums[off])), "n_spans": pa.array(np.diff(edges[off])),
            "kept_sha256": pa.array([hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])})

    sent = (table.groupBy("block").cogroup(flags.groupBy("block"))
            .applyInArrow(send, "bucket long, block long, bytes binary, sizes binary, least binary"))
    answers = written(sent.groupBy("bucket").applyInArrow(sort, "block long, bucket long, value binary, runs binary"), folder, "answers")
    both = flags.selectExpr("block", "bucket", "flags", "cast(null as binary) value", "cast(null as binary) runs").unionByName(
        answers.selectExpr("block", "bucket", "cast(null as binary) flags", "value", "runs"))
    return table.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
