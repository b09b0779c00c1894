"""Language-model scoring with a hierarchical Pitman-Yor bigram model.

Every word seen in training (MIN_CONTEXT times) opens a restaurant for the words that follow
it; all restaurants share one parent over the vocabulary, whose base is uniform over V + 1
words (one for unseen ones). Customers are training tokens, or, in the parent, the tables
of its restaurants. Seating is sampled by Gibbs sweeps: all
customers of a dish are seated anew, one by one, given the tables of the other dishes of
their restaurant (those of the last sweep); of each sweep's seating the parent's probability
follows, and the predictive probabilities of SAMPLES sweeps are averaged.

The work is dealt out over blocks of whole documents, ranges of words and shards of
restaurants. A block sends each distinct word and each distinct pair once, with its
training count, and gets the statistics back in the same order; counts, tables and
customers cover all training documents and nothing global is collected but sums. A restaurant with
many customers (SPLIT) is split over shards by the following word; a shard then takes its share of the
tables, times the number of shards, for the whole.

Words: runs without space, tab and line ends, A-Z lower-cased, identified by 64-bit hashes;
each text closes with one end token, which is also the context of its first word. Null reads
as empty (one end token). Every row gives a row; rows without an id count as training rows.
With no training rows all counts are 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm.blocks import block_table, block_texts, bucketed, drop_tables, planes, release, run_folder, unplanes, written
from skiff.llm.common import PIECE_BYTES, give_back, mix64, uniform, words

END = np.uint64(0x5EED0FE0D0C5A11E)
MIN_CONTEXT, SPLIT = 1, 400_000
DISCOUNT, STRENGTH = 0.75, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.5, 1.0
SWEEPS, SAMPLES = 4, 2
#: Text of a block: the larger, the fewer words and pairs are sent twice; some 20 bytes of arrays a byte.
BLOCK_BYTES = 12 << 20
HELD_OUT = 1


def seat(customers: np.ndarray, base: np.ndarray, tables: np.ndarray, seed: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Tables of each dish after all its customers are seated anew: the next customer opens a
    table with weight (strength + discount x tables) x base, else joins one with weight (seated -
    discount x own tables). ``tables``: those of the restaurant without this dish. From the
    65th customer on a few are seated at once, an eighth of those seated at most."""
    own = (customers > 0).astype(np.float64)
    live, seated, step = np.flatnonzero(customers > 1), 1.0, 0
    while len(live):
        chunk = 1.0 if seated < 64 else np.floor(seated / 8)
        take = np.minimum(chunk, customers[live] - seated)
        new = (strength + discount * (tables[live] + own[live])) * base[live]
        p = new / (new + seated - discount * own[live])
        u = uniform(mix64(seed[live] + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64))))
        if chunk == 1.0:
            own[live] += u < p
        else:  # as many new tables as expected, the fraction by chance
            own[live] += np.minimum(np.floor(take * p + u), take)
        seated += chunk
        live, step = live[customers[live] > seated], step + 1
    return own


def _block(table: pa.Table):
    """(ids, token's word number, distinct words sorted, first token of each text): words and ends."""
    ids, raw, off = block_texts(table)
    hashes, bounds, k, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0, len(ids)
    while k < n:  # a few texts at a time: hashing takes many bytes a byte
        end = max(k + 1, int(np.searchsorted(off, off[k] + PIECE_BYTES, "right")) - 1)
        h, _, _, first = words(raw[off[k] : off[end]], off[k : end + 1] - off[k])
        hashes.append(h)
        bounds.append(first[1:] + bounds[-1][-1])
        k = end
    h, first = np.concatenate(hashes), np.concatenate(bounds)
    place = np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))
    tokens = np.full(len(h) + n, END, np.uint64)
    tokens[place] = h
    del h, place, hashes
    known, at = np.unique(tokens, return_inverse=True)
    return ids, at.astype(np.int32), known, first + np.arange(n + 1)


def _cuts(of: np.ndarray):
    cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    for a, b in zip(cut, [*cut[1:], len(of)]):
        yield int(of[a]), int(a), int(b)


def _top(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _width(bits: int) -> int:
    """Bytes that tell words apart inside a model whose ranges have ``bits`` bits."""
    return min(8, -(-(32 + bits) // 8))


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - 8 * _width(bits))


def _float_planes(x: np.ndarray) -> bytes:
    """Single-precision numbers, all lowest bytes first: most masses are alike, so most bytes repeat."""
    return np.ascontiguousarray(x.astype("<f4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _held(ids: np.ndarray) -> np.ndarray:
    none = (1 << 63) - 1
    return np.array([i != none and zlib.crc32(str(i).encode()) % 5 == HELD_OUT for i in ids.tolist()], bool)


def _rows(out, schema) -> pa.Table:
    return pa.table({name: pa.array([x[k] for x in out], kind) for k, (name, kind) in enumerate(schema)})


def _pairs(at, known, first, count, bits, limit):
    """The block's pairs (context, word) with a restaurant: their shard, context, word, and the
    pair of each token (-1 without a restaurant), pairs in sending order."""
    end = int(np.searchsorted(known, END))
    context = np.empty(len(at), np.int32)
    context[1:] = at[:-1]
    context[first[:-1]] = end
    has = count[context] >= MIN_CONTEXT
    pair, of = np.unique(context[has].astype(np.int64) * len(known) + at[has], return_inverse=True)
    u, w = pair // len(known), pair % len(known)
    split = np.maximum(1, -(-count[u] // limit)).astype(np.uint64)
    shard = _top(mix64(mix64(known[u]) + mix64(known[w] ^ np.uint64(0xABCDEF)) % split), bits)
    order = np.lexsort((w, u, shard))
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    token = np.full(len(at), -1, np.int32)
    token[has] = number[of]
    return shard[order], u[order], w[order], token, context


def score(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score.
    ``split``: customers from which on a restaurant is split over shards."""
    spark, folder = docs.sparkSession, run_folder(docs, "lm")
    table, bits = block_table(docs, folder, BLOCK_BYTES)

    def kept(df: DataFrame, name: str) -> DataFrame:
        """A stage's result; what it shuffled is no longer needed."""
        out = written(df, folder, name)
        release(spark)
        return out

    # 1. words and their training counts, by range
    def send_words(block, group):
        ids, at, known, first = _block(group)
        train = np.repeat(~_held(ids), np.diff(first))
        count = np.bincount(at[train], minlength=len(known))
        return _rows([(b, block[0].as_py(), planes(known[a:e]), planes(count[a:e], 4)) for b, a, e in _cuts(_top(known, bits))],
                     [("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    sent = bucketed(table.groupBy("block").applyInArrow(send_words, "bucket long, block long, keys binary, counts binary"),
                    folder, "words", "bucket", min(1 << bits, 100_000))
    release(spark)

    def count_words(bucket, group):
        blocks = group["block"].to_pylist()
        keys = [unplanes(k) for k in group["keys"].to_pylist()]
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, at, np.concatenate([unplanes(c, 4) for c in group["counts"].to_pylist()]).astype(np.int64))
        out, a = [], 0
        for b, k in zip(blocks, keys):
            out.append((b, bucket[0].as_py(), planes(total[at[a : a + len(k)]], 6), None, None))
            a += len(k)
        out.append((-1, bucket[0].as_py(), None, int(total.sum()), int((total > 0).sum())))
        return _rows(out, [("block", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])

    counted = kept(sent.groupBy("bucket").applyInArrow(count_words, "block long, bucket long, counts binary, n long, v long"), "counted")
    n, v = (int(x or 0) for x in counted.where("block = -1").agg(F.sum("n"), F.sum("v")).first())
    counts = counted.where("block >= 0").select("block", "bucket", F.lit(1).alias("kind"), F.col("counts").alias("a"), F.lit(None).cast("binary").alias("b"))

    def joined(rows, kind, column, read):
        parts = [read(p) for _, p in sorted((r[1], r[column]) for r in rows if r[2] == kind)]
        return np.concatenate(parts) if parts else read(b"")

    def six(data):
        return unplanes(data, 6).astype(np.int64)

    def floats(data):
        return np.frombuffer(data, np.float32).astype(np.float64)

    def masses(data):
        return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<f4").ravel().astype(np.float64)

    # 2. pairs with a restaurant, by shard
    def send_pairs(block, left, right):
        give_back()
        out = []
        if left.num_rows:
            ids, at, known, first = _block(left)
            rows = list(zip(*(right[c].to_pylist() for c in ("block", "bucket", "kind", "a"))))
            count = joined(rows, 1, 3, six)
            shard, u, w, token, _ = _pairs(at, known, first, count, bits, split)
            train = np.repeat(~_held(ids), np.diff(first))
            c = np.bincount(token[train & (token >= 0)], minlength=len(u))
            # the parent's first guess of each word's probability, in fifths of octaves: one byte
            level = np.round(5 * np.log2((n + 1) / (count[w] + 0.5))).astype(np.int64).clip(0, 255)
            for s, a, e in _cuts(shard):
                of, run = np.unique(u[a:e], return_counts=True)
                out.append((s, block[0].as_py(), planes(_cut(known[of], bits), _width(bits)), planes(count[of], 6), planes(run, 4),
                            planes(_cut(known[w[a:e]], bits), _width(bits)), planes(level[a:e], 1), planes(c[a:e], 5)))
        return _rows(out, [("shard", pa.int64()), ("block", pa.int64()), *((x, pa.binary()) for x in ("us", "cs", "runs", "ws", "levels", "counts"))])

    pairs = (table.groupBy("block").cogroup(counts.groupBy("block"))
             .applyInArrow(send_pairs, "shard long, block long, us binary, cs binary, runs binary, ws binary, levels binary, counts binary"))

    # 3. seating
    def sit(shard, group):
        give_back()
        col = {c: [unplanes(x, width) for x in group[c].to_pylist()] for c, width in
               (("us", _width(bits)), ("cs", 6), ("runs", 4), ("ws", _width(bits)), ("levels", 1), ("counts", 5))}
        runs = np.concatenate(col["runs"]).astype(np.int64)
        u_of = np.repeat(np.concatenate(col["us"]), runs)
        whole = np.repeat(np.concatenate(col["cs"]).astype(np.int64), runs)
        w_of, c_of = np.concatenate(col["ws"]), np.concatenate(col["counts"]).astype(np.int64)
        q_of = 2.0 ** (np.concatenate(col["levels"]).astype(np.int64) / -5.0)
        key = mix64(u_of ^ (w_of * np.uint64(0x9E3779B97F4A7C15)))
        _, one, at = np.unique(key, return_index=True, return_inverse=True)
        c = np.bincount(at, c_of, minlength=len(one))
        u, w, q, seeds = u_of[one], w_of[one], q_of[one], key[one]
        names, place, row = np.unique(u, return_index=True, return_inverse=True)
        share = np.maximum(1, -(-whole[one][place] // split))  # shards of the restaurant
        own = (c > 0).astype(np.float64)
        held, kept_w, kept_u = np.zeros(len(c)), [], []
        words_here, word_row = np.unique(w, return_inverse=True)
        for sweep in range(SWEEPS):
            there = np.bincount(row, own, minlength=len(names)) * share
            own = seat(c, q, there[row] - own, mix64(seeds + np.uint64(sweep + 1)), DISCOUNT, STRENGTH)
            if sweep >= SWEEPS - SAMPLES:
                held += (c - DISCOUNT * own) / SAMPLES
                kept_w.append(np.bincount(word_row, own, minlength=len(words_here)))
                kept_u.append(np.bincount(row, own, minlength=len(names)))
        out, a = [], 0
        for b, size in zip(group["block"].to_pylist(), map(len, col["counts"])):
            out.append((b, shard[0].as_py(), None, _float_planes(held[at[a : a + size]]), None, None))
            a += size
        customers = np.bincount(word_row, c, minlength=len(words_here))
        for kind, name, values in ((1, words_here, [customers, *kept_w]), (2, names, kept_u)):
            order = np.argsort(name)
            name, values = name[order], [x[order] for x in values]
            used = values[0] > 0
            name, values = name[used], [x[used] for x in values]
            for b, a, e in _cuts((name >> np.uint64(8 * _width(bits) - bits)).astype(np.int64)):
                out.append((None, b, kind, None, planes(name[a:e], _width(bits)), planes(np.concatenate([x[a:e] for x in values]).astype(np.int64), 5)))
        return _rows(out, [("block", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("held", pa.binary()), ("names", pa.binary()), ("tables", pa.binary())])

    seated = kept(pairs.groupBy("shard").applyInArrow(sit, "block long, bucket long, kind int, held binary, names binary, tables binary"), "seated")

    # 4. the parent restaurant, by range of words
    def parent(bucket, left, right):
        blocks, keys = left["block"].to_pylist(), [unplanes(k) for k in left["keys"].to_pylist()]
        if not blocks:
            return _rows([], answer)
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.zeros(len(known))
        np.add.at(c, at, np.concatenate([unplanes(x, 4) for x in left["counts"].to_pylist()]).astype(np.float64))
        cut = _cut(known, bits)
        seen, tables, contexts = np.zeros(len(known)), np.zeros((SAMPLES, len(known))), np.zeros((SAMPLES, len(known)))
        for kind, name, values in zip(*(right[x].to_pylist() for x in ("kind", "names", "tables"))):
            place = np.searchsorted(cut, unplanes(name, _width(bits)))
            got = unplanes(values, 5).reshape(-1, len(place)).astype(np.float64)
            if kind == 1:
                np.add.at(seen, place, got[0])
                for s in range(SAMPLES):
                    np.add.at(tables[s], place, got[1 + s])
            else:
                for s in range(SAMPLES):
                    np.add.at(contexts[s], place, got[s])
        least, sums = [], []
        for s in range(SAMPLES):
            customers = tables[s] + np.maximum(c - seen, 0)
            own = seat(customers, np.full(len(known), 1 / (v + 1)), np.full(len(known), float(v)), mix64(known + np.uint64(s)), PARENT_DISCOUNT, PARENT_STRENGTH)
            least.append((customers - PARENT_DISCOUNT * own).astype(np.float32))
            sums += [float(customers.sum()), float(own.sum())]
        out, a = [], 0
        for b, k in zip(blocks, keys):
            i = at[a : a + len(k)]
            of = i[c[i] >= MIN_CONTEXT]
            out.append((b, bucket[0].as_py(), np.stack([x[i] for x in least], 1).tobytes(), np.stack([x[of] for x in contexts], 1).astype(np.float32).tobytes(), None))
            a += len(k)
        out.append((-1, bucket[0].as_py(), None, None, sums))
        return _rows(out, answer)

    answer = [("block", pa.int64()), ("bucket", pa.int64()), ("least", pa.binary()), ("contexts", pa.binary()), ("sums", pa.list_(pa.float64()))]
    root = kept(
        sent.groupBy("bucket").cogroup(seated.where("kind is not null").select("bucket", "kind", "names", "tables").groupBy("bucket"))
        .applyInArrow(parent, "block long, bucket long, least binary, contexts binary, sums array<double>"), "root")
    totals = [float(x or 0) for x in root.where("block = -1").agg(*(F.sum(F.col("sums")[k]) for k in range(2 * SAMPLES))).first()]

    # 5. scores
    empty = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
             ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def measure(block, left, right):
        give_back()
        if not left.num_rows:
            return _rows([], empty)
        ids, at, known, first = _block(left)
        rows = list(zip(*(right[c].to_pylist() for c in ("block", "bucket", "kind", "a", "b"))))
        count = joined(rows, 1, 3, six)
        held = joined(rows, 2, 3, masses)
        least = joined(rows, 3, 3, floats).reshape(-1, SAMPLES)
        contexts = np.zeros((len(known), SAMPLES))
        contexts[count >= MIN_CONTEXT] = joined(rows, 3, 4, floats).reshape(-1, SAMPLES)
        shard, u, w, token, context = _pairs(at, known, first, count, bits, split)
        p, mass = np.zeros(len(known)), []
        word_p = []
        for s in range(SAMPLES):
            customers, tables = totals[2 * s], totals[2 * s + 1]
            word_p.append((least[:, s] + (PARENT_STRENGTH + PARENT_DISCOUNT * tables) / (v + 1)) / (PARENT_STRENGTH + customers))
            mass.append(STRENGTH + DISCOUNT * contexts[:, s])
            p += word_p[s] / SAMPLES
        pair_p = held / (STRENGTH + count[u]) if len(u) else held
        for s in range(SAMPLES):
            pair_p = pair_p + mass[s][u] * word_p[s][w] / (STRENGTH + count[u]) / SAMPLES
        logs = np.log10(p)[at]
        has = token >= 0
        logs[has] = np.log10(pair_p)[token[has]]
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))[at]
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        by = lambda x: np.bincount(doc, x, minlength=len(ids))
        return pa.table({
            "doc_id": pa.array([None if i == (1 << 63) - 1 else i for i in ids.tolist()], pa.int64()), "held_out": pa.array(_held(ids)),
            "n_tokens": pa.array(np.diff(first)), "n_known": pa.array(by(count[at] > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(ids), n, np.int64)), "base_score": pa.array(by(base)), "score": pa.array(by(logs))})

    none = F.lit(None).cast("binary")
    back = counts.unionByName(
        seated.where("kind is null").select("block", "bucket", F.lit(2).alias("kind"), F.col("held").alias("a"), none.alias("b"))
    ).unionByName(root.where("block >= 0").select("block", "bucket", F.lit(3).alias("kind"), F.col("least").alias("a"), F.col("contexts").alias("b")))
    scores = kept(table.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        measure, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "scores")
    drop_tables(spark, folder)
    return scores
