"""MinHash near-dedup with DartMinHash signatures of weighted five-word shingles.

Each shingle of a text with count c owns the region [0, c) x [0, rank limit) of its own
plane; darts fall on that plane as a Poisson process drawn from hashes of the shingle alone, so
equal shingles see equal darts. A dart names one of K coordinates; the dart with the
lowest rank keeps it. Only about K (ln K + 2) darts fall per text, however many shingles
it has, because the rank limit shrinks with the text's weight; texts left with an empty
coordinate throw with a doubled limit. Two signatures agree in a coordinate with the
probability of the weighted Jaccard similarity, so bands of ROWS coordinates find similar texts
(a pair at 0.8 is missed with a probability of 0.738**32, some 6e-5, one at 0.9 of 1e-10).

Texts of equal word sequences are one class first, so thousands of copies are one text
from there on. Buckets that hold the same texts count once. A bucket is dealt out in
chunks of CHUNK texts, each with the bucket's smallest text added; a chunk compares all
its texts exactly. Buckets of several chunks and still several components have what is
left compared: texts outside the bucket's largest component against every chunk. So
every pair of a bucket is either compared or known to be connected, and no task holds
more than a few chunks.

Result: one row per doc_id with class_id, the smallest doc_id reached over links of at least
0.8. Texts without words are copies of each other; a text of one to four words is a
single shingle; null reads as empty; rows without an id are left out; rows that repeat
an id are one node with all their texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm.common import free_name, mix64, orderable, prepare, shingles, text_pieces, uniform, words
from skiff.llm.components import components
from skiff.session import new_run_dir

SIMILARITY = 0.8
BANDS, ROWS = 32, 6
K = BANDS * ROWS
#: Texts that one task compares with each other at once.
CHUNK = 384


def multiset(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: (text, hash, count)."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def darts(h: np.ndarray, count: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts inside the regions of elements: (element, rank, dart's hash).

    The weight axis is cut at powers of two. In a cell of width v, ranks of successive darts
    are sums of exponential gaps with mean 1 / v, so any region sees the same darts."""
    out = []
    top = int(np.ceil(np.log2(count.max()))) if len(count) else -1
    for cell in range(top + 1 if top >= 0 else 0):
        low, width = (0.0, 1.0) if cell == 0 else (2.0 ** (cell - 1), 2.0 ** (cell - 1))
        live = np.flatnonzero(count > low)
        rank, step = np.zeros(len(live)), 0
        while len(live):
            # a few successive darts at once where few elements are left; the same sums in the same order
            block = 1 if len(live) > 4096 else 16 if len(live) > 256 else 128
            salt = np.array([((cell << 32) + step + k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(block)], np.uint64)
            draw = mix64(h[live][:, None] ^ salt)
            ranks = np.cumsum(np.column_stack([rank, -np.log(uniform(draw)) / width]), axis=1)[:, 1:]
            inside = ranks <= limit[live][:, None]
            i, j = np.nonzero(inside)
            dart = mix64(draw[i, j] + np.uint64(0x632BE59BD9B4E019))
            owner = live[i]
            hit = low + uniform(mix64(dart ^ np.uint64(0xD1B54A32D192ED03))) * width < count[owner]
            out.append((owner[hit], ranks[i, j][hit], dart[hit]))
            on = inside[:, -1]
            live, rank = live[on], ranks[on, -1]
            step += block
    if not out:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def signatures(row: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """n x k dart hashes: for each coordinate the dart of lowest rank; rows of texts without
    elements stay 0."""
    out = np.zeros((n, k), np.uint64)
    weight = np.bincount(row, count, minlength=n)
    todo, throws = np.flatnonzero(weight > 0), k * (np.log(k) + 2)
    while len(todo):
        own = np.isin(row, todo) if len(todo) < n else np.ones(len(row), bool)
        r, e, c = row[own], h[own], count[own]
        at, rank, dart = darts(e, c, throws / weight[r])
        cell = r[at] * k + (dart % np.uint64(k)).astype(np.int64)
        best = np.full(n * k, np.inf)
        np.minimum.at(best, cell, rank)
        won = rank == best[cell]
        full = best < np.inf
        out.ravel()[cell[won]] = dart[won]
        todo = todo[~full.reshape(n, k)[todo].all(1)]
        throws *= 2
    return out


def _signed(batches):
    for batch in batches:
        for k, raw, off in text_pieces(batch.column(1), 1 << 20):
            n = len(off) - 1
            w, _, _, first = words(raw, off)
            size = np.diff(first)
            own = np.repeat(np.arange(n), size)
            place = np.arange(len(w)) - np.repeat(first[:-1], size)
            keys = []
            for seed in (1, 2):  # copies: equal sequences of words
                sums = np.zeros(len(w) + 1, np.uint64)
                np.cumsum(mix64(w + mix64((place * 2 + seed).astype(np.uint64))), dtype=np.uint64, out=sums[1:])
                total = sums[first[1:]] - sums[first[:-1]]
                keys.append(mix64(total + size.astype(np.uint64)).view(np.int64))
            s, sf = shingles(w, first)
            sig = signatures(*multiset(s, sf), n)
            band = np.zeros((n, BANDS), np.uint64)
            for j in range(ROWS):
                band = mix64(band + sig[:, j::ROWS][:, :BANDS]) + np.uint64(j)
            band = mix64(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).slice(k, n), "key1": pa.array(keys[0]), "key2": pa.array(keys[1]),
                "n_words": pa.array(size, pa.int64()),
                "bands": pa.FixedSizeListArray.from_arrays(pa.array(band.ravel()), BANDS).cast(pa.list_(pa.int64())),
            })


def similar(row: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, least: float = SIMILARITY) -> np.ndarray:
    """Which pairs of n texts reach the weighted Jaccard similarity, exactly: a shingle that occurs
    c times is c elements, shared elements are counted by matrix products."""
    many = np.repeat(np.arange(len(h)), count)
    nth = np.arange(len(many)) - np.repeat(np.cumsum(count) - count, count)
    e, r = mix64(h[many] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), row[many]
    weight = np.bincount(r, minlength=n).astype(np.float64)
    _, code, times = np.unique(e, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    r, code = r[keep], number[code[keep]]
    order = np.argsort(code, kind="stable")
    r, code = r[order], code[order]
    both, step = np.zeros((n, n)), 4096
    for a in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(code, [a, a + step])
        x = np.zeros((n, step), np.float32)
        x[r[lo:hi], code[lo:hi] - a] = 1
        both += x @ x.T
    return both >= least * (weight[:, None] + weight[None, :] - both) - 1e-9


def _texts_multiset(texts: pa.Array):
    parts, n = [], 0
    for k, raw, off in text_pieces(texts):
        w, _, _, first = words(raw, off)
        r, h, c = multiset(*shingles(w, first))
        parts.append((r + k, h, c))
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]


def _link_groups(table: pa.Table) -> pa.Table:
    """Which parts (nodes known to be connected) the texts of one task connect: each part
    with the smallest one it reaches."""
    part = np.array(table["part"].to_pylist(), np.int64)
    value, own = np.unique(part, return_inverse=True)
    ok = similar(*_texts_multiset(table["text"]), len(part))
    joined = np.zeros((len(value), len(value)), bool)
    i, j = np.nonzero(ok)
    joined[own[i], own[j]] = True
    np.fill_diagonal(joined, True)
    label, before = np.arange(len(value)), None
    while before is None or (label != before).any():
        before = label
        label = np.where(joined, label[None, :], len(value)).min(1)
        label = label[label]
    out = np.flatnonzero(label != np.arange(len(value)))
    return pa.table({"a": pa.array(value[out]), "b": pa.array(value[label[out]])})


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) for every doc_id of ``docs`` (doc_id, text)."""
    spark = prepare(docs.sparkSession)
    folder = new_run_dir(spark, "neardup")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    signed = kept(docs.mapInArrow(_signed, "doc_id long, key1 long, key2 long, n_words long, bands array<long>"), "signed")
    copies = signed.groupBy("key1", "key2", "n_words").agg(F.min("doc_id").alias("rep"))
    ids = signed.select("doc_id", "key1", "key2", "n_words").join(copies, ["key1", "key2", "n_words"]).select("doc_id", "rep").distinct()
    copy_links = ids.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    # buckets of two texts and more; of those that hold the same texts, one
    firsts = signed.where("n_words > 0").join(
        copies.where("n_words > 0").select("key1", "key2", "n_words", F.col("rep").alias("doc_id")), ["key1", "key2", "n_words", "doc_id"], "left_semi")
    member = firsts.select("doc_id", F.explode("bands").alias("bucket")).distinct()
    size = member.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("n > 1")
    once = size.groupBy("n", "x", "lead", "last").agg(F.min("bucket").alias("bucket"))
    dealt = kept(member.join(once.select("bucket", "n", "lead"), "bucket")
                 .withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("long"))
                 .withColumn("chunk", F.when(F.col("chunks") == 1, F.lit(0)).otherwise(F.expr("pmod(xxhash64(doc_id), chunks)"))), "dealt")
    # the smallest text of a bucket goes to each of its chunks
    placed = dealt.select("bucket", "chunk", "doc_id").union(
        dealt.where("doc_id = lead and chunks > 1").select("bucket", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), "doc_id")).distinct()
    near = kept(placed.join(docs, "doc_id").withColumn("part", F.col("doc_id")).groupBy("bucket", "chunk")
                .applyInArrow(_link_groups, "a long, b long"), "near").distinct()
    parts = kept(components(near), "parts")

    # buckets of several chunks that are not one component yet
    wide = dealt.where("chunks > 1").join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("root", "doc_id"))
    per = wide.groupBy("bucket", "part").agg(F.count("*").alias("c"))
    main = per.groupBy("bucket").agg(F.count("*").alias("k"), F.max_by("part", F.struct("c", -F.col("part"))).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most")).where("k > 1")
    mixed = kept(wide.select("bucket", "chunk", "chunks", "doc_id", "part").join(main, "bucket")
                 .withColumn("slices", F.ceil((F.col("all") - F.col("most")) / CHUNK).cast("long")), "mixed")
    rest = mixed.where("part != main").select(
        "bucket", F.expr("pmod(xxhash64(doc_id, 7), slices)").alias("slice"), F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), "doc_id", "part")
    every = mixed.select("bucket", F.explode(F.expr("sequence(0L, slices - 1)")).alias("slice"), "chunk", "doc_id", "part")
    more = kept(rest.union(every).distinct().join(docs, "doc_id").groupBy("bucket", "slice", "chunk")
                .applyInArrow(_link_groups, "a long, b long"), "more")
    links = copy_links.union(near).union(more)
    found = components(links).withColumnRenamed("node", "doc_id")
    return ids.select("doc_id").distinct().join(found, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` (all columns) per class: its smallest doc_id, and of rows that
    repeat that id the smallest (columns without an order compare as JSON text). Rows without
    an id stay."""
    first, row = free_name(docs, "first"), free_name(docs, "row")
    firsts = classes(docs.select("doc_id", "text")).where("doc_id = class_id").select(F.col("doc_id").alias(first))
    named = docs.where("doc_id is not null").join(firsts, F.col("doc_id") == F.col(first), "left_semi")
    rest = [f"`{c}`" for c in docs.columns if c != "doc_id"]
    smallest = F.min(F.struct(*rest))
    if not all(orderable(f.dataType) for f in docs.schema.fields):
        key = [F.col(f"`{f.name}`") if orderable(f.dataType) else F.to_json(F.struct(f"`{f.name}`")) for f in docs.schema.fields if f.name != "doc_id"]
        smallest = F.min_by(F.struct(*rest), F.struct(*key))
    one = named.groupBy("doc_id").agg(smallest.alias(row)).select("doc_id", f"{row}.*")
    return one.select(*[f"`{c}`" for c in docs.columns]).union(docs.where("doc_id is null"))
