"""Benchmark decontamination, DataFrame functions only.

A document leaks an item when a window of the item's size (in five-word shingles) has a
weighted shingle similarity (multiset Jaccard) of at least 0.8 with it. Steps:

1. Every ``stride``-th shingle of a document meets the items' shingles. The stride follows from the
   item sizes: a window of m shingles that is similar enough misses at most k = m // 9 of
   them, so by the pigeonhole principle it holds a run of (m - k) / (k + 1) matching ones, and
   a stride no longer than that run cannot step over it. No window is lost.
2. Windows that can still reach the similarity with some item (enough sampled shingles, then
   enough shingles of the item at all) get a 64-bit SimHash over their weighted shingles.
   From here on a window knows the item size it was cut for, but no item.
3. Multi-index Hamming blocks: eight 8-bit blocks; two fingerprints within RADIUS = 23
   differ in at most two bits of some block, so joining the windows' blocks with all
   values within two bits of the blocks of the items of that size misses no pair within
   the radius. A window meets an item through its fingerprint alone.
4. The pairs within the radius are verified by the exact similarity.

Words: lower-cased runs of letters and digits. Items under five words have no shingles
and match nothing; a document smaller than an item is one window. Null texts read as empty; rows
without an id are left out (they cannot be named). Identical items count as their
smallest id; rows that repeat an id count as one document with the better similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skiff.llm.common import bounded, free_name
from skiff.session import new_run_dir

SIMILARITY = 0.8
WORDS = 5
RADIUS, BLOCKS = 23, 8
#: Items up to this many shingles in all are broadcast (checked by a count), beyond that joins shuffle.
BROADCAST_SHINGLES = 1_000_000


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingle_hashes(words: str, stride: int = 1) -> Column:
    at = ", ".join(f"get({words}, i + {k})" for k in range(WORDS))
    return F.expr(f"if(size({words}) < {WORDS}, cast(array() as array<bigint>), "
                  f"transform(sequence(0, size({words}) - {WORDS}, {stride}), i -> xxhash64({at})))")


def _numbered(array: str) -> Column:
    """Each shingle hash with its occurrence number, so that sets compare as multisets."""
    return F.expr(f"transform({array}, (x, i) -> xxhash64(x, size(filter(slice({array}, 1, i), y -> y = x))))")


def _fingerprint(array: str) -> Column:
    ones = (f"aggregate({array}, array_repeat(0, 64), "
            "(acc, h) -> transform(acc, (a, i) -> a + cast(shiftrightunsigned(h, i) & 1 as int)))")
    # never null, so that no join asks for a null check that would compute it a second time
    return F.expr(f"coalesce(aggregate(transform({ones}, (a, i) -> if(2 * a > size({array}), shiftleft(1L, i), 0L)), "
                  "0L, (x, y) -> x | y), 0L)")


def _near_bytes() -> list[int]:
    """Masks that change at most two of eight bits."""
    return sorted({0} | {1 << a | 1 << b for a in range(8) for b in range(8)})


def item_table(items: DataFrame) -> DataFrame:
    """One row per distinct item text: smallest id, shingle hashes, least shared shingles."""
    return (
        items.select(F.col("item_id").cast("long").alias("item_id"), word_array(F.col("text")).alias("w"))
        .where("item_id is not null").groupBy("w").agg(F.min("item_id").alias("item_id"))
        .select("item_id", _shingle_hashes("w").alias("ih")).where("size(ih) > 0")
        .select("item_id", "ih", F.size("ih").alias("m"), F.expr("size(ih) div 9").alias("k"))
    )


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_windows): best window of each leak."""
    it = item_table(items)
    facts = it.agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("total"),
        F.min(F.expr("greatest(1, ceil((m - k) / (k + 1)))")).alias("stride"), F.count("*").alias("n"),
    ).first()  # three numbers
    stride = max(1, min(int(facts["stride"] or 1), 8))
    small = (lambda df: F.broadcast(df)) if facts["total"] <= BROADCAST_SHINGLES else (lambda df: df)
    docs = docs.select("doc_id", "text").where("doc_id is not null")

    # 1. sampled shingles that any item has
    sampled = (
        docs.select("doc_id", word_array(F.col("text")).alias("w"))
        .select("doc_id", F.expr(f"size(w) - {WORDS - 1}").alias("n"), F.posexplode(_shingle_hashes("w", stride)).alias("j", "h"))
    )
    known = it.select("item_id", "m", "k", F.explode(F.array_distinct("ih")).alias("h"))
    pairs = (
        sampled.join(small(known), "h")
        .groupBy("doc_id", "item_id", "n", "m", "k").agg(F.sort_array(F.collect_set(F.expr(f"j * {stride}"))).alias("p"))
        .withColumn("size", F.expr("least(m, n)"))
        .withColumn("least", F.expr(f"greatest(1, size div {stride} - k)")).where("size(p) >= least")
        # windows that hold ``least`` sampled hits in a row: a range of starts for each run of hits
        .withColumn("starts", F.expr(
            "array_distinct(flatten(transform(filter(transform(sequence(0, size(p) - least), a -> named_struct("
            "'lo', greatest(0, get(p, a + least - 1) - size + 1), 'hi', least(get(p, a), n - size))), "
            "x -> x.lo <= x.hi), x -> sequence(x.lo, x.hi))))"))
        .select("doc_id", F.struct("item_id", "n", "size", "starts").alias("f"))
    )
    # 2. the windows themselves, each document's shingles hashed once; only texts with a candidate move
    folder = new_run_dir(docs.sparkSession, "decontam")
    pairs.groupBy("doc_id").agg(F.collect_list("f").alias("found")).write.parquet(f"{folder}/found")
    by_doc = docs.sparkSession.read.parquet(f"{folder}/found")
    held = docs.join(bounded(by_doc.select("doc_id")), "doc_id", "left_semi")
    whole = (
        held.join(by_doc, "doc_id").select("doc_id", "found", word_array(F.col("text")).alias("w"))
        .select("doc_id", "found", _shingle_hashes("w").alias("dh"))
        .select("doc_id", "dh", F.explode("found").alias("f")).where("size(dh) = f.n")
        .select("doc_id", F.col("f.item_id").alias("item_id"), F.col("f.size").alias("size"), F.col("f.starts").alias("starts"), "dh")
    )
    prints = it.select("item_id", "ih", "m", _fingerprint("ih").alias("item_print"), _numbered("ih").alias("item_set"))
    windows = (
        whole.join(small(it.select("item_id", "ih", "m", "k")), "item_id")
        .withColumn("start", F.explode(F.expr(
            "filter(starts, s -> size(filter(slice(dh, s + 1, size), h -> array_contains(ih, h))) >= size - k)")))
        .select("doc_id", "m", "start", F.expr("slice(dh, start + 1, size)").alias("win")).distinct()
        .withColumn("print", _fingerprint("win"))
    )
    # 3. multi-index Hamming blocks
    masks = F.array(*map(F.lit, _near_bytes()))
    near = (
        prints.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
        .select("*", F.explode(masks).alias("mask"))
        .withColumn("value", F.expr("cast((shiftrightunsigned(item_print, block * 8) & 255L) as int) ^ mask"))
    )
    within = (
        windows.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
        .withColumn("value", F.expr("coalesce(cast(shiftrightunsigned(print, block * 8) & 255L as int), -1)"))
        .join(small(near.drop("ih", "mask")) if facts["n"] * 296 <= BROADCAST_SHINGLES else near.drop("ih", "mask"),
              ["m", "block", "value"])
        .where(f"bit_count(print ^ item_print) <= {RADIUS}")
        # a pair that meets in several blocks counts in the first
        .where("block = filter(sequence(0, 7), b -> bit_count(shiftrightunsigned(print ^ item_print, b * 8) & 255L) <= 2)[0]")
    )
    # 4. exact weighted similarity
    shared = F.size(F.array_intersect(_numbered("win"), F.col("item_set")))
    return (
        within.select("doc_id", "item_id", "start", F.size("win").alias("a"), "m", shared.alias("both"))
        .withColumn("similarity", F.expr("both / (a + m - both)")).where(f"both >= {SIMILARITY} * (a + m - both) - 1e-9")
        .groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start_word"),
             F.countDistinct("start").alias("n_windows"))
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose document leaks no item."""
    spark, leak = docs.sparkSession, free_name(docs, "leak")
    folder = f"{new_run_dir(spark, 'leaks')}/ids"
    leaks(docs.select("doc_id", "text"), items).select(F.col("doc_id").alias(leak)).distinct().write.parquet(folder)
    return docs.join(bounded(spark.read.parquet(folder)), F.col("doc_id") == F.col(leak), "left_anti")
