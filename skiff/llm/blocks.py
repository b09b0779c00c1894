"""Blocks of whole documents, and which of their keys other documents share.

``block_table`` writes documents once, in blocks of a few megabytes, bucketed by block: later
steps group by block without another shuffle. ``shared_keys`` tells each block which of its
64-bit keys occur in two documents or more: a block sends every distinct key once (so a key
that a third of all rows hold is one entry a block), key ranges count, and one bit a key
comes back.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiff.llm.common import prepare, text_pieces
from skiff.session import new_run_dir

#: Text of a block, and of the key range that one task compares.
BLOCK_BYTES, RANGE_BYTES = 6 << 20, 4 << 20
KEY_BITS = 40  # besides the bits of the key range


def block_table(docs: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, block) as a table bucketed by block in the shared folder, and the
    number of bits that deal keys to ranges. A task writes its own blocks: no shuffle."""
    spark = prepare(docs.sparkSession)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, docs.rdd.getNumPartitions())
    slices = max(1, -(-total // (parts * block_bytes)))
    name = f"skiff_blocks_{uuid.uuid4().hex[:12]}"
    blocked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "block", F.spark_partition_id().cast("long") * slices + F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(slices)))
    blocked.write.bucketBy(min(parts * slices, 100_000), "block").option("path", f"{folder}/{name}").saveAsTable(name)
    _TABLES.setdefault(folder, []).append(name)
    return spark.table(name), max(1, int(total // RANGE_BYTES)).bit_length()


def block_texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, bytes, offsets) of a block, in a fixed order. A missing id is above all others."""
    ids = np.array([(1 << 63) - 1 if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
    texts = table["text"].combine_chunks()
    order = np.argsort(ids, kind="stable")
    if len(set(ids.tolist())) < len(ids):  # repeated ids: then by text, so that every pass sees one order
        words = texts.to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda k: (ids[k], words[k])))
    texts = texts.take(pa.array(order))
    pieces = list(text_pieces(texts, 1 << 62))
    _, raw, off = pieces[0]
    return ids[order], raw, off


def pack(keys: np.ndarray) -> bytes:
    """The low KEY_BITS of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // (KEY_BITS // 8), 8), np.uint8)
    wide[:, : KEY_BITS // 8] = np.frombuffer(data, np.uint8).reshape(len(wide), -1)
    return wide.view("<u8").ravel().astype(np.uint64)


def short(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys cut to the bits that are compared; different keys may meet, equal ones always do."""
    return keys >> np.uint64(64 - bits - KEY_BITS)


def ranges(sorted_short: np.ndarray, bits: int):
    """(range, first, end) of each non-empty key range."""
    of = (sorted_short >> np.uint64(KEY_BITS)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    for a, b in zip(cut, [*cut[1:], len(of)]):
        yield int(of[a]), int(a), int(b)


def shared_keys(table: DataFrame, keys_of, bits: int) -> DataFrame:
    """(block, bucket, flags): for each block and key range, a bit for each of the block's
    distinct short keys in order. ``keys_of(raw, offsets)`` gives (keys, rows) of a block."""

    def send(block, group):
        _, raw, off = block_texts(group)
        keys, rows = keys_of(raw, off)
        keys = short(keys, bits)
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        twice = (np.minimum.reduceat(rows, first) != np.maximum.reduceat(rows, first)) if len(first) else np.zeros(0, bool)
        keys = keys[first]
        out = [(b, pack(keys[a:e]), np.packbits(twice[a:e]).tobytes()) for b, a, e in ranges(keys, bits)]
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int64()), "block": pa.array([block[0].as_py()] * len(out), pa.int64()),
                         "keys": pa.array([x[1] for x in out], pa.binary()), "twice": pa.array([x[2] for x in out], pa.binary())})

    def count(bucket, group):
        parts = [unpack(k) for k in group["keys"].to_pylist()]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(p)).astype(bool) for t, p in zip(group["twice"].to_pylist(), parts)]
        _, at, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        often = times > 1
        often[at[np.concatenate(twice)]] = True
        hit = often[at]
        ends = np.cumsum([len(p) for p in parts])
        flags = [np.packbits(hit[e - len(p) : e]).tobytes() for e, p in zip(ends, parts)]
        return pa.table({"block": group["block"].combine_chunks(), "bucket": pa.array([bucket[0].as_py()] * len(parts), pa.int64()),
                         "flags": pa.array(flags, pa.binary())})

    sent = table.groupBy("block").applyInArrow(send, "bucket long, block long, keys binary, twice binary")
    return sent.groupBy("bucket").applyInArrow(count, "block long, bucket long, flags binary")


def is_shared(keys: np.ndarray, bits: int, buckets, flags) -> np.ndarray:
    """Which of a block's keys are shared, from the block's rows of shared_keys."""
    cut = short(keys, bits)
    known = np.unique(cut)
    hit, got = np.zeros(len(known), bool), dict(zip(buckets, flags))
    for b, a, e in ranges(known, bits):
        hit[a:e] = np.unpackbits(np.frombuffer(got[b], np.uint8), count=e - a).astype(bool)
    return hit[np.searchsorted(known, cut)]


#: Names of the tables that runs have registered, by run folder.
_TABLES: dict[str, list[str]] = {}


def drop_tables(spark: SparkSession, folder: str) -> None:
    """Take a finished run's tables out of the catalog."""
    for name in _TABLES.pop(folder, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished stages: it does so once the driver has
    collected their plans, which it may otherwise put off for long while disks fill."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed by ``key`` in the shared folder: one shuffle now, none later."""
    full = f"skiff_{name}_{uuid.uuid4().hex[:12]}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", f"{folder}/{full}").saveAsTable(full)
    _TABLES.setdefault(folder, []).append(full)
    return df.sparkSession.table(full)


def planes(x: np.ndarray, width: int = 8) -> bytes:
    """Integers as bytes, all lowest bytes first, so that compression finds the empty high ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, width: int = 8) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return wide.view("<u8").ravel().astype(np.uint64)


def run_folder(docs: DataFrame, label: str) -> str:
    return new_run_dir(docs.sparkSession, label)
