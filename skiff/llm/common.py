"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CalendarIntervalType, DataType, MapType, StructType, VariantType

#: Rows a Python task receives at once; whole texts, so small batches bound memory.
ROWS_PER_BATCH = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on (results do not depend on them)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of the documents table; a null text reads as empty."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def give_back() -> None:
    """Return a worker's freed memory to the machine: it may wait long for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def orderable(kind: DataType) -> bool:
    """Whether Spark can compare values of a type (maps and variants have no order)."""
    if isinstance(kind, ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType, CalendarIntervalType))


#: Rows of a table of ids up to which it is broadcast (16 bytes a row); always behind a count.
BROADCAST_IDS = 1_000_000


def bounded(ids: DataFrame) -> DataFrame:
    """``ids`` marked for broadcast if a count proves it small; otherwise joins shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the fixed train / held-out split."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (splitmix finaliser): consistent hashed randomness."""
    x = np.asarray(x).astype(np.uint64, copy=True)
    t = x >> np.uint64(30)
    x ^= t
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=t if t.ndim else None)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=t if t.ndim else None)
    return x


def uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


# ------------------------------------------------------------------ texts as arrays
_RNG = np.random.Generator(np.random.PCG64(20240501))
#: A random 64-bit value for each byte; the base of positional hashes and its inverse.
BYTE_VALUE = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text handled at once inside a task.
PIECE_BYTES = 1 << 18


def text_pieces(texts, limit: int = PIECE_BYTES):
    """(first row, bytes, offsets) of consecutive rows of an Arrow string array, a few
    megabytes at a time (a longer text alone); null reads as empty."""
    if hasattr(texts, "combine_chunks"):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    k = 0
    while k < len(texts):
        end = max(k + 1, int(np.searchsorted(off, off[k] + limit, "right")) - 1)
        yield k, raw[off[k] : off[end]], off[k : end + 1] - off[k]
        k = end


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """Powers 0 to n of an odd base, modulo 2**64; a piece's worth is remembered."""
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        p = np.full(max(n, PIECE_BYTES) + 1, base, np.uint64)
        p[0] = 1
        known = np.cumprod(p, dtype=np.uint64)
        if n <= 4 * PIECE_BYTES:
            _POWERS[base] = known
    return known[: n + 1]


def prefix_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and inverse powers from which the hash of any substring follows."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE.take(raw) * _powers(len(raw), _BASE)[:-1], dtype=np.uint64, out=sums[1:])
    return sums, _powers(len(raw), _INVERSE)


def substring_hashes(sums, inverse, starts, ends) -> np.ndarray:
    return mix64((sums[ends] - sums[starts]) * inverse[starts])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without space, tab or line ends; A-Z read as a-z) of texts laid end to
    end: their hashes, byte starts, byte ends, and the first word's number of each text."""
    inside = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sums, inverse = prefix_hashes(_LOWER[raw])
    return substring_hashes(sums, inverse, starts, ends), starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text, and each text's first; a text
    of fewer words (but some) has one shingle, of all its words."""
    n = np.diff(first)
    m = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_first = np.concatenate([[0], np.cumsum(m)])
    at = np.arange(out_first[-1]) - np.repeat(out_first[:-1] - first[:-1], m)
    last = np.repeat(first[1:], m)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = at + k < last
        h += np.where(there, mix64(hashes[np.minimum(at + k, max(len(hashes) - 1, 0))] + np.uint64(k)), 0) if len(hashes) else 0
        h *= np.uint64(0xD6E8FEB86659FD93)
    return mix64(h), out_first
