"""Lloyd clustering of integer vectors with heap-ordered bounds.

Vectors are written once in blocks, bucketed by block. For each block and cluster a heap holds, per
vector, how much further its second-nearest centroid was than its own when it was last measured,
plus the drift its cluster had accumulated by then. When centroids move, a cluster's drift grows by
its own movement and the largest movement of any other; a vector whose entry is above the drift
cannot have changed its nearest centroid, and since the heap has the smallest entry on top, only
entries that the drift has passed are popped, measured exactly against all centroids and pushed to
the heap of their nearest. A round reads vectors and heaps of a block side by side (same buckets:
no shuffle), writes the new heaps, and reports what moved between clusters; Spark adds the moves.
The driver holds centroids, sums and drifts only, k times the number of components.

Distances, sums and centroids are exact integers: by floating-point products where every
intermediate value is a whole number below 2**53, by Python integers beyond.

Handled: vectors that are null, of another length, or hold null or non-finite components are not
kept. Repeated vectors and ids each count and each give a row; a missing id stays missing (its hash
input is the prefix alone; equal hashes are ordered by their components). With fewer kept vectors
than k every one is a centroid; equal centroids leave the later ones empty, and empty ones stay as
they are. Ties go to the smaller number. An empty table gives an empty result. A distance or sum
beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.llm.blocks import run_folder, written

DIMENSIONS, CLUSTERS, ROUNDS = 64, 40, 5
#: Vectors of a block: one task holds one block at a time.
BLOCK_ROWS = 16_384
#: Components up to this size keep 64 squared differences, summed, below 2**53.
EXACT = 1 << 21
#: Sums travel as hi * 10**30 + lo.
_CUT = 10**30
_LONG = 1 << 63
#: Relative slack of a bound, far above the rounding of its few operations.
_SLACK = 1e-9


def _packed(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest type that holds them."""
    top = float(np.abs(x).max()) if x.size else 0.0
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    return kind, x.astype(kind).tobytes()


def _kept(ids: pa.Array, vectors: pa.Array, dims: int) -> tuple[list, np.ndarray]:
    """Ids and integer components of the vectors that take part."""
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    flat = vectors.filter(right).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # a null component reads as NaN
    finite = np.isfinite(x).all(1)
    return ids.filter(right).filter(pa.array(finite)).to_pylist(), np.floor(256 * x[finite])


def vector_blocks(vectors: DataFrame, dims: int, k: int, salt: str) -> DataFrame:
    """(block, vec_id, kind, x, seeds): kept vectors, and the block's own k first by hash."""

    def block(number, parts):
        ids, x = [i for p in parts for i in p[0]], np.concatenate([p[1] for p in parts])
        kind, data = _packed(x)
        hashes = [hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).hexdigest() for i in ids]
        seeds = heapq.nsmallest(k, ((h, x[n].tolist()) for n, h in enumerate(hashes)))
        return pa.RecordBatch.from_pydict({
            "block": [number], "vec_id": pa.array([ids], pa.list_(pa.int64())), "kind": [kind], "x": pa.array([data], pa.binary()),
            "seeds": pa.array([[{"hash": h, "at": a} for h, a in seeds]], pa.list_(pa.struct([("hash", pa.string()), ("at", pa.list_(pa.float64()))])))})

    def run(batches):
        from pyspark import TaskContext

        number, parts, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, x = _kept(batch.column(0), batch.column(1), dims)
            for a in range(0, len(ids), BLOCK_ROWS):
                parts.append((ids[a : a + BLOCK_ROWS], x[a : a + BLOCK_ROWS]))
                n += len(parts[-1][0])
                if n >= BLOCK_ROWS:
                    yield block(number, parts)
                    number, parts, n = number + 1, [], 0
        if parts:
            yield block(number, parts)

    schema = "block long, vec_id array<long>, kind string, x binary, seeds array<struct<hash: string, at: array<double>>>"
    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, schema)


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def squared(x: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances of whole-number rows to all centroids: doubles where they hold
    them, else an array of Python integers."""
    large = np.array([max(map(abs, c), default=0) > EXACT for c in centroids], bool)
    far = (np.abs(x) > EXACT).any(1)
    near = np.array([c for c, big in zip(centroids, large) if not big], np.float64).reshape(-1, x.shape[1])
    y = x[~far]
    plain = (y * y).sum(1)[:, None] + (near * near).sum(1) - 2 * (y @ near.T)
    if not large.any() and not far.any():
        return plain
    out = np.empty((len(x), len(centroids)), object)
    out[np.ix_(~far, ~large)] = plain.astype(np.int64).astype(object)
    whole = _whole(x)
    for c, row in enumerate(centroids):
        todo = np.flatnonzero(far | large[c])
        step = whole[todo] - np.array(row, object)
        out[todo, c] = (step * step).sum(1)
    return out


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's nearest centroid (ties: the smaller), and a lower bound of how much
    further the second-nearest is."""
    d = squared(x, centroids)
    rows = np.arange(len(x))
    best = d.argmin(1).astype(np.int64) if len(x) else np.zeros(0, np.int64)
    if len(centroids) < 2:
        return best, np.full(len(x), np.inf)
    first = np.sqrt(d[rows, best].astype(np.float64))
    d[rows, best] = math.inf
    second = np.sqrt(d.min(1).astype(np.float64)) if len(x) else first
    return best, second - first - _SLACK * (second + first)


def _sums(clusters: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Exact sums of the rows of each cluster, their number last, as Python integers."""
    far = (np.abs(x) > EXACT).any(1)
    out = np.zeros((k, x.shape[1] + 1), np.float64)
    member = (clusters[~far, None] == np.arange(k)).astype(np.float64)
    out[:, :-1] = member.T @ x[~far]
    out[:, -1] = member.sum(0)
    exact = out.astype(np.int64).astype(object)
    for c, row in zip(clusters[far].tolist(), _whole(x[far])):
        exact[c, :-1] += row
        exact[c, -1] += 1
    return exact


_MOVES = "moves array<struct<at: int, hi: long, lo: decimal(38,0)>>"
_STATE = f"block long, rows binary, keys binary, sizes array<int>, {_MOVES}"
_MOVE_TYPE = pa.list_(pa.struct([("at", pa.int32()), ("hi", pa.int64()), ("lo", pa.decimal128(38, 0))]))


def _vectors(block: pa.Table, dims: int) -> np.ndarray:
    return np.frombuffer(block["x"][0].as_py(), block["kind"][0].as_py()).astype(np.float64).reshape(-1, dims)


class _Heaps:
    """One heap a cluster of (bound + drift at the time, row)."""

    def __init__(self, k: int, state: pa.Table | None):
        self.heaps: list[list] = [[] for _ in range(k)]
        if state is not None:
            rows = np.frombuffer(state["rows"][0].as_py(), "<i4").tolist()
            entries, at = list(zip(np.frombuffer(state["keys"][0].as_py(), "<f8").tolist(), rows)), 0
            for c, size in enumerate(state["sizes"][0].as_py()):
                self.heaps[c], at = entries[at : at + size], at + size

    def expired(self, drift: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Pop what the drift has passed: rows and the cluster each was in."""
        rows, was = [], []
        for c, heap in enumerate(self.heaps):
            limit = drift[c] * (1 + _SLACK)
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                was.append(c)
        return np.array(rows, np.int64), np.array(was, np.int64)

    def push(self, rows: np.ndarray, clusters: np.ndarray, gaps: np.ndarray, drift: list[float]) -> None:
        keys = gaps + np.array(drift)[clusters] * (1 - _SLACK)
        for c, entry in zip(clusters.tolist(), zip(keys.tolist(), rows.tolist())):
            heapq.heappush(self.heaps[c], entry)

    def state(self) -> dict:
        entries = [e for h in self.heaps for e in h]
        return {"rows": [np.array([e[1] for e in entries], "<i4").tobytes()], "keys": [np.array([e[0] for e in entries], "<f8").tobytes()],
                "sizes": pa.array([list(map(len, self.heaps))], pa.list_(pa.int32()))}

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[e[1] for e in heap]] = c
        return out


def _reassigned(x: np.ndarray, heaps: _Heaps, fresh: bool, centroids, drift) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measure anew what has expired (everything, when fresh): rows, clusters before and after."""
    rows, was = (np.arange(len(x)), np.zeros(len(x), np.int64)) if fresh else heaps.expired(drift)
    now, gaps = nearest(x[rows], centroids)
    heaps.push(rows, now, gaps, drift)
    return rows, was, now


def _moves(x, rows, was, now, k: int, fresh: bool) -> list[dict]:
    changed = np.ones(len(rows), bool) if fresh else was != now
    delta = _sums(now[changed], x[rows[changed]], k)
    if not fresh:
        delta = delta - _sums(was[changed], x[rows[changed]], k)
    at = np.flatnonzero(delta.ravel() != 0)
    cut = [divmod(v, _CUT) for v in delta.ravel()[at].tolist()]
    return [{"at": a, "hi": hi, "lo": Decimal(lo)} for a, (hi, lo) in zip(at.tolist(), cut)]


def _round(centroids, drift, dims: int, fresh: bool):
    k = len(centroids)

    def run(block: pa.Table, state: pa.Table | None) -> pa.Table:
        x, heaps = _vectors(block, dims), _Heaps(k, state)
        moves = _moves(x, *_reassigned(x, heaps, fresh, centroids, drift), k, fresh)
        return pa.table({"block": block["block"].combine_chunks()} | heaps.state() | {"moves": pa.array([moves], _MOVE_TYPE)})

    def first(block: pa.Table) -> pa.Table:
        return run(block, None)

    return first if fresh else run


def _final(centroids, drift, dims: int):
    def run(block: pa.Table, state: pa.Table) -> pa.Table:
        x, heaps = _vectors(block, dims), _Heaps(len(centroids), state)
        _reassigned(x, heaps, False, centroids, drift)
        cluster, distance = heaps.clusters(len(x)), [0] * len(x)
        for c, row in enumerate(centroids):
            own = np.flatnonzero(cluster == c)
            for i, d in zip(own.tolist(), squared(x[own], [row])[:, 0].tolist()):
                distance[i] = int(d) if d < _LONG else None
        return pa.table({"vec_id": pa.array(block["vec_id"][0].as_py(), pa.int64()), "cluster": pa.array(cluster, pa.int32()),
                         "distance": pa.array(distance, pa.int64())})

    return run


def _drifts(old: list[list[int]], new: list[list[int]]) -> list[float]:
    """By how much each cluster's gaps may have shrunk: its own movement and the largest other."""
    moved = [math.sqrt(sum((a - b) ** 2 for a, b in zip(p, q))) * (1 + _SLACK) for p, q in zip(old, new)]
    return [m + max((o for j, o in enumerate(moved) if j != c), default=0.0) for c, m in enumerate(moved)]


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMENSIONS, salt: str = "2:") -> DataFrame:
    """Per kept row of ``vectors`` (vec_id, embedding): cluster, squared distance, that summed over
    the cluster and over all, and the digest of the final centroid. Centroids start as the k
    vectors with the smallest sha256 of ``salt`` and their id."""
    spark, folder = vectors.sparkSession, run_folder(vectors, "centroids")
    buckets = max(1, min(vectors.rdd.getNumPartitions(), 100_000))
    tables = []

    def stored(df: DataFrame) -> DataFrame:
        name = f"skiff_centroids_{uuid.uuid4().hex[:12]}"
        df.write.bucketBy(buckets, "block").option("path", f"{folder}/{name}").saveAsTable(name)
        tables.append(name)
        return spark.table(name)

    try:
        blocks = stored(vector_blocks(vectors, dims, k, salt))
        seeds = blocks.select(F.explode("seeds").alias("s")).select("s.*").orderBy("hash", "at").limit(k).collect()
        if not seeds:
            return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        centroids = [list(map(int, s["at"])) for s in seeds]
        k, drift = len(centroids), [0.0] * len(centroids)
        sums = [[0] * (dims + 1) for _ in centroids]
        by_block, state = blocks.drop("seeds").groupBy("block"), None
        for _ in range(rounds):
            step = _round(centroids, drift, dims, state is None)
            state = stored(by_block.applyInArrow(step, _STATE) if state is None
                           else by_block.cogroup(state.drop("moves").groupBy("block")).applyInArrow(step, _STATE))
            moved = state.select(F.explode("moves").alias("m")).groupBy("m.at").agg(
                F.sum(F.col("m.hi").cast("decimal(38,0)")).alias("hi"), F.sum("m.lo").alias("lo"))
            for r in moved.collect():  # at most k times (components + 1) rows
                sums[r["at"] // (dims + 1)][r["at"] % (dims + 1)] += int(r["hi"]) * _CUT + int(r["lo"])
            new = [[s // row[-1] for s in row[:-1]] if row[-1] else c for row, c in zip(sums, centroids)]
            drift = [d + e for d, e in zip(drift, _drifts(centroids, new))]
            centroids = new
        if state is None:  # no rounds: one assignment to the first centroids
            state = stored(by_block.applyInArrow(_round(centroids, drift, dims, True), _STATE))
        last = by_block.cogroup(state.drop("moves").groupBy("block")).applyInArrow(
            _final(centroids, drift, dims), "vec_id long, cluster int, distance long")
        assigned = written(last, folder, "assigned")
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _with_inertia(assigned, centroids)


def _with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(whole.alias("s")).collect()}  # at most k rows
    fits = lambda v: int(v) if v is not None and v < _LONG else None
    total = fits(None if None in per.values() else sum(per.values()))
    rows = [(c, fits(per.get(c)), total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    own = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMENSIONS, salt: str = "2:") -> str:
    """The same as SQL, every vector measured against every centroid in every round (sums and
    distances in doubles: whole numbers below 2**53)."""
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('{salt}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT v.rid, v.vec_id, v.x, min(CAST(list_inner_product(v.x, v.x) + list_inner_product(c.x, c.x) - 2 * list_inner_product(v.x, c.x) AS BIGINT) * {k} + c.c) AS m
  FROM v, c{r} AS c GROUP BY ALL)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.x, c.x) AS x FROM c{r} AS c LEFT JOIN (
    SELECT c, list(CAST((s - (s % n + n) % n) // n AS DOUBLE) ORDER BY i) AS x FROM (
      SELECT m % {k} AS c, g.i, sum(CAST(x[g.i] AS BIGINT)) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{r}, range(1, {dims + 1}) AS g(i) GROUP BY ALL)
    GROUP BY c) AS n ON n.c = c.c)""")
    return f"""WITH {', '.join(parts)}
SELECT a.vec_id, CAST(a.m % {k} AS INTEGER) AS cluster, a.m // {k} AS distance,
  CAST(sum(a.m // {k}) OVER (PARTITION BY a.m % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(a.m // {k}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON c.c = a.m % {k}"""
