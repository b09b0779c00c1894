"""Approximate nearest neighbours over balanced posting lists.

Centroids come from balanced k-means on a bounded sample (an assignment pays for a list's
load, so lists stay near one size, LIST vectors or more). They are searched through an in-memory graph: each
centroid is linked to its nearest ones, a batch of vectors walks the graph best-first. A
vector near a boundary is replicated to up to REPLICAS lists: the next centroids join while their
distance stays within CLOSURE of the nearest and no list already chosen is closer to them
than the vector is. A query reads the lists whose centroid distance is within RATIO of
its nearest centroid's, PROBES at most and FEWEST at least; lists are dealt out in slices of SLICE vectors, so a
hot list is many tasks.

Equal vectors are one entry: only the smallest TOP + 1 ids of each can ever appear in a
result, so a vector that a third of all rows share costs one entry (an exact reduction, no
cap). Equal query vectors are searched once.

Distances are Euclidean in double precision on the original vectors; ties go to the smaller
id. Vectors that are null, zero, or hold null or non-finite components take no part, nor do
rows without an id. Distances need one length: the most frequent one (ties: the smaller),
vectors of another take no part. Fewer candidates than TOP give all that the probed lists
hold. A repeated id counts once, with its smallest vector (compared component by component).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skiff.llm.common import prepare

TOP = 10
#: Vectors that centroids are fitted on, and their bytes at most (they pass through the driver).
SAMPLE, SAMPLE_BYTES = 32_768, 64 << 20
#: Vectors a list should hold at least; at most LISTS lists (their centroids are broadcast: LISTS x dimension doubles).
LIST, LISTS = 64, 4_096
REPLICAS, CLOSURE = 4, 1.15
PROBES, FEWEST, RATIO = 176, 16, 1.5
SLICE = 4_096
GROUP = 32
DEGREE, BEAM = 24, 64


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """k-means whose assignment pays for a list's load relative to an even share."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    load = np.full(k, len(x) / k)
    for _ in range(rounds):
        own = np.empty(len(x), np.int64)
        for a in range(0, len(x), 4096):
            d = _square(x[a : a + 4096], c)
            own[a : a + 4096] = (d + d.min(1).mean() * 0.25 * (load * k / len(x) - 1)[None, :]).argmin(1)
        load = np.bincount(own, minlength=k).astype(float)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c[load > 0] = sums[load > 0] / load[load > 0, None]
        empty = np.flatnonzero(load == 0)
        c[empty] = x[rng.choice(len(x), len(empty))]
    return c


class CentroidGraph:
    """Centroids with links to their nearest ones; searched best-first, a batch at once."""

    def __init__(self, centroids: np.ndarray, usual: float = 0.0, degree: int = DEGREE):
        self.c, self.usual = centroids, usual  # usual: mean squared distance to the nearest centroid
        k = len(centroids)
        degree = min(degree, k - 1)
        near = np.empty((k, degree), np.int64)
        for a in range(0, k, 1024):
            d = _square(centroids[a : a + 1024], centroids)
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            near[a : a + 1024] = np.argpartition(d, degree - 1, 1)[:, :degree] if degree else near[a : a + 1024]
        # a few far links, so that no part of the graph is out of reach
        far = np.random.default_rng(1).integers(0, k, (k, 4))
        back = np.argsort(near.ravel(), kind="stable")[: k * degree]
        source = np.repeat(np.arange(k), degree)[back]
        target = near.ravel()[back]
        slot = np.arange(len(target)) - np.searchsorted(target, target)
        reverse = np.repeat(np.arange(k)[:, None], degree, 1)
        ok = slot < degree
        reverse[target[ok], slot[ok]] = source[ok]
        self.links = np.concatenate([near, reverse, far], 1)
        starts = min(k, 64)
        self.entry = np.linspace(0, k - 1, starts).astype(np.int64)

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) of the ``width`` best found for each row, nearest first."""
        k, n = len(self.c), len(x)
        width = min(width, k)
        beam = min(k, max(width, BEAM))
        rows = np.arange(n)[:, None]
        found = np.full((n, k), np.inf)  # distances seen so far; a bounded number of centroids
        opened = np.zeros((n, k), bool)
        found[:, self.entry] = _square(x, self.c[self.entry])
        for _ in range(beam):
            best = np.argpartition(found, beam - 1, 1)[:, :beam] if beam < k else np.tile(np.arange(k), (n, 1))
            d = np.where(opened[rows, best] | ~np.isfinite(found[rows, best]), np.inf, found[rows, best])
            take = min(8, beam)
            pick = np.argpartition(d, take - 1, 1)[:, :take] if take < beam else np.tile(np.arange(beam), (n, 1))
            live = np.isfinite(d[rows, pick])
            if not live.any():
                break
            node = best[rows, pick]
            r, m = np.nonzero(live)
            opened[r, node[r, m]] = True
            to = self.links[node[r, m]]
            rr = np.repeat(r, to.shape[1])
            tt = to.ravel()
            new = ~np.isfinite(found[rr, tt])
            rr, tt = rr[new], tt[new]
            key = np.unique(rr * k + tt)
            rr, tt = key // k, key % k
            found[rr, tt] = ((x[rr] - self.c[tt]) ** 2).sum(1)
        order = np.argsort(found, axis=1, kind="stable")[:, :width]
        return order, found[rows, order]

    def replicas(self, x: np.ndarray) -> list[np.ndarray]:
        """Lists of each vector: the nearest one, then close ones that no chosen list is closer to."""
        ids, d = self.search(x, 4 * REPLICAS)
        out = []
        for i, sq in zip(ids, d):
            chosen = [int(i[0])]
            for j, s in zip(i[1:], sq[1:]):
                if len(chosen) == REPLICAS or not s <= CLOSURE**2 * sq[0]:
                    break
                if (((self.c[chosen] - self.c[j]) ** 2).sum(1) > s).all():
                    chosen.append(int(j))
            out.append(np.array(chosen))
        return out

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """Lists a query reads: within RATIO of its nearest centroid's distance (or of the usual
        one, for a query that lies on a centroid), PROBES at most, FEWEST at least."""
        ids, d = self.search(x, PROBES)
        near = np.isfinite(d) & ((d <= RATIO**2 * np.maximum(d[:, :1], self.usual)) | (np.arange(d.shape[1]) < FEWEST))
        return [i[ok] for i, ok in zip(ids, near)]


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v as doubles."""
    v = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .where("vec_id is not null and v is not null and size(v) > 0")
        .where(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
        .where(F.exists("v", lambda e: e != 0))
    )


def search(rows: DataFrame, query_filter, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's nearest other rows of ``rows``
    (vec_id, embedding). ``query_filter``: which vec_id are queries (a column condition)."""
    spark = prepare(rows.sparkSession)
    points = valid_vectors(rows)
    lengths = points.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    usual_length = lengths.orderBy(F.desc("n"), "size").first()
    if usual_length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = usual_length["size"], usual_length["n"]
    points = points.where(F.size("v") == size)
    draws = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * size)))
    drawn = points.select("v", F.xxhash64("vec_id").alias("o"), "vec_id").orderBy("o", "vec_id").limit(draws).select("v").toPandas()["v"]
    sample = np.unique(np.array(drawn.tolist()), axis=0)
    # lists grow with the square root of the rows once they are full, so that neither the search for
    # lists nor the reading of lists outgrows the other
    k = int(min(max(1, total // LIST), max(1, 2 * total**0.5), LISTS, max(1, len(sample) // 4)))
    centroids = balanced_centroids(sample, k)
    centroids = centroids[np.argsort(centroids @ np.linalg.svd(centroids - centroids.mean(0), full_matrices=False)[2][0], kind="stable")]
    usual = float(np.mean([_square(sample[a : a + 4096], centroids).min(1).mean() for a in range(0, len(sample), 4096)]))
    graph = spark.sparkContext.broadcast(CentroidGraph(centroids, usual))

    # equal vectors: one entry with its smallest ids, ranked in two steps so that no group meets whole
    near = Window.partitionBy("v", "salt").orderBy("vec_id")
    points = points.groupBy("vec_id").agg(F.min("v").alias("v"))
    entry = (
        points.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
        .withColumn("r", F.row_number().over(near)).where(F.col("r") <= top + 1)
        .withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= top + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    wanted = points.where(query_filter)
    asked = wanted.groupBy("v").agg(F.min("vec_id").alias("ask"))

    def assign(how):
        def run(frames):
            for f in frames:
                if len(f):
                    x = np.array(f["v"].tolist())
                    lists = [m for a in range(0, len(x), 512) for m in getattr(graph.value, how)(x[a : a + 512])]
                    n = [len(m) for m in lists]
                    g = f.loc[f.index.repeat(n)].copy()
                    g["list"] = np.concatenate(lists).astype(np.int64)
                    yield g
        return run

    posted = entry.mapInPandas(assign("replicas"), "v array<double>, ids array<long>, list long")
    sizes = posted.groupBy("list").agg(F.ceil(F.count("*") / SLICE).cast("long").alias("slices"))  # a row a list
    posted = posted.join(F.broadcast(sizes), "list").withColumn("slice", F.expr("pmod(xxhash64(v), slices)"))
    probing = (
        asked.mapInPandas(assign("probes"), "v array<double>, ask long, list long")
        .join(F.broadcast(sizes), "list").withColumn("slice", F.explode(F.expr("sequence(0L, slices - 1)")))
    )

    # neighbouring lists make a group: a query gets one short answer from a group, not from each list
    near_lists = F.expr(f"list div {GROUP}").alias("group")

    def compare(left, right):
        """Nearest entries of each query over a group of lists, each list with the queries that read it."""
        out = [pd.DataFrame({"ask": np.zeros(0, np.int64), "score": np.zeros(0), "vec_id": np.zeros(0, np.int64)})]
        asking = dict(iter(right.groupby("list")))
        for number, part in left.groupby("list"):
            if number not in asking:
                continue
            x, y = np.array(part["v"].tolist()), np.array(asking[number]["v"].tolist())
            ask, ids = asking[number]["ask"].to_numpy(), part["ids"].tolist()
            owner, flat = np.repeat(np.arange(len(x)), [len(i) for i in ids]), np.concatenate(ids)
            order = np.argsort(flat, kind="stable")  # then a stable sort by distance leaves ties in order of id
            owner, flat = owner[order], flat[order]
            step = max(1, (1 << 21) // x.size)
            for a in range(0, len(y), step):
                d = np.sqrt(((y[a : a + step, None, :] - x[None, :, :]) ** 2).sum(2))[:, owner]
                best = np.argsort(d, axis=1, kind="stable")[:, : top + 1]
                out.append(pd.DataFrame({
                    "ask": np.repeat(ask[a : a + step], best.shape[1]),
                    "score": np.take_along_axis(d, best, 1).ravel(), "vec_id": flat[best].ravel()}))
        merged = pd.concat(out).drop_duplicates(["ask", "vec_id"]).sort_values(["ask", "score", "vec_id"])
        return merged.groupby("ask").head(top + 1)

    found = (
        posted.select(near_lists, "list", "slice", "v", "ids").groupBy("group", "slice")
        .cogroup(probing.select(near_lists, "list", "slice", "v", "ask").groupBy("group", "slice"))
        .applyInPandas(compare, "ask long, score double, vec_id long").distinct()
        .withColumn("r", F.row_number().over(Window.partitionBy("ask").orderBy("score", "vec_id"))).where(F.col("r") <= top + 1)
    )
    answers = found.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    return (
        wanted.join(asked, "v").select(F.col("vec_id").alias("query_id"), "ask").join(answers, "ask")
        .withColumn("best", F.expr(f"slice(filter(best, x -> x.vec_id != query_id), 1, {top})"))
        .select("query_id", F.posexplode("best").alias("p", "x"))
        .select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
    )
