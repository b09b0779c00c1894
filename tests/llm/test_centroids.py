"""Clustering against a plain Lloyd loop over Python integers."""

import hashlib
import math

import numpy as np
import pytest

from skiff.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, block int, distance string"


def plain_lloyd(rows, k, rounds, dims):
    """(vec_id, cluster, distance, inertia of the cluster, of all, digest) of each kept row."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept))
    centers = [v for _, v in order[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)) for _, v in kept]
    for _ in range(rounds):
        own = [n for _, n in assign()]
        for n in range(len(centers)):
            members = [v for (_, v), c in zip(kept, own) if c == n]
            if members:
                centers[n] = [sum(col) // len(members) for col in zip(*members)]
    last = assign()
    per = {n: sum(d for d, m in last if m == n) for _, n in last}
    fits = lambda v: v if v < 1 << 63 else None
    return [(i, n, fits(d), fits(per[n]), fits(sum(per.values())), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest())
            for (i, _), (d, n) in zip(kept, last)]


def check(spark, rows, k, rounds, dims):
    table = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in centroids.cluster(table, k, rounds, dims).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(plain_lloyd(rows, k, rounds, dims), key=key)
    return got


def test_equals_plain_lloyd(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 64)
    r = np.random.default_rng(5)
    middles = r.normal(size=(7, 6))
    rows = [(int(i), (middles[i % 7] + 0.3 * r.normal(size=6)).tolist()) for i in range(400)]
    check(spark, rows, 9, 5, 6)
    check(spark, rows[:50], 9, 0, 6)


def test_ties_copies_and_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), float(i % 2)]) for i in range(40)]  # few distinct vectors: equal centroids, ties, empty clusters
    rows += [(5, [1.0, 1.0]), (5, [9.0, 1.0]), (None, [2.0, 0.0]), (90, None), (91, []), (92, [1.0]), (93, [1.0, None]), (94, [nan, 1.0]),
             (95, [inf, 0.0]), (96, [0.0, 0.0]), (97, [1.0, 2.0, 3.0])]
    got = check(spark, rows, 8, 5, 2)
    assert len(got) == 44


@pytest.mark.parametrize("large", [4e4, 1e9, 1e30])
def test_components_beyond_exact_doubles(spark, large):
    rows = [(i, [i * 0.37, large if i % 5 == 0 else -i * 0.11]) for i in range(30)]
    check(spark, rows, 4, 4, 2)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, [(1, [0.5, 0.25])], 40, 5, 2)
    check(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.7, 0.0])], 40, 5, 2)
    empty = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster(empty, 4, 2, 2).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, [1.0], "x", 1, "y")], SCHEMA), 4, 2, 2).count() == 0


def test_only_expired_vectors_are_measured(monkeypatch):
    """Well separated groups: after the first round hardly any vector is measured again."""
    r = np.random.default_rng(1)
    x = np.floor(256 * (10 * np.repeat(np.eye(4), 50, 0) + 0.01 * r.normal(size=(200, 4))))
    centers = [x[k * 50].astype(int).tolist() for k in range(4)]
    heaps = centroids._Heaps(4, None)
    rows, _, _ = centroids._reassigned(x, heaps, True, centers, [0.0] * 4)
    assert len(rows) == 200
    rows, _, _ = centroids._reassigned(x, heaps, False, centers, [5.0] * 4)
    assert len(rows) == 0
    rows, _, _ = centroids._reassigned(x, heaps, False, centers, [5.0, 1e9, 5.0, 5.0])
    assert len(rows) == 50


def test_no_tables_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    check(spark, [(i, [i * 0.5]) for i in range(20)], 3, 2, 1)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_op11_equals_its_sql(spark):
    from oracle_util import compare, duck

    from skiff.llm.queries import ORACLES, op11_centroids

    sf = "/root/testdata/sf0.01"
    result = compare(spark, duck(sf), "op11_centroids", op11_centroids(spark, sf), ORACLES["op11_centroids"])
    assert result["ok"] and result["spark_rows"] == 500, result
