"""Clustering: the search against all distances, rounds against a plain loop."""

import hashlib
import math

import numpy as np
import pytest

from compare import duck, duck_digest, spark_digest
from tagwave.llm import centroids as C
from tagwave.llm.catalog import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, clusters=8, rounds=10, dims=64):
    """The whole operator as a loop over lists."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        groups = [[] for _ in cents]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, cents)]
    out = [(i, near(v)) for i, v in kept]
    per = {}
    for _, (d, k) in out:
        per[k] = per.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, k, d, per[k], sum(per.values()), sha[k]) for i, (d, k) in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("scale, dims, k", [(1000, 64, 8), (3, 4, 8), (1, 2, 5), (C.MAX_COMPONENT, 64, 8), (50, 64, 1),
                                            (200, 16, 100)])
def test_search_equals_all_distances(scale, dims, k):
    rng = np.random.default_rng(scale + dims)
    cents = rng.integers(-scale, scale + 1, (k, dims))
    x = rng.integers(-scale, scale + 1, (3000, dims))
    x[:k] = cents  # distance 0, equal component sums
    if k > 3:
        cents[3] = cents[1]  # equal centroids: the smaller number
    which, distance, computed = C.Search(cents).nearest(x)
    all_d = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (which == all_d.argmin(axis=1)).all() and (distance == all_d.min(axis=1)).all()
    assert computed <= 3000 * k


def test_search_passes_over_centroids():
    """Centroids with far-off means or spreads get no distance."""
    rng = np.random.default_rng(4)
    cents = np.arange(50)[:, None] * 1000 + rng.integers(-20, 20, (50, 64))
    x = cents[rng.integers(0, 50, 2000)] + rng.integers(-30, 30, (2000, 64))
    *_, computed = C.Search(cents).nearest(x)
    assert computed < 2000 * 3
    flat = np.zeros((20, 64), dtype=np.int64)  # equal means, different spreads
    flat[:, ::2], flat[:, 1::2] = np.arange(20)[:, None] * 500, -np.arange(20)[:, None] * 500
    *_, computed = C.Search(flat).nearest(flat[rng.integers(0, 20, 2000)] + rng.integers(-1, 2, (2000, 64)) * 0)
    assert computed < 2000 * 12


def vectors(n, seed=0, dims=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.3, (5, dims))
    return [(i, (middle[i % 5] + rng.normal(0, 0.1, dims)).astype(np.float32).tolist()) for i in range(n)]


def test_rounds_equal_plain_loop(spark):
    rows = vectors(300)
    odd = [(1000, None), (1001, [0.0] * 63), (1002, [0.0] * 65), (1003, [float("nan")] + [0.0] * 63), (1004, []),
           (1005, [float("inf")] + [0.0] * 63), (1006, [None] + [0.0] * 63), (1007, [-0.0] * 64),
           (1008, [16384.0] + [-16384.0] * 63), (None, [0.5] * 64), (None, [0.25] * 64), rows[0], rows[0], (7, [9.0] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA).repartition(5)
    clash = df.selectExpr("*", "1 as cluster", "'x' as v", "2 as distance")
    assert got(C.cluster_vectors(clash)) == plain(rows + odd)


def test_hot_vector_and_ties(spark):
    rows = [(i, [0.5] * 64) for i in range(200)] + vectors(60, 2)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    assert got(C.cluster_vectors(df)) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = vectors(n, 3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert got(C.cluster_vectors(df)) == plain(rows)


def test_general_parameters(spark):
    rows = vectors(80, 5, dims=6)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert got(C.cluster_vectors(df, clusters=3, rounds=4, dims=6)) == plain(rows, 3, 4, 6)


def test_too_large_component_is_an_error(spark):
    df = spark.createDataFrame([(1, [20_000.0] * 64, 0)], SCHEMA)
    with pytest.raises(Exception, match="do not fit 64 bits"):
        C.cluster_vectors(df).collect()


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_digest(QUERIES["op12_centroid_clustering"](spark, sf)) == duck_digest(duck(sf), C.ORACLE_SQL)
