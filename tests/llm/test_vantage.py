"""Centroid clustering over a vantage-point tree against plain Python."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from strataline.llm import vantage
from strataline.llm.queries import op13_centroids

SF = "/root/testdata/sf0.001"


def plain(rows, k: int, rounds: int, dim: int) -> list[tuple]:
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dim and all(c is not None and math.isfinite(c) and abs(c) < vantage.LIMIT for c in x):
            kept.append((vec_id, [math.floor(256 * float(c)) for c in x]))
    hashed = [("~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept]
    centroids = [v for _, v in sorted(hashed)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    own: dict[int, int] = {}
    for _, j, d in placed:
        own[j] = own.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, own[j], sum(own.values()), digest[j]) for i, j, d in placed), key=repr)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows_of(op13_centroids(spark, SF)) == plain(rows, 40, 5, 64)


@pytest.mark.parametrize(("dim", "k", "spread"), [(3, 40, 2), (2, 200, 30), (64, 40, 2000), (5, 17, 1 << 26)])
def test_tree_finds_what_brute_force_finds(dim, k, spread):
    """Small grids are full of equal distances, repeated centroids and vectors on them."""
    rng = np.random.default_rng(dim)
    centroids, vectors = rng.integers(-spread, spread, (k, dim)), rng.integers(-spread, spread, (3000, dim))
    vectors[:k] = centroids
    far = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    for leaf in (1, 4, k):
        which, best = vantage.nearest(vantage.build(centroids, leaf), vectors)
        assert (which == far.argmin(1)).all() and (best == far.min(1)).all()


def test_most_nodes_are_never_opened_where_vectors_cluster():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-(10**5), 10**5, (256, 8))
    measured = 0
    of = vantage.squared

    def counted(a, b):
        nonlocal measured
        measured += len(a) * len(b)
        return of(a, b)

    tree = vantage.build(centroids)
    vantage.squared = counted
    try:
        vantage.nearest(tree, np.repeat(centroids, 20, axis=0) + rng.integers(-500, 500, (5120, 8)))
    finally:
        vantage.squared = of
    assert measured < 0.5 * 5120 * 256


VEC = "vec_id long, embedding array<double>, cluster string, distance string, v string"
nan, inf = float("nan"), float("inf")
ROWS = [
    (None, None), (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [1.0, inf]), (7, [1.0, 1e300]),
    (8, [0.0, 0.0]), (8, [0.0, 0.0]), (9, [0.25, -0.25]), (None, [0.1, 0.2]), (10, [1.0, 2.0, 3.0]), (11, [-0.001, 500000.0]),
    (12, [0.0, 0.001]), (13, [0.003, 0.0]),
]


def test_edge_cases(spark):
    odd = spark.createDataFrame([(*r, "x", None, "x") for r in ROWS], VEC)
    for k in (2, 3, 40):
        got = vantage.report(*vantage.cluster(odd, k=k, rounds=3, dim=2))
        assert rows_of(got) == plain(ROWS, k, 3, 2)
    for none in (odd.limit(0), odd.filter("vec_id < 8")):
        assert vantage.report(*vantage.cluster(none, k=3, dim=2)).count() == 0


def test_repeated_rows_count_as_often_as_they_occur(spark):
    rows = [(i % 7, [float(i % 7), float(i % 3)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert rows_of(vantage.report(*vantage.cluster(df, k=4, rounds=4, dim=2))) == plain(rows, 4, 4, 2)
