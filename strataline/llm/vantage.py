"""Centroid clustering (Lloyd's rounds) over integer vectors, each vector searching a vantage-point tree of centroids.

Components become integers first, so distances, sums and means are exact and every order of summing gives the same
centroids. Each round the driver rebuilds the tree over the centroids and broadcasts it. A vector searches best
first: of the tree's open nodes it takes the one with the least lower bound, and stops once that bound is above its
best distance. The bound is inclusive, with room for rounding, so equally near centroids are all seen and the
smaller number wins; distances to vantage points and in leaves are exact integers. All vectors of a batch search at
once: a matrix holds every vector's open nodes, and vectors at the same node are measured together.

A task sums its vectors by cluster, so the driver gets one row of sums for each cluster and task's share, added by Spark.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no part, nor do
those with a component outside of +-2**19, whose squared distances are beyond a long; repeated rows count as often as
they occur; a row without an id counts, and is a first centroid only if too few others are there; fewer vectors than
``k`` give as many centroids as vectors; a cluster without vectors keeps its centroid; no vectors give no rows;
inertia beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.session import control_table, stage

SCALE = 256
LIMIT = 1 << 19
LEAF = 4
# Vectors that search together.
BATCH = 4096


@dataclass
class Tree:
    """Nodes 0.. in order of creation. A node has a vantage centroid and two children, or is a leaf of centroids."""

    points: np.ndarray
    vantage: list[int] = field(default_factory=list)
    members: list[np.ndarray | None] = field(default_factory=list)
    # Per child: its node, and the least and largest distance of its centroids from the vantage point.
    children: list[list[tuple[int, float, float]]] = field(default_factory=list)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` and ``b``, as long integers."""
    most = int(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)))
    if 4 * a.shape[1] * most * most < 1 << 53:  # floating-point products and sums are exact integers then
        a, b = a.astype(np.float64), b.astype(np.float64)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """A vantage-point tree: the point farthest from a node's first one splits the others at the median distance."""
    tree = Tree(points)

    def add(members: np.ndarray) -> int:
        node = len(tree.vantage)
        tree.vantage.append(-1)
        tree.members.append(None)
        tree.children.append([])
        if len(members) <= leaf:
            tree.members[node] = np.sort(members)
            return node
        from_first = squared(points[members[:1]], points[members])[0]
        vantage = members[int(from_first.argmax())]
        others = members[members != vantage]
        far = np.sqrt(squared(points[[vantage]], points[others])[0].astype(np.float64))
        order = np.argsort(far, kind="stable")
        tree.vantage[node] = int(vantage)
        for half in np.array_split(order, 2):
            if len(half):
                tree.children[node].append((add(others[half]), float(far[half].min()), float(far[half].max())))
        return node

    if len(points):
        add(np.arange(len(points)))
    return tree


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared distance of each vector's nearest centroid; of equally near ones the smallest number."""
    n = len(vectors)
    best = np.full(n, np.iinfo(np.int64).max)
    which = np.full(n, len(tree.points), dtype=np.int64)
    bounds = np.full((n, len(tree.vantage)), np.inf)
    bounds[:, 0] = 0.0
    active = np.arange(n)

    def better(rows: np.ndarray, number: np.ndarray, far: np.ndarray) -> None:
        won = (far < best[rows]) | ((far == best[rows]) & (number < which[rows]))
        best[rows[won]], which[rows[won]] = far[won], number[won]

    while len(active):
        open_ = bounds[active]
        node = open_.argmin(1)
        low = open_[np.arange(len(active)), node]
        # Inclusive, and wider than any rounding of the roots and bounds.
        reach = np.sqrt(best[active].astype(np.float64)) * (1 + 1e-9) + 1e-6
        going = np.isfinite(low) & (low <= reach)
        active, node = active[going], node[going]
        bounds[active, node] = np.inf
        for at in np.unique(node):
            rows = active[node == at]
            if tree.members[at] is not None:
                members = tree.members[at]
                far = squared(vectors[rows], tree.points[members])
                least = far.argmin(1)  # the first of equal ones, and members ascend
                better(rows, members[least], far[np.arange(len(rows)), least])
                continue
            vantage = tree.vantage[at]
            far = squared(vectors[rows], tree.points[[vantage]])[:, 0]
            better(rows, np.full(len(rows), vantage), far)
            root = np.sqrt(far.astype(np.float64))
            for child, lo, hi in tree.children[at]:
                bounds[rows, child] = np.maximum(0.0, np.maximum(root - hi, lo - root))
    return which, best


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, dim)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def integers(vectors: DataFrame, dim: int, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors that take part, with components floor(scale * x)."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT)

    of = F.transform(vector_col, lambda x: x.cast("double"))
    kept = vectors.select(F.col(id_col), of.alias("_x")).filter((F.size("_x") == dim) & F.forall("_x", usable))
    return kept.select(id_col, F.transform("_x", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, salt: str, id_col: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes, in that order; at most k rows reach the driver."""
    hashed = F.sha2(F.concat(F.lit(salt), F.col(id_col).cast("string")), 256)
    rows = kept.select(hashed.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def _sums(kept: DataFrame, tree: Broadcast, dim: int) -> DataFrame:
    """Per cluster with vectors: their number and the sums of their components."""
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.value.points)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for batch in _parts(batches):
            v = _vectors(batch, dim)
            cluster, _ = nearest(tree.value, v)
            order = np.argsort(cluster, kind="stable")
            numbers, starts = np.unique(cluster[order], return_index=True)
            count += np.bincount(cluster, minlength=k)
            total[numbers] += np.add.reduceat(v[order], starts, axis=0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.array(total[held].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    made = kept.select("v").mapInArrow(run, schema)
    added = made.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dim)])
    return added.select("cluster", "n", F.array(*[f"s{i}" for i in range(dim)]).alias("total"))


def _assigned(kept: DataFrame, tree: Broadcast, dim: int, id_col: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(id_col, kept.schema[id_col].dataType),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            cluster, far = nearest(tree.value, _vectors(batch, dim))
            columns = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.select(id_col, "v").mapInArrow(run, schema)


def cluster(
    vectors: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    leaf: int = LEAF,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that takes part, and the final centroids."""
    spark = vectors.sparkSession
    kept = stage(integers(vectors, dim, id_col, vector_col), "vectors")
    centroids = first_centroids(kept, k, salt, id_col).reshape(-1, dim)
    for _ in range(rounds if len(centroids) else 0):
        tree = spark.sparkContext.broadcast(build(centroids, leaf))
        moved = centroids.copy()
        for row in _sums(kept, tree, dim).collect():  # at most k rows
            moved[row["cluster"]] = [s // row["n"] for s in row["total"]]
        centroids = moved
    tree = spark.sparkContext.broadcast(build(centroids, leaf))
    return _assigned(kept if len(centroids) else kept.limit(0), tree, dim, id_col), centroids


def report(assigned: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """The assignment with inertia of the cluster and of all, and a digest of the cluster's centroid."""
    spark = assigned.sparkSession
    placed = stage(assigned, "assigned")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own")).collect()  # at most k rows
    inertia = {r["cluster"]: int(r["own"]) for r in sums}
    register = [
        (i, _long(inertia.get(i, 0)), _long(sum(inertia.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    of = control_table(
        assigned.sparkSession, register, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(of), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
