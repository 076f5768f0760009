"""Approximate nearest neighbours by learned partitions.

From a bounded sample: its exact neighbour graph is cut into balanced parts (spectral bisection, repeated, then
swaps across the cut), and a small classifier learns, from a vector, the parts of its neighbours. Every row of the
table is indexed under its most probable part; a query goes to its several most probable parts, and their rows are
ranked by exact cosine. How many parts a query probes is the least number that finds ``recall`` of the true
neighbours of sample rows.

Parts are cut into blocks of rows and queries into blocks of queries, each sized by counts, so no task holds a part;
each pair of blocks gives a query's best few, and those are ranked again per query.

Defined cases: a vector takes no part if it or its id is null, if it is zero, has null or non-finite components, or
another length than most sampled vectors; rows with one id count once, with the smallest vector; equal scores go to
the smaller id; a table with fewer candidates returns all of them; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.llm.common import thinned
from strataline.llm.langid import softmax
from strataline.session import stage


@dataclass(frozen=True)
class Index:
    """Parameters: ``sample`` bounds the vectors that reach the driver, ``parts`` the size of the classifier."""

    sample: int = 8192
    parts: int = 16
    least_part: int = 64
    graph: int = 10
    hidden: int = 96
    steps: int = 1500
    batch: int = 256
    rate: float = 0.005
    recall: float = 0.95
    judged: int = 1024
    block: int = 4096
    seed: int = 3


@dataclass(frozen=True)
class Router:
    """The classifier, and the number of parts that a query probes."""

    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    probes: int
    dim: int

    def probabilities(self, unit: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return softmax(np.maximum(unit @ a + b, 0) @ c + d)


def nearest(unit: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """For each of ``rows`` the k nearest others, by blocks."""
    out = np.empty((len(rows), k), dtype=np.int64)
    for at in range(0, len(rows), 512):
        part = rows[at : at + 512]
        score = unit[part] @ unit.T
        score[np.arange(len(part)), part] = -2
        out[at : at + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A part for each row of a neighbour graph; parts differ by at most a few rows."""
    label = np.zeros(len(graph), dtype=np.int64)

    def split(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            label[rows] = first
            return
        here = np.full(len(graph), -1)
        here[rows] = np.arange(len(rows))
        near = here[graph[rows]]
        src, dst = np.nonzero(near >= 0)[0], near[near >= 0]
        src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
        degree = np.bincount(src, minlength=len(rows)) + 1.0
        x = rng.normal(size=len(rows))
        for _ in range(60):  # the slowest mode of averaging over neighbours
            x = (x + np.bincount(src, weights=x[dst], minlength=len(rows))) / degree
            x -= (x * degree).sum() / degree.sum()
            x /= np.linalg.norm(x) + 1e-30
        left = count // 2
        side = np.ones(len(rows), dtype=bool)
        side[np.argsort(x, kind="stable")[: len(rows) * left // count]] = False
        for _ in range(8):  # swap the rows that gain most on the other side
            own = np.bincount(src, weights=side[src] == side[dst], minlength=len(rows))
            gain = degree - 1 - 2 * own
            a = np.flatnonzero(~side)[np.argsort(-gain[~side], kind="stable")]
            b = np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")]
            n = min(len(a), len(b))
            swaps = int((gain[a[:n]] + gain[b[:n]] > 2).sum()) // 2
            if not swaps:
                break
            side[a[:swaps]], side[b[:swaps]] = True, False
        split(rows[~side], first, left)
        split(rows[side], first + left, count - left)

    split(np.arange(len(graph)), 0, parts)
    return label


def fit(vectors: np.ndarray, index: Index, k: int = 5) -> Router:
    """Partition the sample's graph, train the classifier and choose the number of probes."""
    rng = np.random.default_rng(index.seed)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    n, dim = unit.shape
    parts = max(1, min(index.parts, n // index.least_part))
    if parts == 1:
        flat = (np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
        return Router(flat, 1, dim)
    graph = nearest(unit, np.arange(n), index.graph)
    label = balanced_parts(graph, parts, rng)
    # The target of a row: where it and its neighbours lie.
    target = np.zeros((n, parts))
    np.add.at(target, (np.arange(n)[:, None], label[graph]), 1.0)
    target[np.arange(n), label] += index.graph / 2
    target /= target.sum(axis=1, keepdims=True)
    p = [rng.normal(0, dim**-0.5, (dim, index.hidden)), np.zeros(index.hidden), rng.normal(0, index.hidden**-0.5, (index.hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, index.steps + 1):
        pick = rng.integers(n, size=index.batch)
        x = unit[pick]
        h = np.maximum(x @ p[0] + p[1], 0)
        d = (softmax(h @ p[2] + p[3]) - target[pick]) / index.batch
        back = (d @ p[2].T) * (h > 0)
        for w, g, m, v in zip(p, (x.T @ back, back.sum(0), h.T @ d, d.sum(0)), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= index.rate * (1 - step / (index.steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    router = Router(tuple(p), parts, dim)
    probability = router.probabilities(unit)
    home = probability.argmax(axis=1)
    judged = rng.permutation(n)[: index.judged]
    true = nearest(unit, judged, min(k, n - 1))
    place = np.argsort(np.argsort(-probability[judged], axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, home[true], axis=1)
    found = [(needed < m).mean() for m in range(1, parts + 1)]
    probes = next(m for m, share in enumerate(found, 1) if share >= index.recall)
    return Router(tuple(p), probes, dim)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Id and vector, as doubles, of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(finite & F.exists("vector", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, index: Index = Index(), id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest found of every row that ``is_query``, an expression over vec_id: query_id, rank, vec_id, score."""
    rows = stage(usable(vectors, id_col, vec_col), "vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    total = rows.count()
    at = F.xxhash64("vec_id")
    sample = (
        rows.filter(thinned(at, index.sample, total)).select("vector", at.alias("at")).orderBy("at").limit(index.sample).collect()
    )
    out = f"query_id {kind}, vec_id {kind}, score double"
    if not sample:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    sizes = [len(r["vector"]) for r in sample]
    dim = max(sorted(set(sizes)), key=sizes.count)
    router = fit(np.array([r["vector"] for r in sample if len(r["vector"]) == dim]), index, k)
    rows = rows.filter(F.size("vector") == dim)

    def routed(batches):
        for part in batches:
            v = np.stack(part["vector"].to_numpy())
            order = np.argsort(-router.probabilities(v / np.linalg.norm(v, axis=1, keepdims=True)), axis=1, kind="stable")
            yield part.assign(parts=list(order[:, : router.probes].astype(np.int32)))

    placed = stage(rows.mapInPandas(routed, f"vec_id {kind}, vector array<double>, parts array<int>"), "placed")
    queries = placed.filter(is_query)
    query_blocks = max(1, -(-queries.count() // index.block))
    part_blocks = placed.groupBy(F.col("parts")[0].alias("part")).agg(
        F.ceil(F.count(F.lit(1)) / index.block).cast("int").alias("blocks")
    )  # one row per part
    salt = F.xxhash64("vec_id", F.lit("block"))
    base = (
        placed.select("vec_id", "vector", F.col("parts")[0].alias("part"))
        .join(F.broadcast(part_blocks), "part")
        .select(
            "vec_id",
            "vector",
            "part",
            F.pmod(salt, "blocks").cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        )
    )
    asked = (
        queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.pmod(salt, F.lit(query_blocks)).cast("int").alias("query_block"), F.explode("parts").alias("part"))
        .join(F.broadcast(part_blocks), "part")
        .select("query_id", "query", "part", "query_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    )

    def ranked(asked: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or base.empty:
            return pd.DataFrame({"query_id": asked["query_id"][:0], "vec_id": base["vec_id"][:0], "score": np.zeros(0)})
        base = base.sort_values("vec_id", ignore_index=True)
        q, b = np.stack(asked["query"].to_numpy()), np.stack(base["vector"].to_numpy())
        q_id, b_id = asked["query_id"].to_numpy(), base["vec_id"].to_numpy()
        q_norm, b_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        found = []
        for i in range(len(q)):
            rough = (b @ q[i]) / (b_norm * q_norm[i])
            rough[b_id == q_id[i]] = -np.inf
            take = min(k, len(rough))
            floor = np.partition(rough, len(rough) - take)[len(rough) - take]
            # Scores are summed the same way for every pair, so equal vectors tie exactly.
            near = np.flatnonzero((rough >= floor - 1e-9) & (rough > -np.inf))
            score = (b[near] * q[i]).sum(axis=1) / (b_norm[near] * q_norm[i])
            best = np.lexsort((b_id[near], -score))[:k]
            found.append(pd.DataFrame({"query_id": q_id[i], "vec_id": b_id[near][best], "score": score[best]}))
        return pd.concat(found, ignore_index=True)

    keys = ["part", "block", "query_block"]
    found = asked.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInPandas(ranked, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
