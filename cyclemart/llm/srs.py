"""Approximate nearest neighbours by low-dimensional stable projections (SRS, Sun et al. 2014).

Vectors are projected on a few Gaussian directions; for a pair at distance d the squared
projected distance is d**2 times a chi-square variable.  A kd-tree indexes the projected
points.  A query takes its projected neighbours in ascending order, verifies each by the
true distance, and stops when a point as near as its k-th best would, with probability
``CONFIDENCE``, already have been met: ``chi2_cdf(r**2 / d_k**2) >= CONFIDENCE``.

Vectors are dealt over blocks of at most ``BLOCK_ROWS`` by a hash of the id; every block
has its own tree and answers all queries, in blocks of ``BLOCK_QUERIES``; the best k of
the blocks' answers are the result.  Equal vectors of a block are one point of its tree,
so a vector that holds a third of all rows costs one verification.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components
take no part, neither as queries nor as candidates; candidates of a query are the vectors
of its own length; ties in distance go to the smaller id; rows with a NULL id take no
part; of rows that repeat an id each counts, but none is a neighbour of its own id; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DIRECTIONS = 8  # even, so that the chi-square distribution has a closed form
CONFIDENCE = 0.95
LEAF = 48
BLOCK_ROWS, BLOCK_QUERIES = 40_000, 20_000
SEED = 20140901


def chi2_cdf(x: float, degrees: int = DIRECTIONS) -> float:
    """The chi-square distribution function for an even number of degrees."""
    if x > 700:
        return 1.0
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def directions(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, DIRECTIONS))


class ProjectedTree:
    """A kd-tree over projected points; its leaves are ranges of one order of the points."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.axes = directions(vectors.shape[1])
        points = vectors @ self.axes
        self.order = np.arange(len(vectors))
        leaves: list[tuple[int, int]] = []
        parts = [(0, len(vectors))]
        while parts:  # split at the median of the widest axis until LEAF points are left
            begin, end = parts.pop()
            if end - begin <= LEAF:
                leaves.append((begin, end))
                continue
            inside = points[self.order[begin:end]]
            axis, half = int(np.argmax(np.ptp(inside, axis=0))), (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(inside[:, axis], half)]
            parts += [(begin, begin + half), (begin + half, end)]
        self.begin, self.end = np.array(sorted(leaves)).T
        self.points, self.vectors = points[self.order], vectors[self.order]
        self.low = np.minimum.reduceat(self.points, self.begin)
        self.high = np.maximum.reduceat(self.points, self.begin)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the original order, distances) of at least the k nearest found.

        Leaves come in ascending order of their projected distance, a few more at a time.
        Their points that are nearer than the next leaf are verified, all points as near as
        that being known by then; the stopping test is applied at that projected radius.
        """
        q = query @ self.axes
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        away = (gap * gap).sum(axis=1)
        leaves = np.argsort(away, kind="stable")
        waiting_at, waiting = np.empty(0, np.int64), np.empty(0)
        at, distance = np.empty(0, np.int64), np.empty(0)
        done, step = 0, 4
        while done < len(leaves):
            now = leaves[done:done + step]
            done, step = done + step, min(2 * step, 64)
            radius = away[leaves[done]] if done < len(leaves) else np.inf
            new = np.concatenate([np.arange(self.begin[i], self.end[i]) for i in now])
            gap = self.points[new] - q
            waiting_at, waiting = np.append(waiting_at, new), np.append(waiting, (gap * gap).sum(axis=1))
            ready = waiting <= radius
            found, waiting_at, waiting = waiting_at[ready], waiting_at[~ready], waiting[~ready]
            true = self.vectors[found] - query
            at, distance = np.append(at, found), np.append(distance, np.sqrt((true * true).sum(axis=1)))
            if len(at) < k:
                continue
            kth = np.partition(distance, k - 1)[k - 1]
            at, distance = at[distance <= kth], distance[distance <= kth]  # ties stay
            if chi2_cdf(radius / kth ** 2 if kth else np.inf) >= CONFIDENCE:
                break
        return self.order[at], distance


def _block_answers(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The block's best k for each query: query_id, vec_id, score."""
    columns = ["query_id", "vec_id", "score"]
    if index.empty or queries.empty:
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in zip(columns, ("int64", "int64", "float64"))})
    ids = index["vec_id"].to_numpy(np.int64)
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], np.stack(index["vector"].to_numpy())[by_id].astype(float)
    points, where = np.unique(vectors, axis=0, return_inverse=True)
    group = np.argsort(where.ravel(), kind="stable")  # ids of equal vectors, ascending
    starts = np.searchsorted(where.ravel()[group], np.arange(len(points) + 1))
    tree = ProjectedTree(points)
    out: list[tuple[int, int, float]] = []
    for query_id, query in zip(queries["vec_id"].to_numpy(np.int64), queries["vector"]):
        # one point more than k, since the query's own vector is among the candidates
        at, distance = tree.search(np.asarray(query, float), k + 1)
        found: list[tuple[float, int]] = []
        for place, score in zip(at, distance):
            same = ids[group[starts[place]:starts[place + 1]]]
            first = same[same != query_id][:k]  # any k of the smallest ids are enough
            found += [(float(score), int(i)) for i in first]
        out += [(int(query_id), i, s) for s, i in heapq.nsmallest(k, found)]
    return pd.DataFrame(out, columns=columns)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector as doubles) of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall(values, lambda x: x == 0)
    return vectors.select(F.col(key).cast("long").alias("vec_id"), values.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & ~zero)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of each query."""
    points, asked = usable(vectors, key, vector), usable(queries, key, vector)
    blocks = max(1, math.ceil(points.count() / BLOCK_ROWS))
    query_blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    dims = F.size("vector")
    index = (
        points.withColumn("dims", dims)
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    spread = (
        asked.withColumn("dims", dims)
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    by = ("dims", "block", "part")
    answers = index.groupBy(*by).cogroup(spread.groupBy(*by)).applyInPandas(
        lambda a, b: _block_answers(a, b, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
