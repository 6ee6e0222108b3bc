"""Approximate nearest neighbours: 2-stable projections in a kd-tree, verified until a chi-square test holds."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOUND, Tiles, found_of_tile, nearest_first, of_tile, table, usable_vectors

DIM = 64
K = 20
PROJECTIONS = 8
#: The chi-square quantile at which a query stops, and the ratio by which a missed row may be nearer than the k-th found.
CONFIDENCE, RATIO = 0.3, 1.0
LEAF = 64
SEED = 11
QUERY_ROWS, TILE_ROWS, QUERY_STRIP = 2048, 8192, 1024


def chi_square_quantile(p: float, degrees: int) -> float:
    """The p-quantile of chi-square with an even number of degrees, by bisection on its closed form."""
    low, high = 0.0, 1e4
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
        low, high = (x, high) if below < p else (low, x)
    return high


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """The leaves of a balanced kd-tree: halved at the median of the widest coordinate down to ``leaf`` rows.

    Equal points are halved too, so that any number of copies still gives small leaves.
    """
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(own[:, axis], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return leaves


def near_of_tile(q, own, c, k: int, projections: int, confidence: float, ratio: float = 1.0, leaf: int = LEAF, tally: dict | None = None):
    """(query row, candidate row, inner product) of the k nearest found of each query in this tile; ``own`` names a row
    that is none for a query; ties go to the earlier row.

    The largest inner product is the smallest distance once each row has a further component sqrt(M^2 - |c|^2), M the
    largest norm. Projected by a Gaussian matrix, a squared distance d^2 becomes d^2 times a chi-square variable. Leaves
    are visited by the distance D of their boxes; once D^2 >= quantile * d_k^2 / ratio^2, a row nearer than d_k / ratio
    that lies beyond has its projection there with a probability of 1 - confidence at most, and the query stops. As a
    box begins nearer than its points lie, far fewer are missed. ``tally`` counts leaves and visits.
    """
    sq = np.einsum("ij,ij->i", c, c)
    top_sq = sq.max(initial=0.0)
    matrix = np.random.default_rng(SEED).standard_normal((c.shape[1] + 1, projections))
    points = np.column_stack([c, np.sqrt(np.maximum(top_sq - sq, 0))]) @ matrix
    leaves = kd_leaves(points, leaf)
    low = np.stack([points[x].min(axis=0) for x in leaves])
    high = np.stack([points[x].max(axis=0) for x in leaves])
    width = max(map(len, leaves))
    none = len(c)
    quantile = chi_square_quantile(confidence, projections) / ratio**2
    out = []
    for start in range(0, len(q), QUERY_STRIP):
        strip = slice(start, start + QUERY_STRIP)
        here, own_row = q[strip], own[strip]
        at = here @ matrix[:-1]
        gap = np.zeros((len(here), len(leaves)))
        for axis in range(projections):
            x = at[:, axis, None]
            gap += np.maximum(np.maximum(low[None, :, axis] - x, x - high[None, :, axis]), 0) ** 2
        order = np.argsort(gap, axis=1, kind="stable")
        gap = np.take_along_axis(gap, order, axis=1)
        here_sq = np.einsum("ij,ij->i", here, here)
        best = np.full((len(here), k), -np.inf)
        best_row = np.full((len(here), k), none)
        active = np.arange(len(here))
        if tally is not None:
            tally["leaves"] = tally.get("leaves", 0) + len(here) * len(leaves)
        for step in range(len(leaves)):
            kth_sq = here_sq[active] + top_sq - 2 * best[active, -1]
            active = active[~(gap[active, step] >= quantile * kth_sq)]
            if not len(active):
                break
            if tally is not None:
                tally["visits"] = tally.get("visits", 0) + len(active)
            leaf_of = order[active, step]
            by_leaf = np.argsort(leaf_of, kind="stable")
            ends = np.flatnonzero(np.diff(leaf_of[by_leaf])) + 1
            score = np.full((len(active), width), -np.inf)
            row = np.full((len(active), width), none)
            for group in np.split(by_leaf, ends):  # the queries that visit the same leaf now
                rows = leaves[leaf_of[group[0]]]
                score[group, : len(rows)] = here[active[group]] @ c[rows].T
                row[group, : len(rows)] = rows
            score[row == own_row[active, None]] = -np.inf
            better = np.flatnonzero((score >= best[active, -1:]).any(axis=1))
            who = active[better]
            all_score = np.concatenate([best[who], score[better]], axis=1)
            all_row = np.where(np.isneginf(all_score), none, np.concatenate([best_row[who], row[better]], axis=1))
            first = np.lexsort((all_row, -all_score), axis=1)[:, :k]
            best[who] = np.take_along_axis(all_score, first, axis=1)
            best_row[who] = np.take_along_axis(all_row, first, axis=1)
        i, j = np.nonzero(~np.isneginf(best))
        out.append((i + start, best_row[i, j], best[i, j]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def nearest(
    queries: DataFrame, rows: DataFrame, k: int = K, dim: int = DIM,
    projections: int = PROJECTIONS, confidence: float = CONFIDENCE, ratio: float = RATIO,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by inner product in double precision, of `usable_vectors`.

    Every row stands in one tile's tree; the trees of all tiles answer each query and their answers are merged. Null,
    zero and non-finite vectors and those of another length take no part; every other row is a candidate, but for the
    query's own; rows of a query's id with another vector, and its exact copies, are candidates like any other; query
    rows that stand twice are answered twice; ties go to the smaller id; empty tables give no rows.
    """

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({name.split()[0]: np.empty(0, float if "score" in name else np.int64) for name in (FOUND + "double").split(", ")})
        c, own = of_tile(q, c)
        both = [np.stack(x["embedding"].to_numpy()).astype(np.float64) for x in (q, c)]
        i, j, _ = near_of_tile(both[0], own, both[1], k, projections, confidence, ratio)
        score = np.zeros(len(i))
        for axis in range(both[0].shape[1]):  # summed in the order of the components, alike in every tile
            score += both[0][i, axis] * both[1][j, axis]
        return found_of_tile(q, c, i, j, score)

    zero = F.forall("embedding", lambda x: x == 0)
    queries, rows = queries.where(~zero), rows.where(~zero)
    found = Tiles.of(queries, rows, QUERY_ROWS, TILE_ROWS).deal(queries, rows).applyInPandas(search, FOUND + "double")
    return nearest_first(found, k)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"), DIM)
    return nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)
