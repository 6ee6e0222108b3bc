"""Exact top-k search: segment means and deviations bound the distance, coarse to fine; survivors are computed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOUND, Tiles, found_of_tile, nearest_first, of_tile, stored, table, usable_vectors

DIM = 64
SCALE = 256
K = 5
SEGMENTS = (1, 4, 16)
QUERY_ROWS, TILE_ROWS, STRIP = 2048, 8192, 1024


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(length) * (mean, deviation) of each segment.

    The squared distance of two rows of features is at most that of the vectors: in each segment the means differ by
    what they do and the rest by at least the difference of the deviations. The features keep the vector's norm.
    """
    parts = x.reshape(len(x), segments, -1)
    root = np.sqrt(parts.shape[2])
    return np.concatenate([root * parts.mean(axis=2), root * parts.std(axis=2)], axis=1)


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles are exact below 2**53, else int64 arithmetic."""
    bound = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    return (q @ c.T).astype(np.int64) if bound < 2**53 else q.astype(np.int64) @ c.astype(np.int64).T


def out_of_reach(q_features: np.ndarray, q_sq: np.ndarray, c_features: np.ndarray, c_sq: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Which queries no row of a whole strip can serve: their distance to the box around the strip's features bounds
    that to each of its rows."""
    low, high = c_features.min(axis=0), c_features.max(axis=0)
    gap = np.maximum(np.maximum(low - q_features, q_features - high), 0)
    upper = (q_sq + c_sq.max() - np.einsum("ij,ij->i", gap, gap)) / 2
    return upper * (1 + 1e-9) + 1e-6 * (1 + np.abs(upper)) < kth


def best_of_tile(q, own, c, k: int, seeds=None, segments=SEGMENTS, strip: int = STRIP, tally: dict | None = None):
    """(query row, candidate row, score) of the k highest inner products of each query in this tile, ties to the earlier
    candidate row; ``own`` names a row that is none for a query, ``seeds`` scores that are too low to count.

    Strips of candidates go by falling norm, so each query's k-th score rises early. 2 q.c = |q|^2 + |c|^2 - d^2 turns
    the lower bound on the distance into an upper bound on the score; a query leaves a strip whose box is too far, a
    candidate goes as soon as one level's bound lies below the k-th score. ``tally`` counts pairs and survivors.
    """
    order = np.lexsort((np.arange(len(c)), -np.einsum("ij,ij->i", c, c)))
    q_sq = np.einsum("ij,ij->i", q, q)
    q_levels = [segment_features(q, s) for s in segments]
    floor = np.full(len(q), -np.inf) if seeds is None else seeds
    kth = floor.copy()
    top_q, top_c, top_score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    for start in range(0, len(c), strip):
        at = order[start : start + strip]
        s = c[at]
        s_sq = np.einsum("ij,ij->i", s, s)
        s_levels = [segment_features(s, n) for n in segments]
        rows = np.flatnonzero(~np.logical_or.reduce([out_of_reach(x, q_sq, y, s_sq, kth) for x, y in zip(q_levels[:2], s_levels[:2], strict=True)]))
        cols = np.arange(len(s))
        alive = np.ones((len(rows), len(s)), bool)
        for level, f in zip(q_levels, s_levels, strict=True):
            if not alive.size:
                break
            far = q_sq[rows, None] + s_sq[None, cols] - 2 * level[rows] @ f[cols].T  # lower bound on the squared distance
            upper = (q_sq[rows, None] + s_sq[None, cols] - far) / 2
            alive &= upper * (1 + 1e-9) + 1e-6 * (1 + np.abs(upper)) >= kth[rows, None]
            keep_r, keep_c = alive.any(axis=1), alive.any(axis=0)
            rows, cols, alive = rows[keep_r], cols[keep_c], alive[np.ix_(keep_r, keep_c)]
        if tally is not None:
            tally["pairs"] = tally.get("pairs", 0) + len(q) * len(s)
            tally["survivors"] = tally.get("survivors", 0) + int(alive.sum())
        if not alive.size:
            continue
        scores = exact_products(q[rows], s[cols])
        alive &= scores >= kth[rows, None]
        alive &= at[cols][None, :] != own[rows][:, None]
        if alive.sum() > 4 * k * len(rows):  # ties at the k-th place all stay
            low = np.where(alive, scores, np.iinfo(np.int64).min)
            place = max(0, low.shape[1] - k)
            alive &= low >= np.partition(low, place, axis=1)[:, place][:, None]
        i, j = np.nonzero(alive)
        top_q = np.concatenate([top_q, rows[i]])
        top_c = np.concatenate([top_c, at[cols[j]]])
        top_score = np.concatenate([top_score, scores[i, j]])
        best = np.lexsort((top_c, -top_score, top_q))
        top_q, top_c, top_score = top_q[best], top_c[best], top_score[best]
        first = np.searchsorted(top_q, top_q, side="left")
        keep = np.arange(len(top_q)) - first < k
        top_q, top_c, top_score = top_q[keep], top_c[keep], top_score[keep]
        full = np.bincount(top_q, minlength=len(q)) >= k
        last = np.searchsorted(top_q, np.arange(len(q)), side="right") - 1
        kth = np.where(full, np.maximum(floor, top_score[last]), floor) if len(top_score) else floor
    return top_q, top_c, top_score


def exact_top_k(queries: DataFrame, rows: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query row's vector, of `usable_vectors`.

    Components become floor(scale * x). Each query first meets one block of rows; its k-th score there goes with it to
    all other blocks, so that a strip or a candidate whose bound lies below is not computed.

    Vectors that are null, of another length, or hold null or non-finite components take no part; every other row is a
    candidate, but for the query's own; rows of a query's id with another vector, and its exact copies, are candidates
    like any other; query rows that stand twice are answered twice. Ties go to the smaller id. Empty tables give no
    rows. Other columns are not read.
    """

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({name.split()[0]: np.empty(0, np.int64) for name in (FOUND + "long").split(", ")})
        c, own = of_tile(q, c)
        whole = [np.floor(scale * np.stack(x["embedding"].to_numpy()).astype(np.float64)) for x in (q, c)]
        seeds = q["seed"].to_numpy(float, na_value=-np.inf) if "seed" in q else None
        i, j, scores = best_of_tile(whole[0], own, whole[1], k, seeds)
        return found_of_tile(q, c, i, j, scores)

    plan = Tiles.of(queries, rows, QUERY_ROWS, TILE_ROWS)
    found = stored(plan.deal(queries, rows, home=True).applyInPandas(search, FOUND + "long"), "top-seeds")
    if plan.r_blocks > 1:
        # Of k rows found the lowest score; a query that met fewer has no seed yet.
        kth = found.groupBy("query_id", "query_variant").agg(F.min("score").alias("seed"), F.count("*").alias("found")).where(F.col("found") >= k)
        seeded = queries.join(kth.select(F.col("query_id").alias("vec_id"), F.col("query_variant").alias("variant"), F.col("seed").cast("double").alias("seed")), ["vec_id", "variant"], "left")
        found = found.unionByName(plan.deal(seeded, rows, home=False).applyInPandas(search, FOUND + "long"))
    return nearest_first(found, k)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"), DIM)
    return exact_top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


OP2_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
