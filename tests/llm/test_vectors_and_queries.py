import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import neighbours, topk
from gridloom.llm.common import table, usable_vectors
from gridloom.llm.registry import QUERIES, SQL

from .. import against_duckdb

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, small, name):
    against_duckdb.check(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_give_a_row_for_each_input(spark, small, name):
    found = QUERIES[name](spark, small)
    n = found.count()
    source = {"op1_html_extraction": "pages", "op5_neighbours": "embeddings"}.get(name, "documents")
    there = table(spark, small, source).count()
    assert n == there if name not in ("op5_neighbours", "pipeline") else n > 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, 0) for i, v in rows], VECTORS)


def odd_rows(dim):
    good = [(i, np.random.default_rng(i).standard_normal(dim)) for i in range(40)]
    # Many ids of one vector, a row that stands twice, an id with two vectors, an id with one vector three times.
    ties = [(100 + i, good[3][1]) for i in range(30)] + [(5, good[5][1]), (6, good[7][1]), (9, good[9][1]), (9, good[9][1])]
    bad = [(200, None), (201, [math.nan] * dim), (202, [math.inf] + [0.0] * (dim - 1)), (203, [1.0] * (dim - 1)), (204, [])]
    return good + ties, bad


def by_hand(rows, k, wanted, score):
    """The answers of every query row, as (query_id, [(score, vec_id)]), from all pairs of rows but a row and itself."""
    out = []
    for a, (q, x) in enumerate(rows):
        if wanted(q):
            near = sorted((-score(x, y), i) for b, (i, y) in enumerate(rows) if a != b)[:k]
            out.append((q, [(-s, i) for s, i in near]))
    return sorted(out)


def answers(found):
    rows = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    return rows


def same_answers(found, wanted):
    assert answers(found) == sorted((q, rank, i, s) for q, near in wanted for rank, (s, i) in enumerate(near, 1))


@pytest.mark.parametrize("tile_rows", [8192, 10])
def test_top_k_with_ties_repeats_and_unusable_vectors(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(topk, "TILE_ROWS", tile_rows)
    good, bad = odd_rows(64)
    rows = usable_vectors(vectors(spark, good + bad), 64)
    whole = [(i, np.floor(256 * np.asarray(v, np.float32).astype(float))) for i, v in good]
    for k in (5, 200):
        wanted = by_hand(whole, k, lambda i: i % 3 == 0, lambda x, y: int(x @ y))
        same_answers(topk.exact_top_k(rows.where("vec_id % 3 = 0"), rows, k), wanted)


def test_few_pairs_survive_where_vectors_have_structure():
    """Smooth curves: the segments' bounds leave a small part to compute, and a seed leaves less."""
    rng = np.random.default_rng(4)
    c = np.floor(256 * np.cumsum(rng.standard_normal((4000, 64)), axis=1) / 8)
    q, own = c[::50], np.arange(0, 4000, 50)
    plain, seeded = {}, {}
    i, j, scores = topk.best_of_tile(q, own, c, 5, tally=plain)
    exact = q @ c.T
    exact[np.arange(len(q)), own] = -np.inf
    assert (scores.reshape(-1, 5) == -np.sort(-exact, axis=1)[:, :5]).all()
    again = topk.best_of_tile(q, own, c, 5, seeds=scores.reshape(-1, 5)[:, -1].astype(float), tally=seeded)
    assert all((x == y).all() for x, y in zip(again, (i, j, scores), strict=True))
    assert seeded["survivors"] < plain["survivors"] < 0.3 * plain["pairs"]


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((30, 64)), rng.standard_normal((40, 64))
    exact = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    before = np.zeros_like(exact)
    for n in topk.SEGMENTS:
        x, y = topk.segment_features(a, n), topk.segment_features(b, n)
        bound = ((x[:, None] - y[None]) ** 2).sum(axis=2)
        assert (bound <= exact + 1e-9).all() and (bound >= before - 1e-9).all()
        before = bound


def test_large_components_stay_exact():
    q = np.array([[2.0**30, 1.0]])
    c = np.array([[2.0**30, 1.0], [2.0**30, 0.0]])
    assert topk.exact_products(q, c).tolist() == [[2**60 + 1, 2**60]]


def test_neighbours_reach_the_recall(spark, small):
    rows = usable_vectors(table(spark, small.replace("sf0.001", "sf0.01"), "embeddings"), 64)
    pdf = rows.toPandas()
    ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"]).astype(float)
    found = neighbours.nearest(rows.where("vec_id % 20 = 0"), rows).toPandas()
    hits = total = 0
    at = {i: k for k, i in enumerate(ids)}
    for q, own in found.groupby("query_id"):
        scores = x @ x[at[q]]
        scores[at[q]] = -np.inf
        kth = np.sort(scores)[-20]
        assert list(own.sort_values("rank")["score"]) == sorted(own["score"], reverse=True)
        assert np.allclose(own["score"], [x[at[q]] @ x[at[i]] for i in own["vec_id"]], atol=1e-12)
        hits += (own["score"] >= kth - 1e-12).sum()
        total += 20
    assert hits / total >= 0.9


@pytest.mark.parametrize("tile_rows", [8192, 10])
def test_neighbours_with_ties_repeats_and_unusable_vectors(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(neighbours, "TILE_ROWS", tile_rows)
    good, bad = odd_rows(64)
    rows = usable_vectors(vectors(spark, [*good, *bad, (300, np.zeros(64))]), 64)

    def product(x, y):
        total = 0.0
        for a, b in zip(np.asarray(x, np.float32).tolist(), np.asarray(y, np.float32).tolist(), strict=True):
            total += a * b
        return total

    found = neighbours.nearest(rows.where("vec_id % 2 = 0"), rows, k=4, confidence=0.9999)
    same_answers(found, by_hand(good, 4, lambda i: i % 2 == 0, product))
    assert neighbours.nearest(rows.limit(0), rows.limit(0)).count() == 0 and topk.exact_top_k(rows.limit(0), rows.limit(0)).count() == 0


def test_few_leaves_are_seen_where_neighbours_are_near():
    rng = np.random.default_rng(6)
    c = np.repeat(rng.standard_normal((200, 64)), 40, axis=0) + 0.05 * rng.standard_normal((8000, 64))
    q, own, tally = c[::40], np.arange(0, 8000, 40), {}
    i, j, score = neighbours.near_of_tile(q, own, c, 20, neighbours.PROJECTIONS, neighbours.CONFIDENCE, tally=tally)
    exact = q @ c.T
    exact[np.arange(len(q)), own] = -np.inf
    kth = np.sort(exact, axis=1)[:, -20]
    assert (score >= kth[i] - 1e-9).mean() > 0.9 and tally["visits"] < 0.4 * tally["leaves"]


def test_chi_square_quantiles():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(2 * math.log(2), abs=1e-9)


def test_pipeline_stages_keep_the_columns(spark, small):
    docs = table(spark, small, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == names, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert 0 < docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert last.where(F.size("ids") != F.col("n_tokens")).count() == 0 and last.count() == docs.count()
