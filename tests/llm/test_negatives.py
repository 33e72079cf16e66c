"""Hard negatives against all pairs in Python integers; bounds against true scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import negatives
from headway.llm.queries import QUERIES, table

SCHEMA = "vec_id long, embedding array<float>, label int"


def all_pairs(rows, positives=5, count=10):
    """``rows``: (vec_id, vector, label) that take part, ids once."""
    scaled = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, label, v in scaled:
        if i % 100:
            continue
        near = sorted((-score(v, w), j) for j, other, w in scaled if other == label and j != i)[:positives]
        far = sorted((-score(v, w), j) for j, other, w in scaled if other != label)
        for s, p in near:
            fits = [(n, j) for n, j in far if 30 * -s <= 100 * -n <= 90 * -s][:count]
            out += [(i, p, k, j, -s, -n) for k, (n, j) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **how):
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **how).collect()))


def test_query(spark, sf_dir):
    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in table(spark, sf_dir, "embeddings").collect()
    ]
    got = sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, sf_dir).collect()))
    assert got == all_pairs(rows) and got


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_clusters_ties_and_small_blocks(spark, monkeypatch, dim):
    """Vectors around few centres, a third of them equal; blocks of a few rows."""
    for name, value in {"ROWS": 60, "ANCHORS": 2}.items():
        monkeypatch.setattr(negatives, name, value)
    r = random.Random(dim)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for k in range(400):
        centre = centres[k % 4]
        vector = centres[0] if k % 3 == 0 else [x + r.gauss(0, 0.2) for x in centre]
        rows.append((k * 25, [float(np.float32(x)) for x in vector], r.randrange(3)))
    assert mined(spark.createDataFrame(rows, SCHEMA)) == all_pairs(rows)


def test_bounds_hold_and_leave_pairs_out(spark):
    r = np.random.default_rng(1)
    for dim in (5, 64, 200):
        near = r.normal(size=(1, dim)) + 0.2 * r.normal(size=(40, dim))
        vectors = np.floor(256 * np.concatenate([near, -near, r.normal(size=(40, dim)), np.zeros((2, dim))])).astype(np.int64)
        codes, aligned, residual = negatives.encode(vectors)
        block = object.__new__(negatives.Block)
        block.codes, block.aligned, block.residual = codes, aligned, residual
        block.ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        n = len(vectors)
        low = np.full((n, 1), negatives.LOWEST + 1)
        queries = negatives.Anchors(np.arange(n), np.zeros(n, int), vectors, low, -low, 5)
        lower, upper = queries.bounds(slice(0, n), block, np.arange(n))
        scores = vectors @ vectors.T
        assert (lower <= scores).all() and (scores <= upper).all()
        # Opposite vectors can never reach the score of close ones.
        assert (upper[:40, 40:80] < scores[:40, :40].min()).mean() > 0.9


def test_small_tiles_skip_pairs_and_lose_nothing():
    r = np.random.default_rng(4)
    n, dim, k = 600, 64, 3
    vectors = np.floor(256 * (3 * r.normal(size=(6, dim))[np.arange(n) % 6] + 0.3 * r.normal(size=(n, dim)))).astype(np.int64)
    block = object.__new__(negatives.Block)
    block.ids, block.labels, block.vectors = np.arange(n), np.arange(n) % 2, vectors
    block.codes, block.aligned, block.residual = negatives.encode(vectors)
    block.ones = np.bitwise_count(block.codes).sum(axis=1, dtype=np.int64)
    block.largest = int(np.abs(vectors).max())
    low = np.full((n, 1), negatives.LOWEST + 1)
    queries = negatives.Anchors(block.ids, block.labels, vectors, low, -low, k)
    scored = queries.search(block, np.arange(n), np.arange(n), True, tile=256, tile_rows=32)
    scores = vectors @ vectors.T
    for a in range(n):
        best = sorted((-scores[a, b], b) for b in range(n) if b != a and b % 2 == a % 2)[:k]
        assert best == [(-s, i) for s, i in zip(queries.scores[a, 0].tolist(), queries.found[a, 0].tolist())]
    assert scored < 0.5 * n * (n // 2 - 1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(100, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.6, 0.2], 2), (3, [0.5], 2), (200, [], 1), (4, [-1.0, 0.0], 2)]
    bad = [(None, [1.0, 1.0], 1), (300, None, 1), (400, [1.0, None], 1), (500, [nan, 1.0], 1), (600, [inf, 1.0], 2),
           (700, [-inf, 1.0], 1), (800, [1.0, 1.0], None), (900, None, None)]
    filled = [(i, (v + [0.0, 0.0])[:2], label) for i, v, label in good]
    df = spark.createDataFrame(good + bad + good, SCHEMA).selectExpr("*", "'x' as code", "1 as vector", "2 as down", "3 as rank")
    assert mined(df) == all_pairs(filled) and mined(df)
    # Of rows with one id the smaller label, then vector, counts.
    twice = [(100, [9.0, 9.0], 3), (100, [1.0, 0.6], 1)]
    assert mined(spark.createDataFrame(good + twice, SCHEMA)) == all_pairs(filled)
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id < 100")) == []
    assert mined(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)) == []


def test_scores_beyond_floating_point(spark):
    rows = [(0, [90000.0] * 64, 1), (1, [90000.0] * 63 + [89999.99], 1), (2, [60000.0] * 64, 2), (3, [60000.0] * 63 + [60000.01], 2)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == all_pairs(rows)
