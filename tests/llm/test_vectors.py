import math
import random
from collections import Counter

import numpy as np
import pytest

from claimtide.llm import kdtree, quantized, vector_grid

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_rows():
    rng = random.Random(2)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(6)], 0) for i in range(0, 400)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(150)]  # one common vector: ties by id
    rows += [(2000, None, 0), (2050, [0.0] * 6, 0), (2100, [None, 1.0, 0.0, 0.0, 0.0, 0.0], 0), (2150, [math.nan] * 6, 0),
             (2200, [math.inf] + [0.0] * 5, 0), (2250, [], 0), (None, [1.0] * 6, 0), (2300, [1.0, 2.0], 0), (2301, [2.0, 1.0], 0),
             (2350, [1.0, 2.0, 3.0], 0), (50, rows[50][1], 0), (7, [9.0] * 6, 0), (2400, [1e-30] * 6, 0), (2401, [1e30] * 6, 0),
             (-50, [0.5, -0.5, 0.5, -0.5, 0.5, -0.5], 0)]
    return rows


def kept(rows, zero, change):
    out = []
    for i, v, _ in rows:
        if not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [change(float(np.float32(x))) for x in v]
        if zero or any(v):
            out.append((i, v))
    return out


def brute(vectors, score, k=5):
    """How often each (query id, rank, id, score) is found: every row asks for itself and is left out for itself only."""
    found = Counter()
    for at, (q, a) in enumerate(vectors):
        if q is not None and q % 50 == 0:
            items = sorted((-score(a, b), i is None, i or 0) for other, (i, b) in enumerate(vectors)
                           if other != at and len(a) == len(b))
            found.update((q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(items[:k], 1))
    return found


def cosine(a, b):
    dot = n = m = 0.0
    for x, y in zip(a, b):
        dot, n, m = dot + x * y, n + x * x, m + y * y
    return dot / (math.sqrt(n) * math.sqrt(m))


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "block_rows": 4}])
def test_exact_top_k(spark, sizes):
    rows = [r for r in odd_rows() if r[0] != 2401]
    found = kdtree.exact_top_k(spark.createDataFrame(rows, SCHEMA), **sizes).collect()
    want = brute(kept(rows, True, lambda x: math.floor(256 * x)), lambda a, b: sum(x * y for x, y in zip(a, b)))
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in found) == want


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "block_rows": 4}])
def test_nearest_by_cosine(spark, sizes):
    rows = odd_rows()
    found = quantized.nearest_by_cosine(spark.createDataFrame(rows, SCHEMA), **sizes).collect()
    want = brute(kept(rows, False, lambda x: x), cosine)
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in found) == Counter(
        {(q, rank, i, round(s, 12)): n for (q, rank, i, s), n in want.items()})


def test_rows_that_share_an_id_are_all_compared(spark):
    rows = [(50, [1.0, 0.0], 0), (7, [0.9, 0.1], 0), (7, [-1.0, 0.0], 0), (8, [0.5, 0.5], 0), (None, [1.0, 0.0], 0), (50, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    exact = [(r.rank, r.vec_id, r.score) for r in kdtree.exact_top_k(df).orderBy("query_id", "rank").collect()]
    assert (1, None, 65536) in exact and (2, 7, 230 * 256) in exact and (5, 7, -65536) in exact and len(exact) == 10
    near = [(r.rank, r.vec_id) for r in quantized.nearest_by_cosine(df).collect()]
    assert {(1, None), (2, 7), (3, 8), (4, 50), (5, 7)} <= set(near) and len(near) == 10


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert kdtree.exact_top_k(empty).count() == 0 and quantized.nearest_by_cosine(empty).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], SCHEMA)
    assert kdtree.exact_top_k(one).count() == 0 and quantized.nearest_by_cosine(one).count() == 0


def test_tree_boxes_are_tight_and_bounds_hold():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(0, 60, (3000, 8)))
    tree = kdtree.Tree(points, leaf=50)
    queries = np.floor(rng.normal(0, 60, (20, 8)))
    bounds, seen = tree.bounds(queries), []
    for node, (start, end) in enumerate(tree.range):
        own = points[tree.order[start:end]]
        assert (own.min(axis=0) == tree.low[node]).all() and (own.max(axis=0) == tree.high[node]).all()
        assert (bounds[node] >= (own @ queries.T).max(axis=0)).all()
        if tree.children[node] == [-1, -1]:
            assert end - start <= 50
            seen += tree.order[start:end].tolist()
    assert sorted(seen) == list(range(3000))


def test_error_bounds_hold():
    rng = np.random.default_rng(4)
    rows = rng.normal(0, 1, (500, 64))
    norm = np.linalg.norm(rows, axis=1)
    codes, scale, size, lost = quantized.encode(rows, norm)
    unit = rows / norm[:, None]
    near = (codes.astype(float) @ codes.astype(float).T) * scale[:, None] * scale[None]
    off = np.abs(unit @ unit.T - near)
    assert (off <= lost[:, None] + size[:, None] * lost[None] + 1e-12).all() and codes.dtype == np.int8


def test_large_integers_are_exact():
    big = np.array([[2.0 ** 30 + 1, 1.0], [2.0 ** 30, 3.0], [-5.0, 2.0 ** 30 - 1]])
    ids, own = np.array([1, 2, 3]), np.array([4, 5, 6])
    rows, found, scores = kdtree.search(ids, own, big, np.array([9]), big[:1], np.array([np.nan]), 2)
    assert found == [0, 1] and scores == [(2 ** 30 + 1) ** 2 + 1, (2 ** 30 + 1) * 2 ** 30 + 3]


def test_shards_follow_the_rows():
    assert vector_grid.shards_for(0, 8, 100) == 1 and vector_grid.shards_for(1_000_000, 8, 1000) == 1000
    assert vector_grid.shards_for(5000, 8, 65_536) == 4
