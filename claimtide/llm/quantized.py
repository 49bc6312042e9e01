"""Nearest neighbours by cosine: a block matrix join on int8 codes with error bounds, then exact recomputation.

Unit vectors are rounded to int8 codes with one scale each.  A tile of queries times vectors is one matrix product of
codes; as |q.x - q~.x~| <= |q - q~| * |x| + |q~| * |x - x~|, every entry comes with a bound of its error.  A pair
survives if its upper bound reaches the kth best lower bound of its query, so none of the k nearest can be lost.
Surviving pairs are recomputed in double precision on the original vectors, and heaps merge them over tiles.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.vector_grid import BLOCK_ROWS, SHARD_ROWS, Best, shards_for, top_of_grid, valid_vectors

TILE_QUERIES, TILE_ROWS = 512, 4096
# Products of codes summed in float32 are exact up to this dimension (127 * 127 * d < 2^24).
EXACT_DIMENSION = 1040
# Rounding of the bounds themselves.
SLACK = 1e-9


def balanced(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component near 1: exact, and squares can't overflow."""
    exponent = np.frexp(np.abs(rows).max(axis=1))[1]
    return np.ldexp(rows, -exponent[:, None])


def summed(products: np.ndarray) -> np.ndarray:
    """Row sums, component after component, so that equal vectors have equal sums wherever they stand."""
    total = np.zeros(len(products))
    for j in range(products.shape[1]):
        total += products[:, j]
    return total


def encode(rows: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, norms of the decoded vectors and norms of what rounding lost."""
    unit = rows / norms[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def search(ids, own, rows, query_own, queries, floors, k):
    """The k best cosines of every query in one shard: places of queries and of vectors, and scores."""
    kind = np.float32 if rows.shape[1] <= EXACT_DIMENSION else np.float64
    rows, queries = balanced(rows), balanced(queries)
    norm, query_norm = np.sqrt(summed(rows * rows)), np.sqrt(summed(queries * queries))
    codes, scale, _, lost = encode(rows, norm)
    query_codes, query_scale, query_size, query_lost = encode(queries, query_norm)
    best = [Best(k, f) for f in floors]
    for first in range(0, len(queries), TILE_QUERIES):
        part = slice(first, min(first + TILE_QUERIES, len(queries)))
        left = query_codes[part].astype(kind)
        for start in range(0, len(rows), TILE_ROWS):
            tile = slice(start, min(start + TILE_ROWS, len(rows)))
            near = (left @ codes[tile].astype(kind).T).astype(np.float64)
            near *= query_scale[part, None] * scale[None, tile]
            error = query_lost[part, None] + query_size[part, None] * lost[None, tile] + SLACK
            near[query_own[part, None] == own[None, tile]] = -np.inf
            bar = np.array([b.bar() for b in best[part]])
            if near.shape[1] >= k:
                bar = np.maximum(bar, np.partition(near - error, near.shape[1] - k, axis=1)[:, near.shape[1] - k])
            q, x = np.nonzero(near + error >= bar[:, None])
            some = np.isfinite(near[q, x])
            q, x = q[some] + first, x[some] + start
            exact = np.empty(len(q))
            for at in range(0, len(q), 65_536):
                i, j = q[at:at + 65_536], x[at:at + 65_536]
                exact[at:at + 65_536] = summed(queries[i] * rows[j]) / (query_norm[i] * norm[j])
            for i, j, s in zip(q.tolist(), x.tolist(), exact.tolist()):
                item, heap = (s, -int(ids[j]), j), best[i].heap
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item[:2] > heap[0][:2]:
                    heapq.heapreplace(heap, item)
    hits = [(i, place, s) for i, b in enumerate(best) for s, _, place in b.heap]
    return [h[0] for h in hits], [h[1] for h in hits], [h[2] for h in hits]


def nearest_by_cosine(embeddings: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``, against all other rows.

    The score is the cosine in double precision of the original vectors.  Vectors that are NULL, empty or zero or hold
    NULL or non-finite components take no part.  Rows that share an id are rows of their own: each is a candidate for
    the others, and each that asks has its own ranks.  A row without an id is a candidate, last among ties.  Vectors
    are compared with those of their own dimension.  Ties go to the smaller id; a query with fewer than k others has
    them all, one without any has no row.
    """
    vectors = valid_vectors(embeddings, "embedding", keep_zero=False)
    asked = vectors.filter(F.col("vec_id") % every == 0).withColumn("floor", F.lit(None).cast("double"))
    parallelism = embeddings.sparkSession.sparkContext.defaultParallelism
    shards = shards_for(vectors.count(), parallelism, shard_rows)
    sharded = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    found = top_of_grid(sharded, asked, k, search, "double", shards, shards_for(asked.count(), 1, block_rows))
    return found.drop("query_row")
