"""Exact top-k by integer inner product with one KD-tree per shard.

A shard's points are split at the median of the widest dimension, down to small leaves; every node keeps the tight
box of its points.  The inner product of a query with any point of a box is at most sum(max(q * low, q * high)), so a
best-first walk opens boxes by that bound and stops at the first one that is below the kth best score.  One shard is
searched first; the kth scores it gives are handed to the searches of all others as floors.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import staged
from claimtide.llm.vector_grid import BLOCK_ROWS, SHARD_ROWS, Best, ranked, shards_for, top_of_grid, valid_vectors

LEAF = 256
SCALE = 256
# Doubles hold sums of products exactly below this; larger vectors are multiplied as Python integers.
EXACT = 2.0 ** 53


class Tree:
    """Median splits with tight boxes; ``order`` lists points so that every node is a range of it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.low, self.high, self.range, self.children = [], [], [], []
        self.points = points
        stack = [(0, len(points), -1, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            node, own = len(self.range), points[self.order[start:end]]
            low, high = own.min(axis=0), own.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.range.append((start, end))
            self.children.append([-1, -1])
            if parent >= 0:
                self.children[parent][side] = node
            widest = int(np.argmax(high - low))
            if end - start > leaf and high[widest] > low[widest]:
                middle = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argpartition(own[:, widest], middle)]
                stack += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Greatest possible inner product of each query (columns) with the points of each node (rows)."""
        return self.high @ np.maximum(queries, 0).T + self.low @ np.minimum(queries, 0).T


def search(ids, own, points, query_own, queries, floors, k):
    """Best-first search of every query in one shard's tree: places of queries and of points, and integer scores."""
    reach = float(np.abs(points).max()) * float(np.abs(queries).max()) * points.shape[1]
    if reach >= EXACT:
        return _plain(ids, own, points, query_own, queries, k)
    tree = Tree(points)
    ids, own, points = ids[tree.order], own[tree.order], points[tree.order]
    rows, found, scores = [], [], []
    for first in range(0, len(queries), 512):
        bounds = tree.bounds(queries[first:first + 512])
        for i in range(bounds.shape[1]):
            at, best = first + i, Best(k, floors[first + i])
            heap, column = [(-bounds[0, i], 0)], bounds[:, i]
            while heap and -heap[0][0] >= best.bar():
                node = heapq.heappop(heap)[1]
                left, right = tree.children[node]
                if left >= 0:
                    heapq.heappush(heap, (-column[left], left))
                    heapq.heappush(heap, (-column[right], right))
                    continue
                start, end = tree.range[node]
                score = points[start:end] @ queries[at]
                keep = np.flatnonzero(score >= best.bar())
                if len(keep) > k + 1:  # the query itself and k others; ties at the last score go by id
                    bar = -np.partition(-score[keep], k)[k]
                    keep = keep[score[keep] >= bar]
                for j in keep.tolist():
                    if own[start + j] == query_own[at]:
                        continue
                    item = (float(score[j]), -int(ids[start + j]), start + j)
                    if len(best.heap) < k:
                        heapq.heappush(best.heap, item)
                    elif item[:2] > best.heap[0][:2]:
                        heapq.heapreplace(best.heap, item)
            for s, _, place in best.heap:
                rows.append(at)
                found.append(int(tree.order[place]))
                scores.append(int(s))
    return rows, found, scores


def _plain(ids, own, points, query_own, queries, k):
    """Vectors too large for exact doubles: every product as Python integers."""
    rows, found, scores = [], [], []
    whole = [[int(x) for x in p] for p in points]
    for at, q in enumerate(queries):
        q = [int(x) for x in q]
        items = [(-sum(a * b for a, b in zip(p, q)), int(i), place) for place, (p, i) in enumerate(zip(whole, ids))
                 if own[place] != query_own[at]]
        for s, _, place in heapq.nsmallest(k, items):
            rows.append(at)
            found.append(place)
            scores.append(-s)
    return rows, found, scores


def exact_top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE,
                shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``, against all other rows.

    Components x become floor(scale * x), and the score is the integer inner product.  Vectors that are NULL or empty
    or hold NULL or non-finite components take no part.  Rows that share an id are rows of their own: each is a
    candidate for the others, and each that asks has its own ranks.  A row without an id is a candidate, last among
    ties.  Vectors are compared with those of their own dimension.  Ties go to the smaller id; a query with fewer than
    k others has them all, one without any has no row.  Scores must fit a long.
    """
    vectors = valid_vectors(embeddings, "embedding")
    asked = vectors.filter(F.col("vec_id") % every == 0)
    parallelism = embeddings.sparkSession.sparkContext.defaultParallelism

    def whole(rows: np.ndarray) -> np.ndarray:
        return np.floor(rows * scale)

    shards = shards_for(vectors.count(), parallelism, shard_rows)
    blocks = shards_for(asked.count(), 1, block_rows)
    sharded = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    start = asked.withColumn("floor", F.lit(None).cast("double"))
    first = staged(top_of_grid(sharded.filter("shard = 0"), start, k, search, "long", 1, blocks, whole))
    if shards == 1:
        return first.drop("query_row")
    floors = first.filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("floor"))
    others = sharded.filter("shard > 0").withColumn("shard", F.col("shard") - 1)
    bounded = staged(asked.join(floors, "row", "left"))
    rest = top_of_grid(others, bounded, k, search, "long", shards - 1, blocks, whole)
    return ranked(first.drop("rank").unionByName(rest.drop("rank")), k).drop("query_row")
