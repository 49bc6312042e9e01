"""A stated set of query vectors against all vectors, in blocks, for the exact and the approximate search.

Vectors are dealt to shards and queries to blocks, both of bounded size; each (shard, block) pair is one task's work,
so neither side is ever gathered whole.  Rows travel as Arrow lists and become matrices without per-row objects.  The
results of a query from all shards, at most k each, meet in a ranked window whose limit Spark applies before the
exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import staged

# Vectors in a shard and queries in a block at most; a task holds one of each.
SHARD_ROWS, BLOCK_ROWS = 65_536, 8_192
# Small tables are still dealt to all cores, but no shard is made for fewer rows than this.
LEAST_ROWS = 1_024


def valid_vectors(df: DataFrame, vector: str, keep_zero: bool = True) -> DataFrame:
    """``vec_id, vec, row`` of every row whose vector isn't NULL and has no NULL or non-finite component.

    Single-precision vectors stay so, which halves what is written and exchanged; all others become doubles.  ``row``
    tells rows apart, also those that share an id or have none; it holds for the written table only.  Empty vectors, and
    zero ones unless kept, take no part.
    """
    single = dict(df.dtypes)[vector] == "array<float>"
    own = F.col(vector) if single else F.col(vector).cast("array<double>")
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter((F.size(vector) > 0) & finite).select("vec_id", own.alias("vec"))
    if not keep_zero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    return staged(rows.withColumn("row", F.monotonically_increasing_id()))


def shards_for(rows: int, parallelism: int, most: int, least: int = LEAST_ROWS) -> int:
    return max(1, ceil(rows / most), min(parallelism, rows // least))


def matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Rows of a list column as one matrix of doubles."""
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat).astype(np.float64).reshape(-1, dimension) if flat else np.zeros((0, dimension))


# Stands for a NULL id where ids are compared: it comes last.
NO_ID = np.iinfo(np.int64).max


def top_of_grid(vectors: DataFrame, queries: DataFrame, k: int,
                search: Callable[..., tuple[list, list, list]], score: str, shards: int, blocks: int,
                change: Callable[[np.ndarray], np.ndarray] = np.asarray) -> DataFrame:
    """``query_row, query_id, rank, vec_id, score``: the k best rows of all shards, higher first, ties to the smaller id.

    ``vectors`` has ``vec_id, vec, row, shard`` and ``queries`` has ``vec_id, vec, row, floor``: a score that a result
    must at least have, or NULL.  ``search(ids, rows, matrix, query_rows, query_matrix, floors, k)`` returns places of
    queries and of vectors, and scores; both matrices have gone through ``change``.  Only vectors of a query's own dimension are compared with it; its own row is
    left out, other rows with its id are not.
    """
    wide = vectors.select(F.size("vec").alias("dim"), "shard", F.col("vec_id").alias("id"), "row", F.col("vec").alias("point")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    asked = queries.select(F.size("vec").alias("dim"), block.alias("block"), F.col("vec_id").alias("query_id"),
                           F.col("row").alias("query_row"), F.col("vec").alias("query"), "floor").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        ids = pc.fill_null(left["id"], NO_ID).to_numpy()
        floors = right["floor"].to_numpy().astype(np.float64)
        found = ([], [], [])
        if len(ids) and len(floors):
            found = search(ids, left["row"].to_numpy(), change(matrix(left["point"], dim)), right["query_row"].to_numpy(),
                           change(matrix(right["query"], dim)), floors, k)
        asked_at, at = pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())
        return pa.table({"query_row": right["query_row"].take(asked_at), "query_id": right["query_id"].take(asked_at),
                         "vec_id": left["id"].take(at),
                         "score": pa.array(found[2], pa.int64() if score == "long" else pa.float64())})

    keys = ["dim", "shard", "block"]
    hits = wide.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        run, f"query_row long, query_id long, vec_id long, score {score}")
    return ranked(hits, k)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_row", "query_id", "rank", "vec_id", "score")


class Best:
    """The k best (score, -id, place) of one query so far: a heap whose top is the one to give way first."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor, self.heap = k, (-np.inf if np.isnan(floor) else floor), []

    def bar(self) -> float:
        """Scores below this can't be among the k best."""
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.k else self.floor
