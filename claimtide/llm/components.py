"""Connected components of an edge list, by alternating large-star and small-star rounds.

Each round is two groupings with a minimum, combined on the map side, and a join; no neighbour list is gathered, so a
node linked to a third of all others is no hot group.  Stars shrink paths exponentially, so rounds grow with the
logarithm of the longest path.  Every round is a written table: lost executors can't take it with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link each node's greater (large star) or smaller (small star) neighbours to the least node around it."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = near.join(least, "u")
    if small:
        linked = linked.select("v", "m").union(least.select(F.col("u"), F.col("m")))
    else:
        linked = linked.filter(F.col("v") > F.col("u")).select("v", "m")
    return linked.toDF("a", "b").filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the least node of the component.

    Edges may repeat, run either way or join a node to itself; an edge with a NULL end is ignored.
    """
    current = staged(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    before = None
    while True:
        current = staged(_star(_star(current, small=False), small=True))
        # Done when every node hangs on its root: a star is left as it is by both steps.
        state = current.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
