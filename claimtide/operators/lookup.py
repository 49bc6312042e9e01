"""Joins against lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Compressed columns grow when they are decoded and hashed.
GROWTH = 20
# A lookup table meets facts of which it saves an exchange, so it may be larger than the session's limit for any join.
MOST_BYTES = 512 << 20


def input_bytes(df: DataFrame) -> int:
    """Size of the inputs of ``df``, as its plan knows them; an input counts each time it is read."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def as_lookup(df: DataFrame) -> DataFrame:
    """Mark a lookup table for broadcast if its inputs are small enough.

    A lookup built of joins has no useful size estimate (Spark multiplies the
    sizes of both sides), so it would be shuffled against the facts however
    small it is.  Its rows are at most those of its first input, as every join in
    it is on a unique key.  So the sizes of its inputs, read from the plan, bound
    it.  Above ``MOST_BYTES`` and the session's broadcast limit, or where the
    session allows no broadcast, the table is left as it is: a shuffled join,
    with hot keys split at run time.
    """
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return F.broadcast(df) if limit > 0 and input_bytes(df) * GROWTH <= max(limit, MOST_BYTES) else df


def _bytes(text: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = text.strip().lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)
