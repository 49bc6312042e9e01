"""One row per key, chosen by an order value.

Each function is a single ``groupBy``: every map task reduces a key to one row
before the exchange, so a key that owns a third of the input stays cheap.  The
whole payload takes part in the order, which makes the choice independent of
how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.functions import as_col


def all_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def pick_greatest(order: Sequence, payload: Sequence[str]) -> Column:
    """Aggregate: payload struct of the row with the greatest order (NULL last)."""
    return F.max(_ranked([as_col(o) for o in order], payload))


def pick_least(order: Sequence, payload: Sequence[str]) -> Column:
    """Aggregate: payload struct of the row with the least order (NULL last)."""
    ranks = [x for o in order for x in (as_col(o).isNull(), as_col(o))]
    return F.min(_ranked(ranks, payload))


def _ranked(ranks: Sequence[Column], payload: Sequence[str]) -> Column:
    return F.struct(
        F.struct(*[r.alias(f"r{i}") for i, r in enumerate(ranks)]).alias("rank"),
        F.struct(*payload).alias("row"),
    )


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence,
               columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` per key; rows with a NULL key drop out."""
    return _one_row(df, keys, order, columns, pick_greatest)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence,
              columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the least ``order`` per key; rows with a NULL key drop out."""
    return _one_row(df, keys, order, columns, pick_least)


def _one_row(df, keys, order, columns, pick):
    payload = [c for c in (columns or df.columns) if c not in keys]
    return (df.filter(all_present(keys))
            .groupBy(*keys)
            .agg(pick(order, payload).alias("_pick"))
            .select(*keys, "_pick.row.*"))


def first_and_last(df: DataFrame, keys: Sequence[str], order: Sequence,
                   columns: Sequence[str]) -> DataFrame:
    """First and last attributes side by side, suffixed ``_init`` and ``_last``."""
    out = (df.filter(all_present(keys)).groupBy(*keys)
           .agg(pick_least(order, columns).alias("_first"),
                pick_greatest(order, columns).alias("_last")))
    return out.select(
        *keys,
        *[F.col(f"_first.row.{c}").alias(f"{c}_init") for c in columns],
        *[F.col(f"_last.row.{c}").alias(f"{c}_last") for c in columns],
    )


def id_order(df: DataFrame, c: str) -> list[Column]:
    """Order for an id column; ids kept as text go by number first, then by text."""
    if dict(df.dtypes)[c] != "string":
        return [F.col(c)]
    return [F.col(c).try_cast("bigint"), F.col(c)]
