"""Payor view sets: membership flags by payor id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.operators.lookup import as_lookup


def payor_view_sets(df: DataFrame, members: DataFrame, sets: Mapping[str, str],
                    prefix: str = "", column_of: Mapping[str, str] | None = None) -> DataFrame:
    """Add one column per set: '1' where the row's payor belongs to it, else NULL.

    ``members``: set_name, payor_id.  ``sets``: set name -> join column.  Sets on
    the same column share one join against one row per payor id.  With ``prefix``
    and ``column_of`` (join column -> twin column) the flags of the primary payor
    are added the same way.

    The flags depend on the payor only: apply this to the payor table, and the
    join of facts and payors brings them along.
    """
    by_column: dict[str, list[str]] = {}
    for name, column in sets.items():
        by_column.setdefault((column_of or {}).get(column, column), []).append(name)
    out = df
    for column, names in by_column.items():
        flags = (members.filter(F.col("set_name").isin(names) & F.col("payor_id").isNotNull())
                 .groupBy(F.col("payor_id").alias("_payor"))
                 .agg(*[F.max(F.when(F.col("set_name") == n, "1")).alias(prefix + n) for n in names]))
        out = out.join(as_lookup(flags), F.col(column) == F.col("_payor"), "left").drop("_payor")
    return out


def top_payor_flags(df: DataFrame, payors: DataFrame, flags: tuple[str, ...] = ("top_payors", "bcbs"),
                    key: str = "tier2_payor_id") -> DataFrame:
    """Integer payor flags from a payor list, 0 where the payor is not listed."""
    listed = F.lit(False)
    for f in flags:
        listed = listed | F.col(f).isNotNull()
    dim = payors.filter(listed & F.col(key).isNotNull()).select(key, *flags).distinct()
    return df.join(as_lookup(dim), key, "left").withColumns(
        {f: F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags})
