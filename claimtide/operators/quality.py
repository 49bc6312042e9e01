"""Row and key checks: missing keys, conflicting attributes, empty revenue rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.functions import null_to_zero, true_only

REVENUE_MEASURES = ("total", "accrual", "cash", "total_usd", "accrual_usd", "cash_usd")


class Split(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def has_key(key: str, sentinels: Sequence[str] = ("NONE",)) -> Column:
    c = F.col(key)
    return c.isNotNull() & ~c.cast("string").isin(*sentinels)


def split_valid_keys(df: DataFrame, key: str = "oli_id",
                     sentinels: Sequence[str] = ("NONE",)) -> Split:
    """Rows with a usable key, and rows whose key is NULL or a placeholder."""
    ok = true_only(has_key(key, sentinels))
    return Split(df.filter(ok), df.filter(~ok))


def well_formed_id(key: str = "oli_id", pattern: str = r"^OL\d",
                   allowed: Sequence[str] = ("Unknown()",)) -> Column:
    c = F.col(key).cast("string")
    return c.rlike(pattern) | c.isin(*allowed)


def contains_ignore_case(c: str, text: str) -> Column:
    return F.contains(F.lower(F.col(c)), F.lit(text.lower()))


def not_zero(amount: str) -> Column:
    """Drop zero amounts but keep missing ones."""
    return ~true_only(F.col(amount) == 0)


def drop_no_impact(revenue: DataFrame, measures: Sequence[str] = REVENUE_MEASURES,
                   ticket: str = "ticket_no") -> DataFrame:
    """Drop revenue rows whose totals are all zero or missing, or without a ticket."""
    any_amount = F.lit(False)
    for m in measures:
        any_amount = any_amount | (null_to_zero(m) != 0)
    return revenue.filter(any_amount & F.col(ticket).isNotNull())


def reconciled(revenue: DataFrame, flag: str = "recon_flag") -> DataFrame:
    """Leave out top-side reconciliation adjustments."""
    return revenue.filter(F.col(flag) == "0")


def _several_values(c: Column) -> Column:
    # "More than one distinct value" needs only the least and the greatest.
    # That is one exchange with map-side combine; counting distinct values of
    # two columns would multiply the rows and exchange them twice.
    return true_only(F.min(c) < F.max(c))


def conflict_keys(revenue: DataFrame, key: str = "oli_id", test: str = "test",
                  currency: str = "currency", unknown: str = "Unknown") -> DataFrame:
    """Keys seen with more than one test or more than one currency.

    The unknown test label is no value of its own.  A missing test is (two
    tests, one of them missing, conflict), a missing currency is not.
    """
    # The unknown label must vanish without turning into a missing value.
    named = F.when(F.col(test) != unknown, F.col(test))
    test_conflict = _several_values(named) | (
        F.max(named).isNotNull() & F.bool_or(F.col(test).isNull()))
    currency_conflict = _several_values(F.col(currency))
    return (revenue.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(test_conflict.alias("test_conflict"),
                 currency_conflict.alias("currency_conflict"))
            .filter("test_conflict OR currency_conflict"))


def split_conflicts(revenue: DataFrame, key: str = "oli_id", drop: bool = True,
                    id_ok: Column | None = None, **columns: str) -> Split:
    """Error rows and the table to go on with.

    With ``drop=False`` the error rows are reported but stay in the table.
    ``id_ok`` marks well-formed ids; the others are errors as well.
    """
    bad = conflict_keys(revenue, key, **columns).select(key)
    ok = F.lit(True) if id_ok is None else true_only(id_ok)
    errors = revenue.filter(ok).join(bad, key, "left_semi")
    if id_ok is not None:
        errors = errors.unionByName(revenue.filter(~ok))
    kept = revenue.filter(ok).join(bad, key, "left_anti") if drop else revenue
    return Split(kept, errors)
