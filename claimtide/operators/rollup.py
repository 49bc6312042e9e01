"""Amounts rolled up to the order line.

Every source is summed over its own few columns first.  The sums, one row per
key and source, meet in a union that keeps their common partitioning, so the
rows of a key are merged where they are: no wide exchange, no outer join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import flip_sign, half_even, null_to_zero, snake, true_only
from claimtide.operators.latest import all_present, pick_greatest
from claimtide.operators.lookup import as_lookup
from claimtide.operators.quality import REVENUE_MEASURES

def is_adjustment() -> Column:
    return F.col("txn_type").isin(*rules.ADJUSTMENT_TYPES)


def normalise_payment_sign(payment: DataFrame, amount: str = "txn_amount") -> DataFrame:
    """Payments and adjustments become positive; charge-error rows keep their sign."""
    charge_error = true_only(F.col("vendor_adj_code").isin(*rules.CHARGE_ERROR_CODES))
    flip = F.col("txn_type").isin(*rules.PAYMENT_TYPES) | (is_adjustment() & ~charge_error)
    return payment.withColumn(
        amount, F.when(true_only(flip), flip_sign(amount)).otherwise(F.col(amount)))


def normalise_bill_sign(bill: DataFrame) -> DataFrame:
    return bill.withColumns({c: flip_sign(c) for c in ("amt_received", "amt_adjusted")})


# Columns that a code table may ask for.  Conditional sums take one exchange and combine on the map side; a table with
# more values than this is no list of codes.
MOST_COLUMNS = 500


def group_columns(groups: Sequence[str], prefix: str = "grp_") -> dict[str, str]:
    """Column of each value; values whose names would be the same are numbered."""
    out: dict[str, str] = {}
    for g in dict.fromkeys(groups):
        name, wanted, n = prefix + snake(g), prefix + snake(g), 1
        while name in out.values():
            n += 1
            name = f"{wanted}_{n}"
        out[g] = name
    return out


class CodeColumns(NamedTuple):
    """Values that get a column of their own."""

    groups: tuple[str, ...]
    categories: tuple[str, ...]


def code_columns(codes: DataFrame, fixed: Sequence[str] = rules.ADJUSTMENT_GROUPS,
                 most: int = MOST_COLUMNS) -> CodeColumns:
    """The adjustment groups and categories of the code table, read once while the plan is built.

    ``codes``: adj_group, category_desc.  ``fixed`` groups come first and are there even if no code is in them, as rules
    use them; NULL is no value.  A code that is added to the table appears in the reports without any other change.
    """
    pairs = codes.select(F.explode(F.array(
        F.struct(F.lit("g").alias("kind"), F.col("adj_group").alias("value")),
        F.struct(F.lit("c").alias("kind"), F.col("category_desc").alias("value")))).alias("e"))
    listed = pairs.select("e.kind", "e.value").filter("value is not null").distinct().limit(most + 1).collect()
    if len(listed) > most:
        raise ValueError(f"more than {most} groups and categories in the code table")
    values = {k: sorted(r.value for r in listed if r.kind == k) for k in "gc"}
    return CodeColumns(tuple(dict.fromkeys([*fixed, *values["g"]])), tuple(values["c"]))


def payment_measures(groups: Sequence[str] = rules.ADJUSTMENT_GROUPS,
                     categories: Sequence[str] = (), amount: str = "txn_amount") -> dict[str, Column]:
    """Row-level measures: the amount where the row belongs to the measure."""
    a, kind = F.col(amount), F.col("txn_type")
    out = {
        "payor_paid": F.when(kind == rules.INSURER_PAID, a),
        "patient_paid": F.when(kind == rules.PATIENT_PAID, a),
        "adjusted": F.when(is_adjustment(), a),
    }
    for values, by, prefix in ((groups, "adj_group", "grp_"), (categories, "category_desc", "cat_")):
        for value, name in group_columns(values, prefix).items():
            out[name] = F.when(is_adjustment() & (F.col(by) == value), a)
    return out


def sum_or_zero(name: str) -> Column:
    return null_to_zero(F.sum(name)).alias(name)


def merge_rollups(parts: Sequence[DataFrame], keys: Sequence[str],
                  keep_null: Sequence[str] = ()) -> DataFrame:
    """One row per key from rollups of the same keys with different measures.

    Equals the full outer join of the parts with missing amounts as 0, except
    for ``keep_null`` columns.
    """
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    names = [c for c in rows.columns if c not in keys]
    merged = rows.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])
    return merged.withColumns({n: null_to_zero(n) for n in names if n not in keep_null})


def receipt_rollup(bill: DataFrame, payment: DataFrame,
                   groups: Sequence[str] = rules.ADJUSTMENT_GROUPS,
                   categories: Sequence[str] = (), key: str = "oli_id",
                   with_allowed: bool = False) -> DataFrame:
    """Charge, receipts, adjustments and balance per order line.

    Takes rows with valid keys and vendor signs.  Adjustments are laid out by
    group and, where asked for, by category.  Billed, payment and adjustment
    totals are net of charges in error and refunds.  ``with_allowed`` adds the
    greatest allowed amount of the insurer payments in the same pass.
    """
    bill = normalise_bill_sign(bill).filter(F.col(key).isNotNull())
    payment = normalise_payment_sign(payment).filter(F.col(key).isNotNull())
    charges = bill.groupBy(key).agg(
        F.sum("txn_amount").alias("charge"), F.sum("amt_received").alias("received"),
        F.sum("amt_adjusted").alias("claim_adjusted"), F.sum("ticket_balance").alias("outstanding"))
    allowed = F.max(F.when(is_allowed(flipped=True), F.col("allowed_amt"))).alias("allowed_amt")
    receipts = payment.groupBy(key).agg(
        *[F.sum(c).alias(n) for n, c in payment_measures(groups, categories).items()],
        *([allowed] if with_allowed else []))
    out = merge_rollups([charges, receipts], [key], keep_null=["allowed_amt"])
    by_group = group_columns(groups)
    error, refund = F.col(by_group[rules.CHARGED_IN_ERROR]), F.col(by_group[rules.REFUND])
    return out.withColumns({
        "total_billed": F.col("charge") + error,
        "total_payment": F.col("received") + refund,
        "total_adjustment": half_even(F.col("adjusted") - error - refund, 2),
    })


def revenue_rollup(revenue: DataFrame, keys: Sequence[str] = ("oli_id",),
                   measures: Sequence[str] = REVENUE_MEASURES,
                   last: Sequence[str] = ("currency",)) -> DataFrame:
    """Revenue sums with number and range of periods and the last row's attributes."""
    out = (revenue.filter(all_present(keys)).groupBy(*keys)
           .agg(*[null_to_zero(F.sum(m)).alias(f"{m}_revenue") for m in measures],
                F.count("period").alias("period_cnt"),
                F.min("period").alias("period_init"),
                F.max("period").alias("period_last"),
                pick_greatest(["period"], last).alias("_last")))
    return out.select("*", "_last.row.*").drop("_last")


def fill_list_price(oli: DataFrame, prices: DataFrame) -> DataFrame:
    """Standard price where the order line has none.  ``prices``: test,
    billed_currency, std_list_price, one row per pair."""
    return (oli.join(as_lookup(prices), ["test", "billed_currency"], "left")
            .withColumn("list_price", F.coalesce("list_price", "std_list_price"))
            .drop("std_list_price"))


def is_allowed(flipped: bool) -> Column:
    """Insurer payments proper: take-backs have the other sign."""
    paid = F.col("txn_amount") > 0 if flipped else F.col("txn_amount") < 0
    return (F.col("txn_type") == rules.INSURER_PAID) & paid


def allowed_amount(payment: DataFrame, flipped: bool = True) -> DataFrame:
    """Greatest allowed amount of the insurer payments per order line.

    ``flipped`` tells whether paid amounts are positive already.
    """
    return (payment.filter(is_allowed(flipped) & F.col("oli_id").isNotNull())
            .groupBy("oli_id").agg(F.max("allowed_amt").alias("allowed_amt")))


class PaymentSplit(NamedTuple):
    """Insurer payments of lines with a one-payment ticket, and all others."""

    single: DataFrame
    multiple: DataFrame


def payment_events(payment: DataFrame) -> DataFrame:
    """Number of insurer payment rows per order line, test and ticket."""
    keys = ["oli_id", "test", "ticket_no"]
    return (payment.filter((F.col("txn_type") == rules.INSURER_PAID) & all_present(keys))
            .groupBy(*keys).agg(F.count("txn_date").alias("row_cnt")))


def single_payment_share(payment: DataFrame) -> DataFrame:
    """Share of tickets that were settled by one insurer payment."""
    return payment_events(payment).agg(
        F.avg(F.when(F.col("row_cnt") == 1, 1.0).otherwise(0.0)).alias("single_share"))


def single_multi_payment_split(payment: DataFrame) -> PaymentSplit:
    """Split insurer payments by whether the order line has a one-payment ticket.

    Single rows get ``payor_paid`` and a comparison amount: paid plus
    deductible plus coinsurance.
    """
    single_keys = payment_events(payment).filter("row_cnt = 1").select("oli_id").distinct()
    paid = payment.filter(F.col("txn_type") == rules.INSURER_PAID)
    single = paid.join(single_keys, "oli_id", "left_semi")
    single = single.withColumn("payor_paid", -F.col("txn_amount")).drop("txn_amount")
    single = single.withColumn("compare_amt", null_to_zero("payor_paid")
                               + null_to_zero("deductible_amt") + null_to_zero("coins_amt"))
    return PaymentSplit(single, paid.join(single_keys, "oli_id", "left_anti"))


def abandoned_appeals(payment: DataFrame, bill: DataFrame,
                      code: str = rules.ABANDONED_APPEAL_CODE) -> DataFrame:
    """Bills of the order lines written off for an abandoned appeal, with the
    number of such write-offs."""
    lines = (payment.filter((F.col("vendor_adj_code") == code) & F.col("oli_id").isNotNull())
             .groupBy("oli_id").agg(F.count(F.lit(1)).alias("write_off_cnt")))
    return bill.join(lines, "oli_id", "inner")
