"""Long ledgers: wide amounts turned into typed transaction rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import first_match, true_only
from claimtide.operators.latest import all_present
from claimtide.operators.quality import not_zero
from claimtide.operators.rollup import is_adjustment

DETAIL_METRICS = ("accrual_revenue", "cash_revenue", "accrual_usd_revenue", "cash_usd_revenue",
                  "outstanding", "payor_paid", "patient_paid", "charge")
ADJUSTMENT_KEYS = ("oli_id", "currency", "vendor_adj_code", "adj_desc", "house_adj_code",
                   "category_desc", "adj_group")


def unpivot_amounts(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    name: str = "txn_type", value: str = "txn_amount") -> DataFrame:
    """Metric columns to rows; missing and zero amounts drop out."""
    typed = df.select(*ids, *[F.col(m).cast("decimal(38,8)").alias(m) for m in metrics])
    return (typed.unpivot(list(ids), list(metrics), name, value)
            .filter(F.col(value).isNotNull() & (F.col(value) != 0)))


def adjustment_totals(payment: DataFrame, keys: Sequence[str] = ADJUSTMENT_KEYS) -> DataFrame:
    """Adjustments (normalised sign) summed by order line, currency and code."""
    return (payment.filter(is_adjustment() & all_present(keys)).groupBy(*keys)
            .agg(F.sum("txn_amount").alias("txn_amount"))
            .withColumn("txn_type", F.concat("house_adj_code", F.lit(":"), "category_desc")))


def detail_category() -> Column:
    kind = F.col("txn_type")
    return (F.when(kind.isin("accrual_usd_revenue", "cash_usd_revenue"), "USDRevenue")
            .when(kind.isin("accrual_revenue", "cash_revenue"), "Revenue")
            .when(kind.isin("charge", rules.CHARGE_ERROR_TYPE), "Billing")
            .otherwise("Receipts"))


def transaction_detail(claim: DataFrame, payment: DataFrame,
                       attributes: Sequence[str] = ()) -> DataFrame:
    """Ledger at order-line grain: eight amounts of claimed lines plus adjustments.

    ``claim`` has one row per order line; ``payment`` has normalised signs.
    Attributes of the order line are joined to every row.
    """
    claimed = (claim.filter(F.col("current_ticket_no").isNotNull()
                            & F.col("oli_id").isNotNull() & F.col("billed_currency").isNotNull())
               .withColumn("currency", F.col("billed_currency")))
    amounts = unpivot_amounts(claimed, ["oli_id", "currency"], DETAIL_METRICS)
    adjustments = adjustment_totals(payment).filter(not_zero("txn_amount"))
    ledger = (amounts.unionByName(adjustments, allowMissingColumns=True)
              .withColumn("txn_category", detail_category())
              .withColumn("txn_type", F.when(F.col("txn_type") == "outstanding", "Outstanding")
                          .otherwise(F.col("txn_type"))))
    if attributes:
        ledger = ledger.join(claim.select("oli_id", *attributes), "oli_id", "left")
    return ledger


def classed_ledger(df: DataFrame, ids: Sequence[str],
                   classes: Mapping[str, str] = rules.LEDGER_CLASSES) -> DataFrame:
    """Long order or ticket ledger: sub-type, value and class of every amount.

    Rows with a missing id column drop out, as they have no group.
    """
    metrics = [m for m in classes if m in df.columns]
    long = unpivot_amounts(df.filter(all_present(ids)), ids, metrics, "txn_subtype", "value")
    by_class: dict[str, list[str]] = {}
    for metric in metrics:
        by_class.setdefault(classes[metric], []).append(metric)
    return long.withColumn("txn_type", first_match(
        [(F.col("txn_subtype").isin(ms), F.lit(c)) for c, ms in by_class.items()]))


# journal -------------------------------------------------------------------

JOURNAL_COLUMNS = ("oli_id", "ticket_no", "txn_line", "acct_period", "txn_date", "currency",
                   "txn_amount", "txn_category", "txn_type", "vendor_adj_code", "adj_desc",
                   "house_adj_code", "adj_group")


def claim_facts(bill: DataFrame) -> DataFrame:
    """Claims as journal rows, their open balance beside them."""
    return bill.select(
        "oli_id", "ticket_no", F.lit(-1).alias("txn_line"), "acct_period", "txn_date", "currency", "txn_amount",
        F.lit("Billing").alias("txn_category"), F.lit("Charge").alias("txn_type"), F.col("ticket_balance").alias("_balance"), F.lit(True).alias("_claim"))


def journal_facts(bill: DataFrame, payment: DataFrame) -> DataFrame:
    """Claims and payments as journal rows; ``with_balances`` gives the open balances rows of their own."""
    return (claim_facts(bill).unionByName(payment_entries(payment), allowMissingColumns=True)
            .filter(not_zero("txn_amount") | has_balance()))


def has_balance() -> Column:
    """Rows of claims whose open balance makes a journal row; a missing one does."""
    return true_only(F.col("_claim") & not_zero("_balance"))


def with_balances(rows: DataFrame, period: Column) -> DataFrame:
    """All journal rows of ``journal_facts``, open balances booked on the report period."""
    amount = "decimal(38,8)"
    own = F.struct("txn_line", "acct_period", "txn_date", F.col("txn_amount").cast(amount).alias("txn_amount"),
                   "txn_category", "txn_type")
    open_ = F.struct(F.lit(-2).alias("txn_line"), F.col("_period").alias("acct_period"), F.col("_period").alias("txn_date"),
                     F.col("_balance").cast(amount).alias("txn_amount"), F.lit("Outstanding").alias("txn_category"),
                     F.lit("Outstanding").alias("txn_type"))
    entries = F.array_compact(F.array(own, F.when(has_balance(), open_)))
    own_names = ("txn_line", "acct_period", "txn_date", "txn_amount", "txn_category", "txn_type")
    rows = rows.withColumn("_period", period)
    return rows.select(*[c for c in rows.columns if c not in (*own_names, "_balance", "_claim", "_period")], F.inline(entries))


def entries(rows: DataFrame, period: Column) -> DataFrame:
    """All journal rows of ``staged_journal``'s facts: a claim's charge and open balance, a payment, revenue by type."""
    amount = "decimal(38,8)"

    def entry(line, booked, date, value, category, kind):
        names = ("txn_line", "acct_period", "txn_date", "txn_amount", "txn_category", "txn_type")
        return F.struct(*[c.alias(n) for n, c in zip(names, (line, booked, date, value.cast(amount), category, kind))])

    claim, earned, own = F.col("_kind") == 1, F.col("_kind") == 0, F.col("acct_period")
    booked = entry(F.when(claim, F.lit(-1)).otherwise(F.col("txn_line")), own, F.col("txn_date"), F.col("txn_amount"),
                   F.when(claim, F.lit("Billing")).otherwise(F.col("txn_category")),
                   F.when(claim, F.lit("Charge")).otherwise(F.col("txn_type")))
    open_ = entry(F.lit(-2), F.col("_period"), F.col("_period"), F.col("_balance"), F.lit("Outstanding"), F.lit("Outstanding"))
    shown = earned & all_present(["oli_id", "ticket_no", "acct_period"])
    kinds = [F.when(~earned & not_zero("txn_amount"), booked), F.when(claim & not_zero("_balance"), open_)]
    for m, (name, line) in REVENUE_TYPES.items():
        value = F.col(f"_{m}")
        kinds.append(F.when(shown & value.isNotNull() & (value != 0), entry(F.lit(line), own, own, value, F.lit("Revenue"), F.lit(name))))
    spent = ("txn_line", "acct_period", "txn_date", "txn_amount", "txn_category", "txn_type", "_period")
    rows = rows.withColumn("_period", period)
    return rows.select(*[c for c in rows.columns if c not in spent], F.inline(F.array_compact(F.array(*kinds))))


def payment_entries(payment: DataFrame, *more: Column) -> DataFrame:
    """Payments and adjustments, typed; refunds and charge errors change category.  ``more`` columns come last."""
    kind, code = F.col("txn_type"), F.col("vendor_adj_code")
    coded = F.concat("house_adj_code", F.lit(":"), "category_desc")
    refund = true_only(code.isin(*rules.REFUND_CODES))
    error = true_only(code.isin(*rules.CHARGE_ERROR_CODES))
    return payment.select(
        "oli_id", "ticket_no", "txn_line", "acct_period", "txn_date", "currency", "txn_amount",
        first_match([(refund, F.lit("Payment")), (error, F.lit("Billing")),
                     (kind.isin(*rules.PAYMENT_TYPES), F.lit("Payment")),
                     (is_adjustment(), F.lit("Adjustment"))]).alias("txn_category"),
        first_match([(refund | error | is_adjustment(), coded),
                     (kind == rules.INSURER_PAID, F.lit("PayorPaid")),
                     (kind == rules.PATIENT_PAID, F.lit("PatientPaid"))], kind).alias("txn_type"),
        "vendor_adj_code", "adj_desc", "house_adj_code", "adj_group", *more)


# Type and line number of the journal's revenue rows.
REVENUE_TYPES = {"accrual": ("AccrualRevenue", -3), "cash": ("CashRevenue", -4)}


def revenue_entries(revenue: DataFrame, agg: str = "sum",
                    metrics: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """Recognised revenue per order line, ticket and period as journal rows.

    The default sums several rows of a key, so that the journal reconciles with
    the period report; ``agg='mean'`` averages them.
    """
    metrics = metrics or REVENUE_TYPES
    keys = ["oli_id", "ticket_no", "period"]
    total = {"sum": F.sum, "mean": F.avg}[agg]
    sums = (revenue.filter(all_present(keys)).groupBy(*keys)
            .agg(*[total(m).alias(name) for m, (name, _) in metrics.items()]))
    return revenue_rows(sums, metrics)


def revenue_rows(sums: DataFrame, metrics: Mapping[str, tuple[str, int]] = REVENUE_TYPES,
                 kept: Sequence[str] = ()) -> DataFrame:
    """Journal rows from revenue per order line, ticket and period, a column for each type; ``kept`` columns stay."""
    long = unpivot_amounts(sums, ["oli_id", "ticket_no", "period", *kept], [name for name, _ in metrics.values()])
    line = first_match([(F.col("txn_type") == name, F.lit(no)) for name, no in metrics.values()])
    return long.select("oli_id", "ticket_no", line.alias("txn_line"), F.col("period").alias("acct_period"),
                       F.col("period").alias("txn_date"), "txn_amount",
                       F.lit("Revenue").alias("txn_category"), "txn_type", *kept)


def base_revenue(totals: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Journal rows from revenue sums by order line, ticket and ``acct_period``; ``kept`` columns stay."""
    return revenue_rows(totals.select(
        "oli_id", "ticket_no", F.col("acct_period").alias("period"),
        *[F.col(f"{m}_revenue").alias(name) for m, (name, _) in REVENUE_TYPES.items()], *kept), kept=kept)


def report_period(*periods: DataFrame) -> Column:
    """Latest period over one-column frames, as a scalar subquery."""
    latest = [p.agg(F.max(p.columns[0]).alias("period")) for p in periods]
    out = latest[0]
    for p in latest[1:]:
        out = out.unionByName(p)
    return out.agg(F.max("period")).scalar()


def ticket_journal(bill: DataFrame, payment: DataFrame, revenue: DataFrame, period: Column,
                   agg: str = "sum", totals: DataFrame | None = None) -> DataFrame:
    """Transaction journal: what happened to a ticket in which period, zeros left out.

    ``payment`` has normalised signs.  ``totals`` are revenue sums by order line, ticket and ``acct_period``, where they
    exist already: the revenue file is not read again then.
    """
    if totals is None or agg != "sum":
        earned = revenue_entries(revenue, agg)
    else:
        earned = base_revenue(totals.filter(all_present(["oli_id", "ticket_no", "acct_period"])))
    rows = with_balances(journal_facts(bill, payment), period).unionByName(earned, allowMissingColumns=True)
    return rows.filter(not_zero("txn_amount")).select(*JOURNAL_COLUMNS)


# journal with sub-categories ----------------------------------------------

def criteria_payment_entries(payment: DataFrame) -> DataFrame:
    """Older journal layout: sub-category, coded type and description per row.

    Takes vendor signs; payments, refunds and adjustments are negated here,
    charges in error are not.
    """
    kind, code = F.col("txn_type"), F.col("vendor_adj_code")
    refund = true_only(code.isin(*rules.REFUND_CODES))
    error = true_only(code.isin(*rules.CHARGE_ERROR_CODES))
    paid = kind.isin(*rules.PAYMENT_TYPES)
    paid_text = first_match([(kind == rules.INSURER_PAID, F.lit("PayorPaid")),
                             (kind == rules.PATIENT_PAID, F.lit("PatientPaid"))])
    coded = F.concat("house_adj_code", F.lit(" : "), "category_desc")
    optional = [c for c in ("payment_company_vendor", "payment_plan_vendor", "payment_company_house",
                            "payment_plan_house", "payment_fc", "is_primary_payment")
                if c in payment.columns]
    return payment.select(
        "oli_id", "ticket_no", "txn_line", "acct_period",
        F.when(~error & (paid | is_adjustment() | refund), -F.col("txn_amount"))
         .otherwise(F.col("txn_amount")).alias("txn_amount"),
        F.when(error, "Billing").otherwise("Receipts").alias("txn_category"),
        first_match([(refund, F.lit("Payment")), (error, F.lit("Charged in Error")),
                     (is_adjustment(), F.lit("Adjustment")), (paid, F.lit("Payment"))]).alias("txn_subcategory"),
        first_match([(refund, F.lit("RR")), (error, F.lit("CIE")),
                     (is_adjustment(), F.col("house_adj_code"))], kind).alias("txn_type"),
        first_match([(refund, F.lit("Refund")), (error, F.lit("Charged in Error")),
                     (is_adjustment(), coded)], paid_text).alias("txn_type_desc"),
        F.coalesce(paid_text, "adj_desc").alias("adj_desc"),
        "vendor_adj_code", "house_adj_code", "adj_group", *optional)


# Type and sub-category of the revenue rows in this layout.
CRITERIA_REVENUE = {
    "accrual": ("AccrualRevenue", "FA", "Revenue", "Accrual"),
    "cash": ("CashRevenue", "FC", "Revenue", "Cash"),
    "accrual_usd": ("USDAccrualRevenue", "FAU", "USDRevenue", "USDAccrual"),
    "cash_usd": ("USDCashRevenue", "FCU", "USDRevenue", "USDCash"),
}


def ticket_journal_criteria(bill: DataFrame, payment: DataFrame, revenue: DataFrame,
                            agg: str = "sum") -> DataFrame:
    """Journal in the older layout, with local and USD revenue and payment insurers."""
    claims = bill.select("oli_id", "ticket_no", "txn_line", "acct_period", "txn_amount", "txn_type",
                         F.lit("Billing").alias("txn_category"), F.lit("Charges").alias("txn_subcategory"),
                         F.lit("Claim Amount").alias("txn_type_desc"))
    open_ = bill.select("oli_id", "ticket_no", "txn_line", "acct_period",
                        F.col("ticket_balance").alias("txn_amount"), F.lit("RO").alias("txn_type"),
                        F.lit("Receipts").alias("txn_category"), F.lit("Outstanding").alias("txn_subcategory"),
                        F.lit("Outstanding").alias("txn_type_desc"), F.lit("Outstanding").alias("adj_desc"))
    entries = revenue_entries(revenue, agg, {m: (v[0], -1) for m, v in CRITERIA_REVENUE.items()})
    kind = F.col("txn_type_desc")
    money_in = (entries.drop("txn_date", "txn_category").withColumnRenamed("txn_type", "txn_type_desc")
                .withColumns({c: first_match([(kind == v[0], F.lit(v[i])) for v in CRITERIA_REVENUE.values()])
                              for i, c in ((1, "txn_type"), (2, "txn_category"), (3, "txn_subcategory"))}))
    rows = criteria_payment_entries(payment)
    for other in (claims, open_, money_in):
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows.filter(not_zero("txn_amount"))
