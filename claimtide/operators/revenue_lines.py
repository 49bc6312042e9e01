"""Order-line and ticket reports that start from the revenue table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.functions import label_id, label_name, month_begin_before, null_to_zero, period_label
from claimtide.operators.latest import all_present, pick_greatest, pick_least

USD_MEASURES = ("total_usd", "accrual_usd", "cash_usd")
EDGE_COLUMNS = ("period", "claim_period", "currency", "ticket_no", "in_coverage", "revenue_status",
                "tier1_payor", "tier2_payor", "tier4_payor")


def revenue_summary(revenue: DataFrame, measures: Sequence[str] = USD_MEASURES,
                    columns: Sequence[str] = EDGE_COLUMNS) -> DataFrame:
    """Sums, ticket and period counts, first and last attributes per order line.

    Tickets are counted on narrow distinct pairs and joined on the partitioning
    the summary has anyway; the wide rows are exchanged once.
    """
    columns = [c for c in columns if c in revenue.columns]
    rows = revenue.filter(F.col("oli_id").isNotNull())
    tickets = (rows.filter(F.col("ticket_no").isNotNull()).select("oli_id", "ticket_no").distinct()
               .groupBy("oli_id").agg(F.count(F.lit(1)).alias("ticket_cnt")))
    lines = rows.groupBy("oli_id").agg(
        *[null_to_zero(F.sum(m)).alias(m) for m in measures], F.count("period").alias("period_cnt"),
        pick_least(["period"], columns).alias("_first"), pick_greatest(["period"], columns).alias("_last"))
    lines = (lines.join(tickets, "oli_id", "left")
             .withColumn("ticket_cnt", F.coalesce("ticket_cnt", F.lit(0).cast("bigint"))))
    return lines.select("oli_id", *measures, "period_cnt", "ticket_cnt",
                        *[F.col(f"_first.row.{c}").alias(f"{c}_init") for c in columns],
                        *[F.col(f"_last.row.{c}").alias(f"{c}_last") for c in columns])


def oli_payment_revenue(oli: DataFrame, revenue: DataFrame) -> DataFrame:
    """Order lines with their revenue, either side alone included.

    Missing payors come from the last revenue row (name and id are read back
    from its label); a missing claim period from the delivery date.
    """
    out = oli.join(revenue_summary(revenue), "oli_id", "full")
    missing = F.col("tier1_payor").isNull()
    fills = {}
    for t in (1, 2, 4):
        last = F.col(f"tier{t}_payor_last")
        fills[f"tier{t}_payor"] = F.when(missing, last).otherwise(F.col(f"tier{t}_payor"))
        fills[f"tier{t}_payor_name"] = F.when(missing, label_name(last)).otherwise(F.col(f"tier{t}_payor_name"))
        fills[f"tier{t}_payor_id"] = (F.when(missing, label_id(last))
                                      .otherwise(F.col(f"tier{t}_payor_id").cast("string")))
    period = F.coalesce("claim_period_last", month_begin_before("delivered_dt"))
    fills["claim_period"] = period
    fills["claim_period_label"] = period_label(period)
    return out.withColumns(fills)


class TicketRevenue(NamedTuple):
    current: DataFrame
    outdated: DataFrame


def oli_ticket_revenue(transactions: DataFrame, revenue: DataFrame, oli: DataFrame,
                       since: str = "2016-01-01") -> TicketRevenue:
    """Ticket amounts with revenue: current tickets of delivered lines, and the rest.

    ``transactions``: one row per order line and ticket.  ``current`` keeps order
    lines with a current ticket delivered since the date, whether or not the
    ticket has transactions; ``outdated`` holds tickets no order line is on.
    """
    sums = (revenue.filter(all_present(["oli_id", "ticket_no"])).groupBy("oli_id", "ticket_no")
            .agg(*[null_to_zero(F.sum(m)).alias(m) for m in USD_MEASURES],
                 F.count("period").alias("period_cnt")))
    tickets = transactions.join(sums, ["oli_id", "ticket_no"], "left")
    on_line = oli.select(F.col("current_ticket_no").alias("ticket_no")).filter("ticket_no IS NOT NULL")
    outdated = tickets.join(on_line, "ticket_no", "left_anti")
    # The filters of the result belong to the order line, so they go first.
    lines = oli.filter(F.col("current_ticket_no").isNotNull()
                       & (F.col("delivered_dt") >= F.lit(since).cast("date")))
    current = tickets.join(lines.withColumn("ticket_no", F.col("current_ticket_no")),
                           ["oli_id", "ticket_no"], "right")
    return TicketRevenue(current, outdated)
