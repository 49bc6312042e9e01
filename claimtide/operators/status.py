"""Order and appeal status rules.

Conditions refer to the values as they were before the rule set; every output
is one case expression, first match wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import first_match, true_only


def delivery_fill(oli: DataFrame) -> DataFrame:
    """A line with a ticket counts as delivered; the date falls back on the date
    of service; the two cancellation reasons fill each other."""
    has_ticket = F.col("current_ticket_no").isNotNull()
    delivered = F.when((F.col("test_delivered") == 0) & has_ticket, 1).otherwise(F.col("test_delivered"))
    return oli.withColumns({
        "original_test_delivered": F.col("test_delivered"),
        "test_delivered": delivered,
        "delivered_dt": F.when((delivered == 1) & F.col("delivered_dt").isNull(), F.col("dos"))
                         .otherwise(F.col("delivered_dt")),
        "line_cancel_reason": F.coalesce("line_cancel_reason", "order_cancel_reason"),
        "order_cancel_reason": F.coalesce("order_cancel_reason", "line_cancel_reason"),
    })


def order_status(oli: DataFrame) -> DataFrame:
    """Status and notes of an order line from delivery, cancellation and failure."""
    oli = delivery_fill(oli)
    delivered, active = F.col("test_delivered") == 1, F.col("test_delivered") == 0
    order, line = F.col("order_cancel_reason"), F.col("line_cancel_reason")
    cancelled, failed = line.isNotNull(), F.col("failure_message").isNotNull()
    both_reasons = F.when(order != line, F.concat(order, F.lit(" , "), line)).otherwise(line)
    delivered_note = F.concat(F.lit("Test Delivered = "), F.col("test_delivered").cast("string"),
                              F.when(cancelled | failed, "*").otherwise(""))
    open_status = F.col("customer_status")
    open_note = F.when(~true_only(open_status.isin("Closed", "Canceled")), F.col("data_entry_status"))
    return oli.withColumns({
        "status": first_match([
            (delivered, F.lit("Delivered")),
            (active & failed, F.lit("Failed")),
            (active & cancelled, F.lit("Canceled")),
            (active, open_status)]),
        "status_notes": first_match([
            (delivered, delivered_note),
            (active & failed, F.col("failure_message")),
            (active & cancelled, both_reasons),
            (active, open_note)]),
    })


def appeal_done(status: str = "case_status_sum2"):
    return true_only(F.col(status).isin(*rules.APPEAL_DONE_STATUSES))


def appeal_result(claim: DataFrame) -> DataFrame:
    """Appeal outcome with reporting flags and the billing status it overrides."""
    success, reason = F.col("appeal_success"), F.col("appeal_den_reason")
    status, detail = F.col("case_status_sum2"), F.col("case_status")
    done = appeal_done()
    won, lost = true_only(success == "1"), true_only(success == "0")
    pending = success.isNull() & reason.isNotNull()
    removed, in_process = pending & done, pending & ~done
    closed_early = (won | lost) & ~done
    no_result = ~(won | lost | pending)

    def flag(cond):
        return F.when(cond, 1).otherwise(0)

    return claim.withColumns({
        "appeal_result": first_match([
            (won, F.lit("Success")), (lost, F.lit("Failed")),
            (removed, F.lit("Removed")), (in_process, F.lit("In Process"))]),
        "is_appeal": flag(reason.isNotNull()),
        "succeeded": flag(won),
        "failed": flag(lost),
        "completed_appeal": flag(won | lost),
        "in_process": flag(in_process),
        "removed": flag(removed),
        "case_status_sum2": first_match([
            (in_process, F.lit("Appeals")),
            (closed_early, F.lit("Final Review")),
            (no_result & true_only(status == "Appeals"), F.lit("Claim in Process"))], status),
        "case_status": F.when(closed_early, "Final Review").otherwise(detail),
    })


def appeal_result_simple(appeal: DataFrame, status_required: bool) -> DataFrame:
    """Outcome for the appeal reports, and whether the current ticket was appealed.

    The journal report asks for a billing status before it calls an appeal in
    process (``status_required``); the detail report asks for an appeal case.
    """
    success, status = F.col("appeal_success"), F.col("case_status_sum2")
    done, open_ = appeal_done(), success.isNull()
    if status_required:
        removed, pending, word = open_ & done, open_ & ~done & status.isNotNull(), "In process"
    else:
        open_ = open_ & F.col("appeal_case_no").isNotNull()
        removed, pending, word = open_ & done, open_ & ~done, "In Process"
    current, appealed = F.col("current_ticket_no"), F.col("appeal_ticket_no")
    other = current != appealed
    if status_required:
        other = current.isNotNull() & ~current.eqNullSafe(appealed)
    return appeal.withColumns({
        "current_is_appealed": F.when(current == appealed, "1").when(other, "0"),
        "appeal_result": first_match([
            (success == "1", F.lit("Success")), (success == "0", F.lit("Failed")),
            (removed, F.lit("Removed")), (pending, F.lit(word))]),
    })


def contract_accrual_flags(claim: DataFrame) -> DataFrame:
    return claim.withColumns({
        "is_contract": F.when(F.col("contracted_price").isNull(), 0).otherwise(1),
        "is_accrual": F.when(F.col("revenue_status") == "Accrual", 1).otherwise(0),
    })


def partial_paid(claim: DataFrame, impact: str = "grp_revenue_impact_adjustment") -> DataFrame:
    """Claims the vendor calls paid but that lost revenue to adjustments."""
    status = F.col("case_status")
    return claim.withColumns({
        "orig_case_status": status,
        "case_status": F.when((status == "Paid!") & (F.col(impact) > 0), "Partial Paid").otherwise(status),
    })
