"""Raw extracts to base tables: types, ids, labels and fills.

Extracts hold text and floats.  Every step applies to the columns that an extract has, so that partial extracts load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import (
    float_id, label, money, parse_date, parse_datetime, parse_float_date, parse_month, zero_to_null)
from claimtide.operators.risk import standardise_reporting_group
from claimtide.sources.contract import Contract, Field, apply_contract

ORDER_MONEY = ("billed_amount", "list_price", "total_payment", "payor_paid", "patient_paid", "total_adjustment",
               "outstanding", "contracted_price")
ORDER_FLOAT_DATES = ("delivered_dt", "dos")
ORDER_DATES = ("order_start_dt", "line_start_dt", "order_cancel_dt", "line_cancel_dt")
REVENUE_DATES = ("period", "claim_period", "delivered_dt")
# What stands for a missing value.
NO_ORDER_LINE = rules.NO_ORDER_LINE
ORDER_FILLS = {"risk_group": "Unknown", "gleason": "", "stage": ""}


def _with(df: DataFrame, columns: dict) -> DataFrame:
    return df.withColumns({c: value for c, value in columns.items() if c in df.columns})


def _labels(df: DataFrame) -> DataFrame:
    """``Name (ID)`` of each payor tier whose name and id there are."""
    return df.withColumns({
        f"tier{t}_payor": label(f"tier{t}_payor_name", f"tier{t}_payor_id") for t in (1, 2, 4)
        if {f"tier{t}_payor_name", f"tier{t}_payor_id"} <= set(df.columns)})


def load_order_line(raw: DataFrame) -> DataFrame:
    """Order lines: zero amounts are missing, dates and the ticket number lose their float form."""
    out = _with(raw, {c: zero_to_null(money(c)) for c in ORDER_MONEY}
                | {c: parse_float_date(c) for c in ORDER_FLOAT_DATES} | {c: parse_date(c) for c in ORDER_DATES}
                | {"current_ticket_no": float_id("current_ticket_no")}
                | {c: F.coalesce(F.col(c), F.lit(v)) for c, v in ORDER_FILLS.items()})
    out = _labels(out)
    return standardise_reporting_group(out) if {"reporting_group", "nodal_status", "test"} <= set(out.columns) else out


def load_revenue(raw: DataFrame, ins_codes: DataFrame | None = None) -> DataFrame:
    """Revenue rows: dates, payor labels, and ``NONE`` for a missing order line; the vendor's category by payor.

    ``ins_codes``: tier4_payor_id, vendor_fc; of several rows for a payor the greatest code holds.
    """
    out = _with(raw, {c: parse_date(F.substring(F.col(c).cast("string"), 1, 10), "yyyy-MM-dd") for c in REVENUE_DATES}
                | {"oli_id": F.coalesce(F.col("oli_id").cast("string"), F.lit(NO_ORDER_LINE)),
                   "ticket_no": float_id("ticket_no")})
    out = _labels(out)
    if ins_codes is None:
        return out
    codes = (ins_codes.filter(F.col("tier4_payor_id").isNotNull()).groupBy("tier4_payor_id")
             .agg(F.max("vendor_fc").alias("vendor_fc")))
    return out.join(codes, "tier4_payor_id", "left")


def load_case(raw: DataFrame) -> DataFrame:
    """Claim cases: dates, the entry month, ids as whole numbers in text, and the time a case was added."""
    whole = {c: F.col(c).try_cast("double").try_cast("bigint").cast("string") for c in ("case_no", "ticket_no")}
    out = _with(raw, {"update_dt": parse_date("update_dt"), "entry_month": parse_month(
        F.col("entry_month").try_cast("double").try_cast("bigint").cast("string"), "yyyyMM")} | whole)
    if {"added_date", "added_time"} <= set(out.columns):
        out = out.withColumn("added_ts", parse_datetime("added_date", "added_time")).drop("added_date", "added_time")
    return out


# Contracts of the appeal and prior-authorisation extracts.
APPEAL = (
    Field("case_number", "appeal_case_no"), Field("level", "level_code"), Field("status", "appeal_status"),
    Field("status_desc", "appeal_status_desc"), Field("entry_date", "entry_dt", "date"),
    Field("denial_letter_date", "denial_dt", "date"), Field("letter_date", "letter_dt", "date"),
    Field("denial_reason", "den_reason", "code"), Field("denial_reason_desc", "den_reason_desc"),
    Field("insurer_code", "ins_code"), Field("campaign", "campaign_code"))
COMPLETE_APPEAL = (
    Field("ticket_number", "appeal_ticket_no"), Field("case_number", "appeal_case_no"), Field("request_number", "appeal_request_no"),
    Field("accession", "accession"), Field("test_code", "test", "test"), Field("service_date", "appeal_dos", "date"),
    Field("insurer_code", "appeal_ins_code"), Field("insurer_category", "appeal_ins_fc"),
    Field("denial_reason", "appeal_den_reason", "whole"), Field("denial_reason_desc", "appeal_den_reason_desc"),
    Field("amount_charged", "appeal_amt_charged", "money"), Field("amount_expected", "appeal_amt_expected", "money"),
    Field("amount_allowed", "appeal_amt_allowed", "money"), Field("amount_received", "appeal_amt_received", "money"),
    Field("amount", "appeal_amt", "money"), Field("amount_applied", "appeal_amt_applied", "money"),
    Field("report_date", "appeal_report_dt", "date"), Field("success", "appeal_success", "whole"),
    Field("currency", "appeal_currency"))
PRIOR_AUTH = (
    Field("case_number", "prior_auth_case_no"), Field("entered_date", "prior_auth_entered_dt", "date"),
    Field("result", "prior_auth_result"), Field("request", "prior_auth_req_desc"), Field("number", "prior_auth_number"),
    Field("category", "prior_auth_category"))


def load_appeal(raw: DataFrame) -> Contract:
    """Appeal cases by level: dates, and denial reasons without leading zeros."""
    return apply_contract(raw, APPEAL)


def load_complete_appeal(raw: DataFrame) -> Contract:
    """Completed appeals: ids as text, test labels, amounts, dates, success and reason as whole numbers in text."""
    return apply_contract(raw, COMPLETE_APPEAL)


def load_prior_auth(raw: DataFrame) -> Contract:
    """Prior authorisations, the case number as text."""
    return apply_contract(raw, PRIOR_AUTH)
