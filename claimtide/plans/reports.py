"""The report tables, each a function of standardised claims tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.operators import (appeals, ledger, period, policy, quality, reference, revenue_lines, rollup,
                                 standardise, status, views)
from claimtide.plans import columns as C
from claimtide.session import stage
from claimtide.sources import Control, ROWS_PER_FILE, log_controls, write_ordered


@dataclass(frozen=True)
class ClaimTables:
    """Standardised inputs.  ``bill`` and ``payment`` keep the vendor's signs."""

    bill: DataFrame
    payment: DataFrame
    claim_case: DataFrame
    oli: DataFrame
    revenue: DataFrame
    payors: DataFrame
    appeal: DataFrame | None = None
    appeal_wide: DataFrame | None = None
    prior_auth: DataFrame | None = None
    specimen: DataFrame | None = None
    somn: DataFrame | None = None
    prices: DataFrame | None = None
    view_members: DataFrame | None = None
    view_sets: Mapping[str, str] | None = None
    adjustment_code: DataFrame | None = None


def project(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that the inputs supply, in the wanted order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(wanted) if c in have])


def with_view_sets(df: DataFrame, t: ClaimTables) -> DataFrame:
    return df if t.view_members is None else views.payor_view_sets(df, t.view_members, t.view_sets)


def flagged_payors(t: ClaimTables) -> DataFrame:
    """The payor table with its view sets: facts get the flags with their payor."""
    return with_view_sets(t.payors, t)


def view_columns(t: ClaimTables, prefix: str = "") -> list[str]:
    return [prefix + s for s in (t.view_sets or {})]


def _left(df: DataFrame, other: DataFrame | None, on) -> DataFrame:
    return df if other is None else df.join(other, on, "left")


# R1 - R7: order line -------------------------------------------------------

def claim_to_revenue(t: ClaimTables) -> DataFrame:
    """From order to cash: one row per order line.

    All joins of the wide rows are on the order line and share its partitioning,
    or are with small dimensions: prior authorisations meet the numbers of
    current cases before, and the appeals of an order line come as an array, of
    which those of the current ticket stay.  Adjustments have a column for every
    group and category of the code table, where there is one.
    """
    bill = quality.split_valid_keys(t.bill).kept
    payment = quality.split_valid_keys(t.payment).kept
    groups, categories = (rules.ADJUSTMENT_GROUPS, ()) if t.adjustment_code is None else rollup.code_columns(t.adjustment_code)
    receipts = rollup.receipt_rollup(bill, payment, groups, categories, with_allowed=True)
    earned = rollup.revenue_rollup(quality.reconciled(t.revenue)).withColumnRenamed("currency", "revenue_currency")
    # Revenue is shown for order lines the vendor has receipts of.
    amounts = receipts.join(earned, "oli_id", "left")
    names = {"current_ticket_no": "bi_current_ticket_no"}
    taken = ("case_status_sum1", "case_status_sum2", "case_status_code", "case_status", "vendor_dos", "plan", *C.TIERS,
             "financial_category", "line_of_benefit")
    oli = t.oli.drop(*taken).withColumnsRenamed(names)
    ref = reference.current_reference(t.bill, t.claim_case)
    auth = {}
    if t.prior_auth is not None:
        auth = {c: f"_auth_{c}" for c in t.prior_auth.columns}
    out = oli.join(ref, "oli_id", "left")
    if auth:
        # Only the current case's number travels to the authorisations, and they come back by order line.
        current = ref.select("oli_id", "current_case_no").join(
            t.prior_auth.withColumnsRenamed(auth), F.col("current_case_no") == F.col("_auth_prior_auth_case_no"))
        out = out.join(current.drop("current_case_no"), "oli_id", "left")
    out = out.join(amounts, "oli_id", "left")
    out = _left(_left(out, t.specimen, "oli_id"), t.somn, "oli_id")
    if t.prices is not None:
        out = rollup.fill_list_price(out, t.prices)
    out = reference.attach_payor_hierarchies(reference.claim_flags(out), flagged_payors(t))
    out = status.order_status(reference.reroute_flags(out))
    if t.appeal_wide is not None:
        out = status.appeal_result(with_current_appeals(out, t.appeal_wide))
    out = status.partial_paid(status.contract_accrual_flags(out))
    # An authorisation belongs to a current case; named here, so that both branches read the same rows of cases.
    known = F.col("current_case_no").isNotNull()
    return out.select(*[c for c in out.columns if c not in auth.values()], *[F.when(known, F.col(v)).alias(c) for c, v in auth.items()])


def with_current_appeals(lines: DataFrame, appeal_wide: DataFrame) -> DataFrame:
    """Order lines left-joined with the appeals of their current ticket, in place where they are dealt by order line."""
    own = [c for c in appeal_wide.columns if c not in ("accession", "appeal_ticket_no")]
    of_line = (appeal_wide.filter(F.col("accession").isNotNull() & F.col("appeal_ticket_no").isNotNull())
               .groupBy(F.col("accession").alias("oli_id")).agg(F.collect_list(F.struct("appeal_ticket_no", *own)).alias("_appeals")))
    out = lines.join(of_line, "oli_id", "left")
    current = F.filter("_appeals", lambda a: a["appeal_ticket_no"] == F.col("current_ticket_no"))
    shown = ["oli_id", "current_ticket_no", *[c for c in lines.columns if c not in ("oli_id", "current_ticket_no")]]
    return out.withColumn("_appeals", current).select(*shown, F.inline_outer("_appeals")).drop("appeal_ticket_no")


def oli_transactions(claim: DataFrame, t: ClaimTables) -> DataFrame:
    """Ledger at order-line grain with attributes and payor view sets."""
    payment = rollup.normalise_payment_sign(quality.split_valid_keys(t.payment).kept)
    wanted = [*C.LEDGER_ATTRIBUTES, *view_columns(t), *view_columns(t, "primary_")]
    return ledger.transaction_detail(claim, payment, [c for c in wanted if c in claim.columns])


def managed_care(claim: DataFrame, t: ClaimTables) -> DataFrame:
    out = project(claim, [*C.MANAGED_CARE, *view_columns(t)])
    return out.withColumns({f"{c}_": F.col(c) for c in C.MANAGED_CARE_TWICE if c in out.columns})


def appeal_extract(claim: DataFrame, t: ClaimTables, test: str) -> DataFrame:
    return project(claim.filter(F.col("test") == test), [*C.APPEAL_EXTRACT, *view_columns(t, "primary_")])


def payment_risk(claim: DataFrame, business_unit: str = "Domestic") -> DataFrame:
    return project(claim.filter(F.col("business_unit") == business_unit), C.PAYMENT_RISK)


def domestic_billing(claim: DataFrame, business_unit: str = "Domestic") -> DataFrame:
    return project(claim.filter(F.col("business_unit") == business_unit), C.DOMESTIC_BILLING)


def appeals_detail(claim: DataFrame, test: str, business_unit: str = "Domestic") -> DataFrame:
    """Appealed order lines of one test under the headers of the appeals report."""
    rows = claim.filter((F.col("business_unit") == business_unit) & (F.col("test") == test)
                        & F.col("appeal_result").isNotNull())
    clinical = C.APPEALS_DETAIL_CLINICAL[test]
    wanted = {**C.APPEALS_DETAIL, clinical: clinical}
    return rows.select(*[F.col(c).alias(n) for c, n in wanted.items() if c in rows.columns])


# R8 - R10: ticket and period -----------------------------------------------

def period_base(t: ClaimTables, oli_columns: Sequence[str] = ()) -> DataFrame:
    """One pass over bills, payments and revenue, written, for the monthly report."""
    return period.staged_base(t.bill, t.payment, quality.reconciled(t.revenue),
                              lines=period.line_attributes(t.oli, oli_columns))


def accounting_period(t: ClaimTables, oli_columns: Sequence[str] = (), flip_after: bool = False,
                      base: DataFrame | None = None, wanted: Sequence[str] | None = None) -> DataFrame:
    """Payor monthly report.  ``flip_after`` gives the criteria layout, which has a base of its own; of a base of its own,
    only what the columns ``wanted`` need is written, if not all are."""
    revenue = quality.reconciled(t.revenue)
    return period.period_report(t.bill, t.payment, revenue, t.oli, flagged_payors(t), oli_columns=oli_columns,
                                flip_after=flip_after, base=None if flip_after else base, wanted=wanted)


def journal_rows(t: ClaimTables, oli_columns: Sequence[str] = (), agg: str = "sum", payor_of: str | None = None) -> DataFrame:
    """One pass over bills, payments and revenue, written: the journals of the same columns share it, unless ``payor_of`` names one."""
    return period.staged_journal(t.bill, rollup.normalise_payment_sign(t.payment), quality.reconciled(t.revenue),
                                 period.line_attributes(t.oli, oli_columns), t.prior_auth, agg, payor_of)


def ticket_journal(t: ClaimTables, version: int = 2, oli_columns: Sequence[str] = (), agg: str = "sum",
                   rows: DataFrame | None = None) -> DataFrame:
    """Ticket transactions; version 1 by the payor of the claim, 2 by the payor
    of the revenue file, with prior authorisation and payor view sets."""
    payor_of = "revenue" if version == 2 else "claim"
    if rows is None:
        rows = journal_rows(t if version == 2 else replace(t, prior_auth=None), oli_columns, agg, payor_of)
    return period.attributed_journal(rows, flagged_payors(t) if version == 2 else t.payors, payor_of=payor_of)


def ticket_journal_criteria(t: ClaimTables) -> DataFrame:
    return ledger.ticket_journal_criteria(t.bill, t.payment, quality.reconciled(t.revenue))


# R11: appeals --------------------------------------------------------------

class AppealReports(NamedTuple):
    lines: DataFrame
    cases: DataFrame
    detail: DataFrame


def appeal_reports(t: ClaimTables, payor_columns: Sequence[str], status_columns: Sequence[str],
                   top_payors: DataFrame | None = None) -> AppealReports:
    """Appealed order lines, appeal cases, and the appeal detail of order lines."""
    header = appeals.ticket_payor_header(t.revenue, t.oli, payor_columns, status_columns)
    known = header.filter(F.col("ticket_no").isNotNull())
    on = ["oli_id", "ticket_no"]
    cases = t.appeal.withColumns({"oli_id": F.col("accession"), "ticket_no": F.col("appeal_ticket_no")})
    cases = status.appeal_result_simple(cases.join(known, on, "inner"), status_required=True)
    # The detail starts from the appeal side: every appealed ticket stays.
    wide = t.appeal_wide.withColumns({"oli_id": F.col("accession"), "ticket_no": F.col("appeal_ticket_no")})
    detail = wide.join(known.withColumn("_known", F.lit(True)), on, "left")
    detail = detail.withColumns({c: F.when(F.col("_known"), F.col(c)) for c in on})
    detail = status.appeal_result_simple(detail, status_required=False)
    detail = project(detail, [*C.APPEAL_LINE, *payor_columns])
    lines = detail.filter(F.col("appeal_case_no").isNotNull())
    if top_payors is not None:
        lines, cases = (views.top_payor_flags(x, top_payors) for x in (lines, cases))
    return AppealReports(lines, cases, detail)


# R12 - R15: revenue lines and prices ---------------------------------------

class RevenueReports(NamedTuple):
    processed: DataFrame
    errors: DataFrame
    lines: DataFrame
    ledger: DataFrame
    subset: DataFrame


def oli_revenue(oli: DataFrame, revenue: DataFrame, ledger_ids: Sequence[str], id_ok=None,
                payor: str = "Medicare", test: str = "Prostate") -> RevenueReports:
    """Checked revenue, its errors, order lines with revenue, their ledger, and
    the order lines of one payor and test."""
    checked = quality.split_conflicts(revenue.filter(F.col("ticket_no").isNotNull()), id_ok=id_ok)
    lines = revenue_lines.oli_payment_revenue(oli, checked.kept)
    subset = lines.filter(quality.contains_ignore_case("tier2_payor_name", payor) & (F.col("test") == test))
    return RevenueReports(checked.kept, checked.rejected, lines, ledger.classed_ledger(lines, ledger_ids), subset)


class TicketReports(NamedTuple):
    processed: DataFrame
    errors: DataFrame
    current: DataFrame
    outdated: DataFrame
    ledger: DataFrame


def ticket_revenue(transactions: DataFrame, revenue: DataFrame, oli: DataFrame, ledger_ids: Sequence[str],
                   id_ok=None, since: str = "2016-01-01") -> TicketReports:
    """Ticket amounts with revenue, tickets no order line is on, and the ledger."""
    checked = quality.split_conflicts(revenue.filter(F.col("ticket_no").isNotNull()), id_ok=id_ok)
    out = revenue_lines.oli_ticket_revenue(transactions, checked.kept, oli, since)
    return TicketReports(checked.kept, checked.rejected, out.current, out.outdated,
                         ledger.classed_ledger(out.current, ledger_ids))


def allowable(t: ClaimTables) -> rollup.PaymentSplit:
    """One-payment order lines with the payor of the current ticket, and the rest."""
    split = rollup.single_multi_payment_split(quality.split_valid_keys(t.payment).kept)
    payor = t.oli.filter(F.col("current_ticket_no").isNotNull()).select(
        "oli_id", F.col("current_ticket_no").alias("ticket_no"),
        *[c for c in ("tier1_payor", "tier2_payor", "tier4_payor", "financial_category") if c in t.oli.columns])
    return rollup.PaymentSplit(split.single.join(payor, ["oli_id", "ticket_no"], "left"), split.multiple)


def unit_price(t: ClaimTables) -> DataFrame:
    allowed = rollup.allowed_amount(t.payment, flipped=False)
    return project(allowed.join(t.oli, "oli_id", "left"), C.UNIT_PRICE)


def abandoned(t: ClaimTables) -> DataFrame:
    return rollup.abandoned_appeals(t.payment, t.bill)


# R16 - R19: policies -------------------------------------------------------

class EnumReports(NamedTuple):
    """One wide table per test, and all tests as rows."""

    wide: Mapping[str, DataFrame]
    long: DataFrame


def policy_criteria(policies: DataFrame, enum: DataFrame, header: Sequence[str], tests: Sequence[str]) -> EnumReports:
    """Policies by criterion and condition, both from the enum table (``test, field, label, value``)."""
    return EnumReports({test: policy.criteria_wide_listed(policies, enum, header, test) for test in tests},
                       policy.criteria_long_listed(policies.filter(F.col("test").isin(*tests)), enum, header))


def policy_validation(validation: DataFrame, enum: DataFrame, header: Sequence[str], tests: Sequence[str],
                      field: str = "prior_authorization") -> EnumReports:
    """Validations by prior-authorisation requirement, from the enum table (``field, value``)."""
    return EnumReports(
        {test: policy.validation_wide_listed(validation, enum, header, test, field) for test in tests},
        policy.validation_long_listed(validation, enum, header, field))


def write_enum_reports(reports: EnumReports, folder: str, name: str, delimited: bool = True) -> None:
    """``wide_<test>_<name>`` and ``long_<name>``."""
    write_reports({**{f"wide_{test.lower()}_{name}": df for test, df in reports.wide.items()}, f"long_{name}": reports.long},
                  folder, delimited)


@dataclass(frozen=True)
class CoveragePlan:
    """What differs between the coverage reports of the tests."""

    test: str
    standardise: Callable[[DataFrame], DataFrame]
    criteria: Sequence[str]
    rules: Sequence[policy.CoverageRule]
    words: policy.CoverageWords
    contract_wording: Mapping[str, str]


IBC_COVERAGE = CoveragePlan(
    "IBC", standardise.clinical_standardise_ibc,
    ("recent_diagnosis", "age_at_diagnosis", "prior_assay", "patient_gender", "multi_tumour", "stage", "node_status",
     "er_status", "pr_status", "hormone_receptor", "her2_status", "her2_mode", "tumour_size", "tumour_histology",
     "procedure_type", "post_menopausal", "med_onc_order", "distant_metastasis", "multi_tumour_execution"),
    policy.IBC_RULES, policy.CoverageWords(), rules.POLICY_WORDING["CT"])
PROSTATE_COVERAGE = CoveragePlan(
    "Prostate", standardise.clinical_standardise_prostate,
    ("age_of_biopsy", "life_expectancy", "risk_category", "gleason_score", "clinical_stage", "tumour_involvement",
     "procedure_type", "med_onc_order", "ctr"),
    policy.PROSTATE_RULES, policy.PROSTATE_WORDS, rules.PROSTATE_CONTRACT_WORDING)


def coverage_input(risk: DataFrame, policies: DataFrame, validation: DataFrame, plan: CoveragePlan,
                   since: str = "2017-01-01") -> DataFrame:
    """Claimed orders of one test since a date, in policy wording, with their policies."""
    rows = risk.filter((F.col("test") == plan.test) & F.col("current_ticket_no").isNotNull()
                       & (F.col("order_start_dt") >= F.lit(since).cast("date")))
    return policy.policy_availability(plan.standardise(rows), policies, validation, plan.criteria,
                                      plan.contract_wording)


def policy_gap(data: DataFrame, t: ClaimTables) -> DataFrame:
    return with_view_sets(project(data, C.POLICY_GAP), t)


def coverage(data: DataFrame, t: ClaimTables, plan: CoveragePlan) -> DataFrame:
    return with_view_sets(policy.coverage_in_out(data, plan.rules, plan.words), t)


# writing -------------------------------------------------------------------

def sort_order(df: DataFrame, name: str) -> list:
    """The report's order, missing values last; columns that the report lacks don't count."""
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()
            for c, up in C.REPORT_ORDERS.get(name, ()) if c in df.columns]


def write_reports(reports: Mapping[str, DataFrame], folder: str, delimited: bool = False,
                  rows_per_file: int = ROWS_PER_FILE) -> list[Control]:
    """Each report as a table, or as delimited text, under its name and in its order; the control totals of the run.

    The totals are gathered by the same pass that writes the report, and are appended to the table ``control`` of the
    folder.
    """
    out = [write_ordered(df, f"{folder}/{name}", name, sort_order(df, name), delimited, rows_per_file)
           for name, df in reports.items()]
    if out:
        log_controls(next(iter(reports.values())).sparkSession, f"{folder}/control", out)
    return out


def write_claim_reports(t: ClaimTables, folder: str, delimited: bool = False,
                        tests: Sequence[str] = ("Prostate", "IBC"), staging: str | None = None) -> DataFrame:
    """Compute the order-line report once and write every table derived from it.

    The extracts read their columns from the written report; where it is written as text, from a staged table.
    """
    report = claim_to_revenue(t)
    if delimited:
        claim = stage(report, "claim_to_revenue", staging)
        write_reports({"claim_to_revenue": claim}, folder, delimited=True)
    else:
        write_reports({"claim_to_revenue": report}, folder)
        claim = report.sparkSession.read.parquet(f"{folder}/claim_to_revenue")
    outputs = {"oli_transactions": oli_transactions(claim, t), "managed_care": managed_care(claim, t),
               "payment_risk": payment_risk(claim), "domestic_billing": domestic_billing(claim)}
    for test in tests:
        outputs[f"appeal_extract_{test.lower()}"] = appeal_extract(claim, t, test)
        outputs[f"appeals_detail_{test.lower()}"] = appeals_detail(claim, test)
    write_reports(outputs, folder, delimited)
    return claim


def write_period_reports(t: ClaimTables, folder: str, oli_columns: Sequence[str] = (), delimited: bool = False) -> None:
    """Payor monthly report with zeros shown as blanks, its criteria layout, and the three ticket journals."""
    base = period_base(t, oli_columns)
    monthly = accounting_period(t, oli_columns, base=base)
    rows = journal_rows(t, oli_columns)
    shown = period.blank_zeros(monthly, [c for c in C.PERIOD_DISPLAY if c in monthly.columns])
    write_reports({
        "accounting_period": shown, "accounting_period_criteria": accounting_period(t, oli_columns, flip_after=True),
        "ticket_journal_v1": ticket_journal(t, 1, oli_columns, rows=rows),
        "ticket_journal_v2": ticket_journal(t, 2, oli_columns, rows=rows),
        "ticket_journal_criteria": ticket_journal_criteria(t)}, folder, delimited)


def write_named(reports: NamedTuple, folder: str, prefix: str = "", delimited: bool = False) -> None:
    """Every table of a report bundle, error tables included: appeals, revenue lines, tickets, payments."""
    write_reports({f"{prefix}{name}": df for name, df in reports._asdict().items()}, folder, delimited)


def write_policy_reports(data: DataFrame, t: ClaimTables, plan: CoveragePlan, folder: str, delimited: bool = False) -> None:
    """Policy gap and coverage of one test."""
    test = plan.test.lower()
    write_reports({f"policy_gap_{test}": policy_gap(data, t), f"coverage_{test}": coverage(data, t, plan)}, folder,
                  delimited)
