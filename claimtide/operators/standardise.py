"""Cleaning of the vendor extracts: test labels, payor resolution, codes, latency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import days_between, first_match, translate, true_only

PAYOR_FIELDS = ("company_vendor", "plan_vendor", "company_name", "plan_name", "fc",
                "company_house", "plan_house")
PAYMENT_FALLBACK_FIELDS = ("company_vendor", "company_house", "plan_house")


def translate_test_code(df: DataFrame, col: str = "test",
                        labels: Mapping[str, str] = rules.TEST_LABELS) -> DataFrame:
    return df.withColumn(col, translate(col, labels))


def _roster_plan(plan: Column, house: Column) -> Column:
    # The vendor has no plan id for roster accounts; use the in-house one.
    return F.when(plan == rules.ROSTER_PLAN, house).otherwise(plan)


def resolve_ticket_payor(bill: DataFrame, fields: Sequence[str] = PAYOR_FIELDS) -> DataFrame:
    """Ticket payor = re-routed payor where a re-routed plan is set, else primary.

    The plan decides for all fields together; single fields are not coalesced.
    """
    rerouted = F.col("rerouted_plan_vendor").isNotNull()
    chosen = {f: F.when(rerouted, F.col(f"rerouted_{f}")).otherwise(F.col(f"primary_{f}"))
              for f in fields}
    if "plan_vendor" in chosen and "plan_house" in chosen:
        chosen["plan_vendor"] = _roster_plan(chosen["plan_vendor"], chosen["plan_house"])
    return bill.withColumns({f"ticket_{f}": c for f, c in chosen.items()})


def payment_insurer_from_code(payment: DataFrame) -> DataFrame:
    """Payments carry the paying plan in the adjustment code field; move it out."""
    paid = F.col("txn_type").isin(*rules.PAYMENT_TYPES)
    code = F.col("vendor_adj_code")
    house = F.col("house_adj_code")
    return payment.withColumns({
        "payment_plan_vendor": F.when(paid, code),
        "vendor_adj_code": F.when(paid, F.lit("")).otherwise(code),
        "house_adj_code": F.when(paid, F.lit("")).otherwise(house),
    })


def fill_ticket_payor(payment: DataFrame,
                      fields: Sequence[str] = PAYMENT_FALLBACK_FIELDS) -> DataFrame:
    """Copy the primary payor where the ticket has no plan, then the roster rule."""
    missing = F.col("ticket_plan_vendor").isNull()
    filled = {f"ticket_{f}": F.when(missing, F.col(f"primary_{f}")).otherwise(F.col(f"ticket_{f}"))
              for f in fields}
    house = filled.get("ticket_plan_house", F.col("ticket_plan_house"))
    filled["ticket_plan_vendor"] = _roster_plan(F.col("ticket_plan_vendor"), house)
    return payment.withColumns(filled)


def flag_primary_payment(payment: DataFrame) -> DataFrame:
    """1 for insurer payments from the ticket's plan (or an unknown one), else 0."""
    other_plan = true_only(F.col("ticket_plan_vendor") != F.col("payment_plan_vendor"))
    return payment.withColumn("is_primary_payment", F.when(
        F.col("txn_type") == rules.INSURER_PAID, F.when(other_plan, 0).otherwise(1)))


def patch_adjustment_codes(payment: DataFrame, adjustment_code: DataFrame,
                           overrides: Mapping[str, str] = rules.HOUSE_CODE_OVERRIDES) -> DataFrame:
    """Override house codes by vendor code and attach the code's description.

    ``adjustment_code``: vendor_adj_code, adj_desc, category_desc, adj_group.
    The description still follows the vendor code.
    """
    new = translate("vendor_adj_code", overrides, keep_unknown=False)
    dim = (adjustment_code.filter(F.col("vendor_adj_code").isNotNull())
           .select("vendor_adj_code", "adj_desc", "category_desc", "adj_group"))
    return (payment.withColumn("house_adj_code", F.coalesce(new, F.col("house_adj_code")))
            .join(dim, "vendor_adj_code", "left"))


def claim_latency(bill: DataFrame) -> DataFrame:
    return bill.withColumns({
        "days_to_init_payment": days_between("init_bill_dt", "init_payment_dt"),
        "days_to_last_payment": days_between("init_bill_dt", "last_payment_dt"),
    })


def standardise_bill(bill: DataFrame) -> DataFrame:
    """The whole bill clean-up: labels, latency, constants, status, ticket payor."""
    out = claim_latency(translate_test_code(bill))
    status = F.col("case_status_sum2")
    out = out.withColumns({
        "txn_line": F.lit(0),
        "txn_type": F.lit("CL"),
        "case_status_sum2": F.when(status == "Claim In Process", "Claim in Process").otherwise(status),
    })
    return resolve_ticket_payor(out, [f for f in PAYOR_FIELDS if f"primary_{f}" in bill.columns])


def standardise_payment(payment: DataFrame, adjustment_code: DataFrame) -> DataFrame:
    """The whole payment clean-up, in the order the rules depend on each other."""
    out = payment_insurer_from_code(translate_test_code(payment))
    fields = [f for f in PAYMENT_FALLBACK_FIELDS if f"primary_{f}" in payment.columns]
    out = flag_primary_payment(fill_ticket_payor(out, fields))
    return patch_adjustment_codes(out, adjustment_code)


def worklist_conditions(worklist: DataFrame, condition_code: DataFrame,
                        code: str = rules.WRITE_OFF_WORKLIST) -> DataFrame:
    """Write-off conditions: rows of one worklist with a condition, described.

    ``condition_code``: worklist_code, condition, condition_desc.
    """
    rows = worklist.withColumn("condition", F.trim("condition"))
    rows = rows.filter((F.col("worklist_code") == code) & true_only(F.col("condition") != ""))
    return rows.join(condition_code, ["worklist_code", "condition"], "left")


def ambiguous_conditions(conditions: DataFrame, ticket: str = "ticket_no") -> DataFrame:
    """Tickets written off under more than one condition."""
    return (conditions.filter(F.col(ticket).isNotNull())
            .groupBy(ticket).agg(F.count_distinct("condition").alias("condition_cnt"))
            .filter("condition_cnt > 1"))


# clinical values -----------------------------------------------------------

def tumour_size_bin(cm: str) -> Column:
    c = F.col(cm)
    return first_match([
        (c.isNull(), F.lit("Unknown")),
        (c <= 0.5, F.lit(".Size <= 0.5 cm")),
        (c < 0.6, F.lit("0.5 < Size < 0.6 cm")),
        (c <= 1.0, F.lit("0.6 <= Size <= 1.0 cm")),
        (c <= 5.0, F.lit("1.0 < Size <= 5.0 cm")),
    ], F.lit("Size > 5.0 cm"))


def age_bin(age: str) -> Column:
    return F.when(F.col(age) >= 50, ">= 50").when(F.col(age) < 50, "< 50").otherwise("Unknown")


def biopsy_age_bin(days: str) -> Column:
    d = F.col(days)
    return (F.when((d >= 0) & (d < 180), "Less than 6 months")
            .when(d.between(180, 1080), "6-36 months").otherwise("Unknown"))


def _med_onc(specialty: str, oncologists: Sequence[str]) -> Column:
    s = F.col(specialty)
    return F.when(s.isin(*oncologists), "Med Onc Order").when(s.isNotNull(), "Non-Med Onc Order")


def clinical_standardise_ibc(df: DataFrame) -> DataFrame:
    """Patient values of breast-cancer orders in the wording of the policies."""
    nodes = {"Node Negative": "Node Negative (pN0)",
             "Micromets (pN1mi: 0.2 - 2.0mm)": "Micromets (pN1mi: 0.2 2.0mm)"}
    both = true_only((F.col("submitted_er") == "Positive") & (F.col("submitted_pr") == "PR Positive"))
    return df.withColumns({
        "nodal_status": translate("nodal_status", nodes),
        "procedure_type": translate("procedure_type", {"Non-Biopsy": "Non Biopsy"}),
        "hormone_receptor": F.when(both, "ER Positive and PR Positive (HR positive)"),
        "multiple_primaries": F.when(F.col("multiple_primaries") == 1, "Yes")
                               .when(F.col("multiple_primaries") == 0, "No"),
        "patient_age_years": F.col("patient_age"),
        "patient_age": age_bin("patient_age"),
        "tumour_size": tumour_size_bin("tumour_size_cm"),
        "med_onc_order": _med_onc("specialty", ("Oncologist", "Radiation Oncologist")),
    })


def clinical_standardise_prostate(df: DataFrame) -> DataFrame:
    """Patient values of prostate orders in the wording of the policies."""
    involvement = {"> 50%": "Greater than or Equal to 50%", "≤ 50%": "less than 50%"}
    risk = {rules.FAVORABLE: "Intermediate Favorable", rules.UNFAVORABLE: "Intermediate Unfavorable"}
    return df.withColumns({
        "med_onc_order": _med_onc("specialty", ("Oncologist",)),
        "is_hcp_ctr": F.when(F.col("is_hcp_ctr") == 1, "Yes").when(F.col("is_hcp_ctr") == 0, "No"),
        "max_tumour_involvement": translate("max_tumour_involvement", involvement),
        "submitted_risk": translate("submitted_risk", risk),
        "biopsy_age": biopsy_age_bin("specimen_age"),
    })
