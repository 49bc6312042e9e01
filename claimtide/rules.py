"""Rule tables: fixed values the operators are driven by."""

# Test codes used by the billing vendor -> test labels.
TEST_LABELS = {
    "GL": "IBC",
    "GLD": "DCIS",
    "GLC": "Colon",
    "MMR": "MMR",
    "GLP": "Prostate",
    "UNK": "Unknown",
    "ARV7": "Prostate-AR-V7",
}

# House adjustment code by vendor adjustment code.
HOUSE_CODE_OVERRIDES = {"PRAC": "GH07", "PRA": "GH07", "BAO": "GH13", "CNCA": "GH16"}

# Plan ids that were retired -> the id that replaced them.
RETIRED_PLANS = {"PL0001459": "PL0006511"}

# Transaction types and vendor codes with a special meaning.
INSURER_PAID = "RI"
PATIENT_PAID = "RP"
PAYMENT_TYPES = ("RI", "RP")
ADJUSTMENT_TYPES = ("AC", "AD")
CHARGE_ERROR_CODES = ("C6", "CCD")
REFUND_CODES = ("D4", "CF")
ABANDONED_APPEAL_CODE = "NAC"
ROSTER_PLAN = "ROST"
WRITE_OFF_WORKLIST = "HS7X"
CHARGE_ERROR_TYPE = "GH04:Charged in Error"

# Adjustment groups of the receipt reports.
CHARGED_IN_ERROR = "Charged in Error"
REFUND = "Refund & Refund Reversal"
ADJUSTMENT_GROUPS = (
    "All other Adjustment",
    "Charged in Error",
    "House Adjustment",
    "Insurance Adjustment",
    "Refund & Refund Reversal",
    "Revenue Impact Adjustment",
)

# Appeal levels, in order.
APPEAL_LEVELS = ("A1", "A2", "A3", "A4", "A5", "ER", "L1", "L2", "L3")

# Billing statuses under which an appeal is over.
APPEAL_DONE_STATUSES = ("Completed", "Final Review", "Due from Patient")

# Spellings of the revised risk -> the standard spelling.
REVISED_RISK = {
    "INTERMEDIATE FAVORABLE": "Favorable Intermediate",
    "Intermediate favorable": "Favorable Intermediate",
    "Intermediate Favorable": "Favorable Intermediate",
    "INTERMEDIATE UNFAVORABLE": "Unfavorable Intermediate",
    "Intermediate unfavorable": "Unfavorable Intermediate",
    "Intermediate Unfavorable": "Unfavorable Intermediate",
}
FAVORABLE = "Favorable Intermediate"
UNFAVORABLE = "Unfavorable Intermediate"
LOW_STAGES = ("T1c", "T2a", "T1C", "T2A")

# Class of each measure in the long order and ticket ledgers.
LEDGER_CLASSES = {
    "accrual_usd": "Revenue",
    "cash_usd": "Revenue",
    "payor_paid": "PaymentSRC",
    "patient_paid": "PaymentSRC",
    "total_payment": "Receipt",
    "total_adjustment": "Receipt",
    "outstanding": "Receipt",
    "list_price": "PriceBook",
    "billed_amount": "PriceBook",
    "contracted_price": "PriceBook",
}

# Policy status -> wording in the policy reports.
POLICY_WORDING = {
    "MP": {"Blank PTC": "No policy", "No PTC": "No policy", "Yes PTC": "Published policy"},
    "CT": {"Blank PTC": "No policy", "No PTC": "No policy", "Yes PTC": "Contracted policy"},
}
# The Prostate report words a contracted policy as published.
PROSTATE_CONTRACT_WORDING = {**POLICY_WORDING["CT"], "Yes PTC": "Published policy"}

# Prior-authorisation requirements shown in the validation report.
PA_REQUIREMENTS = (
    "No CVP (no PA)",
    "Pre-DOS",
    "Post-DOS",
    "Must obtain PA before releasing report",
    "Ordering Physician initiates PA",
    "Lab initiates PA",
    "Payor specific PA form",
    "Payor specific SOMN Form",
    "SOMN",
    "Signature required on SOMN",
    "Online or Telephonic",
    "Supporting documents are needed",
    "Ordering physician signed attestation statement to include Adjuvant Therapy",
)

# Fixed value: stands in revenue rows for a missing order line.
NO_ORDER_LINE = "NONE"
