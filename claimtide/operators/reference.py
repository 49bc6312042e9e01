"""Current ticket, current case and payor hierarchies of an order line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import differs, label, translate
from claimtide.operators.latest import id_order, latest_row, pick_greatest
from claimtide.operators.lookup import as_lookup

TICKET_COLUMNS = ("case_status_sum1", "case_status_sum2", "case_status_code", "case_status",
                  "ticket_plan_vendor", "ticket_plan_house", "primary_plan_vendor",
                  "primary_plan_house", "dos", "txn_date",
                  "days_to_init_payment", "days_to_last_payment")
HIERARCHY_COLUMNS = ("tier1_payor", "tier1_payor_name", "tier1_payor_id",
                     "tier2_payor", "tier2_payor_name", "tier2_payor_id",
                     "tier4_payor", "tier4_payor_name", "tier4_payor_id",
                     "financial_category", "line_of_benefit")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows exchanged by order line once, so that steps by ticket or case and by order line follow in place.

    Rows whose ids are text stay as they are: those without an order line stand under one sentinel, which the map side
    has to reduce before any exchange.
    """
    return rows if dict(rows.dtypes)[key] == "string" else rows.repartition(key)


def latest_case_per_ticket(bill: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Bill row with the greatest case number of each (order line, ticket)."""
    columns = list(columns or [c for c in bill.columns if c not in ("oli_id", "ticket_no")])
    if "case_no" not in columns:
        columns.insert(0, "case_no")
    return latest_row(bill, ["oli_id", "ticket_no"], id_order(bill, "case_no"), columns)


def ticket_counts(bill: DataFrame) -> DataFrame:
    """Distinct tickets per order line; a missing ticket number counts as one."""
    # Two plain aggregations combine on the map side at either level.
    pairs = bill.filter(F.col("oli_id").isNotNull()).select("oli_id", "ticket_no").distinct()
    return pairs.groupBy("oli_id").agg(F.count(F.lit(1)).alias("ticket_cnt"))


def current_ticket(bill: DataFrame, columns: Sequence[str] = TICKET_COLUMNS) -> DataFrame:
    """Current ticket per order line, with its case, attributes and ticket count.

    Case rows reduce to one row per ticket, tickets to one per order line, both
    after one exchange by order line: the ticket with the latest transaction date.  The number of tickets is the
    number of rows of the first step.
    """
    payload = ["case_no", *[c for c in columns if c in bill.columns]]
    rows = bill.filter(F.col("oli_id").isNotNull()).select("oli_id", "ticket_no", *payload)
    tickets = (dealt(rows, "oli_id").groupBy("oli_id", "ticket_no")
               .agg(pick_greatest(id_order(bill, "case_no"), payload).alias("_case"))
               .select("oli_id", "ticket_no", "_case.row.*"))
    chosen = ["ticket_no", *payload]
    order = [F.when(F.col("ticket_no").isNotNull(), F.col("txn_date")), "ticket_no"]
    return (tickets.groupBy("oli_id")
            .agg(F.count(F.lit(1)).alias("ticket_cnt"), pick_greatest(order, chosen).alias("_pick"))
            .select("oli_id", "_pick.row.*", "ticket_cnt")
            .filter(F.col("ticket_no").isNotNull()))


def current_case(case: DataFrame) -> DataFrame:
    """Latest added case per order line, with the number of distinct cases."""
    rows = case.filter(F.col("accession").isNotNull()).select("accession", "case_no", "added_ts")
    cases = (dealt(rows, "accession").groupBy("accession", "case_no")
             .agg(F.max("added_ts").alias("added_ts")))
    order = ["added_ts", *id_order(case, "case_no")]
    return (cases.groupBy(F.col("accession").alias("oli_id"))
            .agg(F.count(F.lit(1)).alias("case_cnt"), pick_greatest(order, ["case_no"]).alias("_pick"))
            .select("oli_id", F.col("_pick.row.case_no").alias("max_case_no"), "case_cnt"))


def current_reference(bill: DataFrame, case: DataFrame,
                      columns: Sequence[str] = TICKET_COLUMNS) -> DataFrame:
    """Current ticket and case per order line known to the case file.

    The case is the one of the current ticket, else the latest case.  An order
    line that is absent from the case file gets no current ticket.
    """
    names = {"ticket_no": "current_ticket_no", "dos": "vendor_dos", "txn_date": "claim_entry_dt"}
    ticket = current_ticket(bill, columns).withColumnsRenamed(names)
    return (current_case(case).join(ticket, "oli_id", "left")
            .withColumn("current_case_no", F.coalesce("case_no", "max_case_no"))
            .drop("case_no", "max_case_no"))


def claim_flags(oli: DataFrame) -> DataFrame:
    """IsClaim, IsFullyAdjudicated and the vendor's date of service as fallback."""
    status = F.col("case_status_sum2")
    return oli.withColumns({
        "is_claim": F.when(F.col("current_ticket_no").isNull(), 0).otherwise(1),
        "is_fully_adjudicated": F.when(status == "Completed", 1).when(status.isNotNull(), 0),
        "dos": F.coalesce("dos", "vendor_dos"),
    })


def payor_hierarchy(payors: DataFrame, ins_codes: DataFrame | None = None) -> DataFrame:
    """Labels for the three tiers; financial category from the vendor when missing.

    ``ins_codes``: tier4_payor_id, vendor_fc; of several rows for a plan the greatest code holds.
    """
    out = payors.withColumns({
        f"tier{t}_payor": label(f"tier{t}_payor_name", f"tier{t}_payor_id") for t in (1, 2, 4)})
    if ins_codes is not None:
        # One row per plan: the join adds no rows, and the hierarchy is as small as its payors.
        codes = (ins_codes.filter(F.col("tier4_payor_id").isNotNull()).groupBy("tier4_payor_id")
                 .agg(F.max("vendor_fc").alias("vendor_fc")))
        out = (out.join(codes, "tier4_payor_id", "left")
               .withColumn("financial_category", F.coalesce("financial_category", "vendor_fc"))
               .drop("vendor_fc"))
    return out.select(*[c for c in HIERARCHY_COLUMNS if c in out.columns])


def attach_payor_hierarchies(oli: DataFrame, payors: DataFrame,
                             ticket_plan: str = "ticket_plan_house",
                             primary_plan: str = "primary_plan_house",
                             retired: Mapping[str, str] = rules.RETIRED_PLANS) -> DataFrame:
    """Join the current hierarchy twice: for the ticket's plan and the primary plan.

    Every column of ``payors`` comes along, the second time prefixed.
    """
    keys = {}
    for plan in (ticket_plan, primary_plan):
        if dict(oli.dtypes)[plan] == "string" and retired:
            keys[plan] = translate(plan, retired)
    out = oli.withColumns(keys) if keys else oli
    payors = payors.filter(F.col("tier4_payor_id").isNotNull())
    ticket = as_lookup(payors)
    primary = as_lookup(payors.select(*[F.col(c).alias(f"primary_{c}") for c in payors.columns]))
    return (out.join(ticket, out[ticket_plan] == ticket["tier4_payor_id"], "left")
            .join(primary, F.col(primary_plan) == F.col("primary_tier4_payor_id"), "left"))


def reroute_flags(oli: DataFrame) -> DataFrame:
    """Yes when ticket and primary payor differ; two missing values do not."""
    def flag(a, b):
        return F.when(differs(a, b), "Yes").otherwise("No")
    return oli.withColumns({
        "rerouted_ticket": flag("tier4_payor_id", "primary_tier4_payor_id"),
        "reroute_changed_fc": flag("financial_category", "primary_financial_category"),
    })
