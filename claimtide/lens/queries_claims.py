"""Registered queries: clean-up, references, rollups, status."""

from pyspark.sql import functions as F

from claimtide.lens.registry import (
    BILL_STD, CURRENT_CASE, CURRENT_REFERENCE, CURRENT_TICKET, HIERARCHY, PAY_SIGNED, PAY_STD, RECEIPT,
    RECEIPT_AMOUNTS, REVENUE_AMOUNTS, REVENUE_ROLLUP, Tables, doubles, register)
from claimtide.operators import quality, reference, rollup, standardise, status
from claimtide.operators.latest import first_and_last
from claimtide.sources import loaders

PAY = {"pay_std": PAY_STD, "pay_signed": PAY_SIGNED}
REF = {"bill_std": BILL_STD, "current_ticket": CURRENT_TICKET, "current_case": CURRENT_CASE,
       "current_reference": CURRENT_REFERENCE}


def bill_std(t: Tables):
    return standardise.standardise_bill(t.bill)


def pay_std(t: Tables):
    return standardise.standardise_payment(t.payment, t.adjustment_code)


def receipts(t: Tables):
    bill = quality.split_valid_keys(t.bill).kept
    payment = quality.split_valid_keys(pay_std(t)).kept
    return rollup.receipt_rollup(bill, payment)


def revenue_sums(t: Tables):
    return rollup.revenue_rollup(quality.reconciled(t.revenue))


def hierarchy(t: Tables):
    return reference.payor_hierarchy(t.payor, t.ins_codes)


@register("q_order_to_cash", "bill payment adjustment_code payor ins_codes", f"""
select r.oli_id, {doubles('total_billed', 'total_payment', 'total_adjustment', 'outstanding', 'payor_paid',
                          'patient_paid', source='r')},
  t.ticket_no, t.case_no, t.ticket_cnt, h.tier1_payor, h.tier2_payor, h.tier4_payor, h.financial_category
from receipt r left join current_ticket t on r.oli_id = t.oli_id
left join hierarchy h on t.ticket_plan_house = h.tier4_payor_id""",
          **PAY, receipt=RECEIPT, bill_std=BILL_STD, current_ticket=CURRENT_TICKET, hierarchy=HIERARCHY)
def order_to_cash(t):
    ticket = reference.current_ticket(bill_std(t)).select(
        "oli_id", "ticket_no", "case_no", "ticket_cnt", "ticket_plan_house")
    payors = hierarchy(t).select("tier4_payor_id", "tier1_payor", "tier2_payor", "tier4_payor", "financial_category")
    return (receipts(t).select("oli_id", "total_billed", "total_payment", "total_adjustment", "outstanding",
                               "payor_paid", "patient_paid")
            .join(ticket, "oli_id", "left")
            .join(payors, F.col("ticket_plan_house") == F.col("tier4_payor_id"), "left")
            .drop("ticket_plan_house", "tier4_payor_id"))


@register("q_receipt_rollup", "bill payment adjustment_code",
          f"select oli_id, {doubles(*RECEIPT_AMOUNTS)} from receipt", **PAY, receipt=RECEIPT)
def receipt_rollup(t):
    return receipts(t)


@register("q_receipt_categories", "bill payment adjustment_code", """
select oli_id, cast(coalesce(sum(txn_amount) filter (where txn_type in ('AC', 'AD') and category_desc = 'Refund'), 0) as double) as cat_refund,
  cast(coalesce(sum(txn_amount) filter (where txn_type in ('AC', 'AD') and category_desc = 'Abandoned'), 0) as double) as cat_abandoned,
  cast(coalesce(sum(txn_amount) filter (where txn_type in ('AC', 'AD') and adj_group = 'Insurance Adjustment'), 0) as double) as grp_insurance_adjustment
from pay_signed where oli_id is not null group by oli_id""", **PAY)
def receipt_categories(t):
    out = rollup.receipt_rollup(t.bill, pay_std(t), categories=("Refund", "Abandoned"))
    return out.select("oli_id", "cat_refund", "cat_abandoned", "grp_insurance_adjustment")


@register("q_valid_keys", "bill", """
select oli_id is not null as valid, count(*) as row_cnt, cast(sum(txn_amount) as double) as amount
from bill group by 1""")
def valid_keys(t):
    kept, rejected = quality.split_valid_keys(t.bill)
    both = kept.withColumn("valid", F.lit(True)).unionByName(rejected.withColumn("valid", F.lit(False)))
    return both.groupBy("valid").agg(F.count(F.lit(1)).alias("row_cnt"), F.sum("txn_amount").alias("amount"))


@register("q_current_ticket", "bill", "select * from current_ticket", bill_std=BILL_STD, current_ticket=CURRENT_TICKET)
def current_ticket(t):
    return reference.current_ticket(bill_std(t))


@register("q_latest_case_per_ticket", "bill", """
select oli_id, ticket_no, case_no, test, currency, ticket_plan_house, dos, txn_date from (
  select *, row_number() over (partition by oli_id, ticket_no order by case_no desc, test desc, currency desc,
    ticket_plan_house desc nulls last, dos desc, txn_date desc) as rn
  from bill_std where oli_id is not null) where rn = 1""", bill_std=BILL_STD)
def latest_case_per_ticket(t):
    return reference.latest_case_per_ticket(
        bill_std(t), ["case_no", "test", "currency", "ticket_plan_house", "dos", "txn_date"])


@register("q_latest_case", "claim_case", "select * from current_case", current_case=CURRENT_CASE)
def latest_case(t):
    return reference.current_case(t.claim_case)


@register("q_current_reference", "bill claim_case", "select * from current_reference", **REF)
def current_reference(t):
    return reference.current_reference(bill_std(t), t.claim_case)


@register("q_claim_flags", "bill claim_case oli", """
select o.oli_id, o.test, r.current_ticket_no, r.case_status_sum2,
  case when r.current_ticket_no is null then 0 else 1 end as is_claim,
  case when r.case_status_sum2 = 'Completed' then 1 when r.case_status_sum2 is not null then 0 end as is_fully_adjudicated,
  coalesce(o.dos, r.vendor_dos) as dos
from oli o left join current_reference r on o.oli_id = r.oli_id""", **REF)
def claim_flags(t):
    ref = reference.current_reference(bill_std(t), t.claim_case).select(
        "oli_id", "current_ticket_no", "case_status_sum2", "vendor_dos")
    lines = t.oli.select("oli_id", "test", "dos")
    return reference.claim_flags(lines.join(ref, "oli_id", "left")).drop("vendor_dos")


@register("q_ticket_counts", "bill", """
select oli_id, count(distinct ticket_no) as ticket_cnt from bill where oli_id is not null group by oli_id""")
def ticket_counts(t):
    return reference.ticket_counts(t.bill)


@register("q_payor_hierarchy", "payor ins_codes", "select * from hierarchy", hierarchy=HIERARCHY)
def payor_hierarchy(t):
    return hierarchy(t)


TWO = """
select t.oli_id, t.ticket_plan_house, t.primary_plan_house,
  a.tier1_payor, a.tier2_payor, a.tier4_payor, a.tier4_payor_id, a.financial_category,
  b.tier1_payor as primary_tier1_payor, b.tier2_payor as primary_tier2_payor, b.tier4_payor as primary_tier4_payor,
  b.tier4_payor_id as primary_tier4_payor_id, b.financial_category as primary_financial_category
from current_ticket t left join hierarchy a on t.ticket_plan_house = a.tier4_payor_id
left join hierarchy b on t.primary_plan_house = b.tier4_payor_id"""
TWO_COLUMNS = ["tier1_payor", "tier2_payor", "tier4_payor", "tier4_payor_id", "financial_category"]


def two(t):
    lines = reference.current_ticket(bill_std(t)).select("oli_id", "ticket_plan_house", "primary_plan_house")
    return reference.attach_payor_hierarchies(lines, hierarchy(t).select(*TWO_COLUMNS))


@register("q_two_hierarchies", "bill payor ins_codes", "select * from two",
          bill_std=BILL_STD, current_ticket=CURRENT_TICKET, hierarchy=HIERARCHY, two=TWO)
def two_hierarchies(t):
    return two(t)


@register("q_reroute", "bill payor ins_codes", """
select oli_id, case when tier4_payor_id is distinct from primary_tier4_payor_id then 'Yes' else 'No' end as rerouted_ticket,
  case when financial_category is distinct from primary_financial_category then 'Yes' else 'No' end as reroute_changed_fc
from two""", bill_std=BILL_STD, current_ticket=CURRENT_TICKET, hierarchy=HIERARCHY, two=TWO)
def reroute(t):
    return reference.reroute_flags(two(t)).select("oli_id", "rerouted_ticket", "reroute_changed_fc")


@register("q_revenue_rollup", "revenue", f"""
select oli_id, {doubles(*REVENUE_AMOUNTS)}, period_cnt, period_init, period_last, currency from revenue_rollup""",
          revenue_rollup=REVENUE_ROLLUP)
def revenue_rollup(t):
    return revenue_sums(t)


@register("q_first_last", "revenue", """
select a.oli_id, a.period as period_init, a.currency as currency_init, a.tier2_payor as tier2_payor_init,
  b.period as period_last, b.currency as currency_last, b.tier2_payor as tier2_payor_last
from (select *, row_number() over (partition by oli_id order by period nulls last, currency nulls first,
    tier2_payor nulls first) as rn from revenue) a
join (select *, row_number() over (partition by oli_id order by period desc nulls last, currency desc nulls last,
    tier2_payor desc nulls last) as rn from revenue) b on a.oli_id = b.oli_id and a.rn = 1 and b.rn = 1""")
def first_last(t):
    return first_and_last(t.revenue, ["oli_id"], ["period"], ["period", "currency", "tier2_payor"])


CONFLICTS = """
select oli_id, count(distinct case when test <> 'Unknown' then test end) > 1 as test_conflict,
  count(distinct currency) > 1 as currency_conflict
from revenue group by oli_id
having count(distinct case when test <> 'Unknown' then test end) > 1 or count(distinct currency) > 1"""


@register("q_conflicts", "revenue", "select * from conflicts", conflicts=CONFLICTS)
def conflicts(t):
    return quality.conflict_keys(t.revenue)


@register("q_clean", "revenue", f"""
select oli_id, ticket_no, period, currency, test, {doubles('total', 'accrual', 'cash')}
from revenue where oli_id not in (select oli_id from conflicts)""", conflicts=CONFLICTS)
def clean(t):
    kept = quality.split_conflicts(t.revenue).kept
    return kept.select("oli_id", "ticket_no", "period", "currency", "test", "total", "accrual", "cash")


@register("q_conflict_rows", "revenue", f"""
select oli_id, ticket_no, period, currency, test, {doubles('total')}
from revenue where oli_id in (select oli_id from conflicts)""", conflicts=CONFLICTS)
def conflict_rows(t):
    errors = quality.split_conflicts(t.revenue, drop=False).rejected
    return errors.select("oli_id", "ticket_no", "period", "currency", "test", "total")


@register("q_reconciled", "revenue", """
select period, count(*) as row_cnt, cast(sum(total) as double) as total from revenue where recon_flag = '0' group by period""")
def reconciled(t):
    return (quality.reconciled(t.revenue).groupBy("period")
            .agg(F.count(F.lit(1)).alias("row_cnt"), F.sum("total").alias("total")))


@register("q_no_impact", "revenue", f"""
select oli_id, ticket_no, {doubles('accrual', 'cash')} from revenue
where (accrual <> 0 or cash <> 0) and ticket_no is not null""")
def no_impact(t):
    out = quality.drop_no_impact(t.revenue, ["accrual", "cash"])
    return out.select("oli_id", "ticket_no", "accrual", "cash")


@register("q_regex_ids", "", r"""
select c_custkey, c_name from customer where regexp_matches(c_name, '^Cus\w+#\d+[02468]$') or c_name = 'Customer#000000007'""")
def regex_ids(t):
    customers = t.base("customer").select("c_custkey", "c_name")
    return customers.filter(quality.well_formed_id("c_name", r"^Cus\w+#\d+[02468]$", ("Customer#000000007",)))


@register("q_contains", "", "select p_partkey, p_name from part where lower(p_name) like '%ring%'")
def contains(t):
    return t.base("part").select("p_partkey", "p_name").filter(quality.contains_ignore_case("p_name", "RING"))


@register("q_translate", "bill", """
select test, count(*) as row_cnt, cast(sum(txn_amount) as double) as amount from bill_std group by test""",
          bill_std=BILL_STD)
def translate(t):
    return (standardise.translate_test_code(t.bill).groupBy("test")
            .agg(F.count(F.lit(1)).alias("row_cnt"), F.sum("txn_amount").alias("amount")))


TICKET_PAYOR = ["oli_id", "ticket_no", "case_no", "ticket_plan_vendor", "ticket_plan_house", "ticket_plan_name"]


@register("q_ticket_payor", "bill", f"select {', '.join(TICKET_PAYOR)} from bill_std", bill_std=BILL_STD)
def ticket_payor(t):
    return standardise.resolve_ticket_payor(t.bill, ("plan_vendor", "plan_house", "plan_name")).select(*TICKET_PAYOR)


PAYMENT_PAYOR = ["oli_id", "ticket_no", "txn_line", "txn_type", "ticket_plan_vendor", "ticket_plan_house",
                 "payment_plan_vendor", "is_primary_payment"]


@register("q_payment_payor", "payment adjustment_code", f"select {', '.join(PAYMENT_PAYOR)} from pay_std",
          pay_std=PAY_STD)
def payment_payor(t):
    return pay_std(t).select(*PAYMENT_PAYOR)


ADJUSTMENT = ["oli_id", "ticket_no", "txn_type", "vendor_adj_code", "house_adj_code", "adj_desc", "category_desc",
              "adj_group"]


@register("q_adjustment_join", "payment adjustment_code",
          f"select {', '.join(ADJUSTMENT)}, {doubles('txn_amount')} from pay_signed where txn_type in ('AC', 'AD')", **PAY)
def adjustment_join(t):
    payment = rollup.normalise_payment_sign(pay_std(t))
    return payment.filter(rollup.is_adjustment()).select(*ADJUSTMENT, "txn_amount")


@register("q_latency", "bill", """
select oli_id, ticket_no, init_bill_dt, cast(init_payment_dt - init_bill_dt as integer) as days_to_init_payment,
  cast(last_payment_dt - init_bill_dt as integer) as days_to_last_payment from bill""")
def latency(t):
    return standardise.claim_latency(t.bill).select(
        "oli_id", "ticket_no", "init_bill_dt", "days_to_init_payment", "days_to_last_payment")


@register("q_list_price", "oli price", """
select o.oli_id, o.test, o.billed_currency, cast(coalesce(list_price, std_list_price) as double) as list_price
from oli o left join price p on o.test = p.test and o.billed_currency = p.billed_currency""")
def list_price(t):
    lines = t.oli.select("oli_id", "test", "billed_currency", "list_price")
    return rollup.fill_list_price(lines, t.price)


@register("q_allowed", "payment adjustment_code", """
select oli_id, cast(max(allowed_amt) as double) as allowed_amt from pay_signed
where txn_type = 'RI' and txn_amount > 0 and oli_id is not null group by oli_id""", **PAY)
def allowed(t):
    return rollup.allowed_amount(rollup.normalise_payment_sign(pay_std(t)))


ORDER_STATUS = """
select oli_id, test_delivered as original_test_delivered,
  case when current_ticket_no is not null then 1 else test_delivered end as test_delivered,
  case when delivered_dt is null and (test_delivered = 1 or current_ticket_no is not null) then dos else delivered_dt end as delivered_dt,
  coalesce(line_cancel_reason, order_cancel_reason) as line_cancel_reason,
  coalesce(order_cancel_reason, line_cancel_reason) as order_cancel_reason,
  failure_message, customer_status, data_entry_status from oli"""


@register("q_order_status", "oli", """
select oli_id, original_test_delivered, test_delivered, delivered_dt, line_cancel_reason, order_cancel_reason,
  case when test_delivered = 1 then 'Delivered' when failure_message is not null then 'Failed'
    when line_cancel_reason is not null then 'Canceled' else customer_status end as status,
  case when test_delivered = 1 then 'Test Delivered = 1' || case when line_cancel_reason is not null
      or failure_message is not null then '*' else '' end
    when failure_message is not null then failure_message
    when line_cancel_reason is not null then case when line_cancel_reason = order_cancel_reason then line_cancel_reason
      else order_cancel_reason || ' , ' || line_cancel_reason end
    when customer_status not in ('Closed', 'Canceled') then data_entry_status end as status_notes
from filled""", filled=ORDER_STATUS)
def order_status(t):
    return status.order_status(t.oli).select(
        "oli_id", "original_test_delivered", "test_delivered", "delivered_dt", "line_cancel_reason",
        "order_cancel_reason", "status", "status_notes")


@register("q_contract_flags", "oli", """
select oli_id, case when contracted_price is null then 0 else 1 end as is_contract,
  case when revenue_status = 'Accrual' then 1 else 0 end as is_accrual from oli""")
def contract_flags(t):
    return status.contract_accrual_flags(t.oli).select("oli_id", "is_contract", "is_accrual")


@register("q_partial_paid", "oli bill payment adjustment_code", """
select o.oli_id, case_status as orig_case_status, cast(grp_revenue_impact_adjustment as double) as grp_revenue_impact_adjustment,
  case when case_status = 'Paid!' and grp_revenue_impact_adjustment > 0 then 'Partial Paid' else case_status end as case_status
from oli o left join receipt r on o.oli_id = r.oli_id""", **PAY, receipt=RECEIPT)
def partial_paid(t):
    impact = receipts(t).select("oli_id", "grp_revenue_impact_adjustment")
    return status.partial_paid(t.oli.select("oli_id", "case_status").join(impact, "oli_id", "left"))


SINGLE = """
select distinct oli_id from (select oli_id, test, ticket_no, count(txn_date) as row_cnt from pay_std
  where txn_type = 'RI' and oli_id is not null group by all) where row_cnt = 1"""


@register("q_single_payment", "payment adjustment_code", f"""
select oli_id, ticket_no, txn_line, cast(-txn_amount as double) as payor_paid,
  cast(-txn_amount + deductible_amt + coins_amt as double) as compare_amt
from pay_std where txn_type = 'RI' and oli_id in (select oli_id from single)""", pay_std=PAY_STD, single=SINGLE)
def single_payment(t):
    valid = quality.split_valid_keys(pay_std(t)).kept
    return rollup.single_multi_payment_split(valid).single.select(
        "oli_id", "ticket_no", "txn_line", "payor_paid", "compare_amt")


@register("q_multi_payment", "payment adjustment_code", f"""
select oli_id, ticket_no, txn_line, {doubles('txn_amount')}
from pay_std where txn_type = 'RI' and oli_id is not null and oli_id not in (select oli_id from single)""",
          pay_std=PAY_STD, single=SINGLE)
def multi_payment(t):
    valid = quality.split_valid_keys(pay_std(t)).kept
    return rollup.single_multi_payment_split(valid).multiple.select("oli_id", "ticket_no", "txn_line", "txn_amount")


@register("q_single_share", "payment adjustment_code", """
select cast(count(*) filter (where row_cnt = 1) as double) / count(*) as single_share from (
  select oli_id, test, ticket_no, count(txn_date) as row_cnt from pay_std
  where txn_type = 'RI' and oli_id is not null group by all)""", pay_std=PAY_STD)
def single_share(t):
    return rollup.single_payment_share(pay_std(t))


@register("q_abandoned", "bill payment adjustment_code", """
select b.oli_id, b.ticket_no, b.test, b.dos, write_off_cnt from bill_std b join (
  select oli_id, count(*) as write_off_cnt from pay_std where vendor_adj_code = 'NAC' and oli_id is not null group by oli_id) n
  on b.oli_id = n.oli_id""", pay_std=PAY_STD, bill_std=BILL_STD)
def abandoned(t):
    out = rollup.abandoned_appeals(pay_std(t), bill_std(t))
    return out.select("oli_id", "ticket_no", "test", "dos", "write_off_cnt")


@register("q_worklist", "worklist condition_code", """
select w.event_id, w.ticket_no, trim(w.condition) as condition, c.condition_desc from worklist w left join condition_code c
  on w.worklist_code = c.worklist_code and trim(w.condition) = c.condition
where w.worklist_code = 'HS7X' and trim(w.condition) <> ''""")
def worklist(t):
    out = standardise.worklist_conditions(t.worklist, t.condition_code)
    return out.select("event_id", "ticket_no", "condition", "condition_desc")


@register("q_ambiguous", "worklist", """
select ticket_no, count(distinct trim(condition)) as condition_cnt from worklist
where worklist_code = 'HS7X' and trim(condition) <> '' group by ticket_no having count(distinct trim(condition)) > 1""")
def ambiguous(t):
    return standardise.ambiguous_conditions(standardise.worklist_conditions(t.worklist, t.condition_code))


# base tables from raw extracts ---------------------------------------------

@register("q_load_order_line", "raw_order_line", """
select oli_id, test, cast(nullif(try_cast(billed_amount as decimal(18,2)), 0) as double) as billed_amount,
  cast(try_strptime(case when delivered_dt like '%.0' then replace(delivered_dt, '.0', '') end, '%Y%m%d') as date) as delivered_dt,
  cast(try_strptime(order_start_dt, '%Y%m%d') as date) as order_start_dt,
  nullif(cast(cast(current_ticket_no as bigint) as varchar), '0') as current_ticket_no, tier4_payor_name, tier4_payor_id,
  tier4_payor_name || ' (' || tier4_payor_id || ')' as tier4_payor, coalesce(risk_group, 'Unknown') as risk_group,
  coalesce(gleason, '') as gleason, case when test = 'Prostate-AR-V7' then 'ARV7'
    when reporting_group = 'Node Positive (Micromet)' then nodal_status else reporting_group end as reporting_group, nodal_status
from raw_order_line""")
def load_order_line(t):
    return loaders.load_order_line(t.raw_order_line)


@register("q_load_revenue", "raw_revenue ins_codes", """
select coalesce(cast(oli_id as varchar), 'NONE') as oli_id, nullif(cast(cast(ticket_no as bigint) as varchar), '0') as ticket_no,
  try_cast(left(period, 10) as date) as period, try_cast(case when len(claim_period) >= 10 then left(claim_period, 10) end as date) as claim_period,
  cast(total as double) as total, tier4_payor_name, r.tier4_payor_id, tier4_payor_name || ' (' || r.tier4_payor_id || ')' as tier4_payor,
  vendor_fc
from raw_revenue r left join (select tier4_payor_id, max(vendor_fc) as vendor_fc from ins_codes group by tier4_payor_id) i
  on r.tier4_payor_id = i.tier4_payor_id""")
def load_revenue(t):
    return loaders.load_revenue(t.raw_revenue, t.ins_codes)


@register("q_load_case", "raw_case", """
select accession, cast(cast(case_no as bigint) as varchar) as case_no, cast(cast(ticket_no as bigint) as varchar) as ticket_no,
  cast(strptime(cast(cast(entry_month as bigint) as varchar), '%Y%m') as date) as entry_month,
  cast(try_strptime(update_dt, '%Y%m%d') as date) as update_dt,
  try_strptime(added_date || ' ' || added_time, '%Y%m%d %H:%M:%S') as added_ts
from raw_case""")
def load_case(t):
    return loaders.load_case(t.raw_case)


@register("q_load_appeal", "raw_appeal", """
select cast(case_number as varchar) as appeal_case_no, level as level_code, status as appeal_status, status_desc as appeal_status_desc,
  cast(try_strptime(entry_date, '%Y%m%d') as date) as entry_dt, cast(try_strptime(denial_letter_date, '%Y%m%d') as date) as denial_dt,
  cast(null as date) as letter_dt, ltrim(denial_reason, '0') as den_reason, cast(null as varchar) as den_reason_desc,
  insurer_code as ins_code, cast(null as varchar) as campaign_code
from raw_appeal""")
def load_appeal(t):
    return loaders.load_appeal(t.raw_appeal).rows


@register("q_load_complete_appeal", "raw_complete_appeal", """
select cast(ticket_number as varchar) as appeal_ticket_no, cast(case_number as varchar) as appeal_case_no,
  cast(null as varchar) as appeal_request_no, cast(accession as varchar) as accession,
  case test_code when 'GL' then 'IBC' when 'GLD' then 'DCIS' when 'GLC' then 'Colon' when 'GLP' then 'Prostate'
    when 'ARV7' then 'Prostate-AR-V7' else test_code end as test,
  cast(try_strptime(service_date, '%Y%m%d') as date) as appeal_dos, cast(null as varchar) as appeal_ins_code,
  cast(null as varchar) as appeal_ins_fc, cast(cast(try_cast(denial_reason as double) as bigint) as varchar) as appeal_den_reason,
  cast(null as varchar) as appeal_den_reason_desc, cast(amount_charged as double) as appeal_amt_charged,
  cast(null as double) as appeal_amt_expected, cast(null as double) as appeal_amt_allowed, cast(null as double) as appeal_amt_received,
  cast(null as double) as appeal_amt, try_cast(amount_applied as double) as appeal_amt_applied, cast(null as date) as appeal_report_dt,
  cast(cast(success as bigint) as varchar) as appeal_success, currency as appeal_currency
from raw_complete_appeal""")
def load_complete_appeal(t):
    return loaders.load_complete_appeal(t.raw_complete_appeal).rows


@register("q_load_prior_auth", "raw_prior_auth", """
select cast(case_number as varchar) as prior_auth_case_no, cast(try_strptime(entered_date, '%Y%m%d') as date) as prior_auth_entered_dt,
  result as prior_auth_result, request as prior_auth_req_desc, number as prior_auth_number, cast(null as varchar) as prior_auth_category
from raw_prior_auth""")
def load_prior_auth(t):
    return loaders.load_prior_auth(t.raw_prior_auth).rows
