"""Registered queries: the report pipelines."""

from pyspark.sql import functions as F

from claimtide import rules
from claimtide.lens.queries_appeals import (
    PAYOR, POLICY_HEADER, SETS, VIEWS, WIDE, _flag_sql, _set_sql, journal, wide)
from claimtide.lens.queries_claims import CONFLICTS, PAY, REF, SINGLE, bill_std, hierarchy, pay_std
from claimtide.lens.queries_ledgers import HEADS, JOURNAL_SQL, PERIOD_PARTS, TICKET_REVENUE, TRANSACTIONS
from claimtide.lens.registry import (
    GROUPS, HIERARCHY, PAY_STD, RECEIPT, RECEIPT_AMOUNTS, REVENUE_AMOUNTS, REVENUE_ROLLUP, Tables, doubles,
    register)
from claimtide.operators import appeals, ledger, quality
from claimtide.plans import reports


def claim_tables(t: Tables) -> reports.ClaimTables:
    return reports.ClaimTables(
        bill=bill_std(t), payment=pay_std(t), claim_case=t.claim_case, oli=t.oli, revenue=t.revenue,
        payors=hierarchy(t), appeal=appeals.appeal_journal(journal(t), t.complete_appeal), appeal_wide=wide(t),
        prior_auth=t.prior_auth, specimen=t.specimen, somn=t.somn, prices=t.price, view_members=t.view_set,
        view_sets=SETS, adjustment_code=t.adjustment_code)


C2R_VIEWS = f"price bill payment adjustment_code claim_case oli revenue payor ins_codes prior_auth specimen somn view_set {VIEWS}"
DONE = "('Completed', 'Final Review', 'Due from Patient')"
C2R_JOINED = f"""
select o.oli_id, o.order_id, o.test, o.order_start_dt, o.business_unit, o.territory, o.billed_currency, o.contracted_price,
  o.revenue_status, o.customer_status, o.data_entry_status, o.failure_message,
  coalesce(o.list_price, pr.std_list_price) as list_price, o.current_ticket_no as bi_current_ticket_no,
  r.case_cnt, r.current_ticket_no, r.case_status_sum2 as vendor_sum2, r.case_status as vendor_status, r.ticket_plan_vendor,
  r.claim_entry_dt, r.days_to_init_payment, r.days_to_last_payment, r.ticket_cnt, r.current_case_no,
  coalesce(o.dos, r.vendor_dos) as dos, o.delivered_dt as own_delivered_dt, o.test_delivered as original_test_delivered,
  coalesce(o.line_cancel_reason, o.order_cancel_reason) as line_cancel_reason,
  coalesce(o.order_cancel_reason, o.line_cancel_reason) as order_cancel_reason,
  a.tier1_payor, a.tier1_payor_id, a.tier2_payor, a.tier2_payor_id, a.tier4_payor, a.tier4_payor_id, a.financial_category,
  b.tier2_payor as primary_tier2_payor, b.tier1_payor_id as primary_tier1_payor_id, b.tier2_payor_id as primary_tier2_payor_id,
  b.tier4_payor_id as primary_tier4_payor_id, b.financial_category as primary_financial_category,
  {', '.join('k.' + c for c in RECEIPT_AMOUNTS)},
  {', '.join(f'case when k.oli_id is not null then v.{c} end as {c}' for c in
             [*REVENUE_AMOUNTS, 'period_cnt', 'period_init', 'period_last'])},
  al.allowed_amt, s.procedure_type, s.specimen_age, s.adjuvant_chemo_candidate, n.somn_status,
  w.appeal_case_no, w.appeal_success, w.appeal_den_reason, w.appeal_den_reason_desc, w.last_level, w.first_entry_dt,
  w.appeal_amt_applied, w.a1_status_desc, w.er_status, p.prior_auth_case_no, p.prior_auth_result, p.prior_auth_category,
  p.prior_auth_number, p.pre_claim_failure
from oli o left join current_reference r on o.oli_id = r.oli_id
left join price pr on o.test = pr.test and o.billed_currency = pr.billed_currency
left join hierarchy a on r.ticket_plan_house = a.tier4_payor_id
left join hierarchy b on r.primary_plan_house = b.tier4_payor_id
left join receipt k on o.oli_id = k.oli_id left join revenue_rollup v on o.oli_id = v.oli_id
left join (select oli_id, max(allowed_amt) as allowed_amt from pay_signed where txn_type = 'RI' and txn_amount > 0
  group by oli_id) al on o.oli_id = al.oli_id
left join specimen s on o.oli_id = s.oli_id left join somn n on o.oli_id = n.oli_id
left join appeal_wide w on o.oli_id = w.accession and r.current_ticket_no = w.appeal_ticket_no
left join prior_auth p on r.current_case_no = p.prior_auth_case_no"""
C2R_STATUS = f"""
select *, case when current_ticket_no is null then 0 else 1 end as is_claim,
  case when vendor_sum2 = 'Completed' then 1 when vendor_sum2 is not null then 0 end as is_fully_adjudicated,
  case when current_ticket_no is not null then 1 else original_test_delivered end as test_delivered,
  case when own_delivered_dt is null and (current_ticket_no is not null or original_test_delivered = 1) then dos
    else own_delivered_dt end as delivered_dt,
  case when tier4_payor_id is distinct from primary_tier4_payor_id then 'Yes' else 'No' end as rerouted_ticket,
  case when appeal_success = '1' then 'Success' when appeal_success = '0' then 'Failed' when appeal_den_reason is null then null
    when vendor_sum2 in {DONE} then 'Removed' else 'In Process' end as appeal_result,
  case when contracted_price is null then 0 else 1 end as is_contract,
  case when revenue_status = 'Accrual' then 1 else 0 end as is_accrual,
  {', '.join(_set_sql(n, c, n) for n, c in SETS.items())},
  {', '.join(_set_sql(n, 'primary_' + c, 'primary_' + n) for n, c in SETS.items())}
from c2r_joined"""
C2R = f"""
select *, case when test_delivered = 1 then 'Delivered' when failure_message is not null then 'Failed'
    when line_cancel_reason is not null then 'Canceled' else customer_status end as status,
  case when appeal_result is null then 0 else 1 end as has_result,
  case when appeal_den_reason is null then 0 else 1 end as is_appeal,
  cast(coalesce(appeal_result = 'In Process', false) as integer) as in_process, cast(coalesce(appeal_result = 'Removed', false) as integer) as removed,
  case when appeal_result = 'In Process' then 'Appeals'
    when appeal_result in ('Success', 'Failed') and vendor_sum2 not in {DONE} then 'Final Review'
    when appeal_result is null and vendor_sum2 = 'Appeals' then 'Claim in Process' else vendor_sum2 end as case_status_sum2,
  case when appeal_result in ('Success', 'Failed') and vendor_sum2 not in {DONE} then 'Final Review' else vendor_status end as orig_case_status,
  case when appeal_result in ('Success', 'Failed') and vendor_sum2 not in {DONE} then 'Final Review'
    when vendor_status = 'Paid!' and grp_revenue_impact_adjustment > 0 then 'Partial Paid' else vendor_status end as case_status
from c2r_status"""
C2R_SQL = {**PAY, **REF, "receipt": RECEIPT, "revenue_rollup": REVENUE_ROLLUP, "hierarchy": HIERARCHY, **WIDE,
           "c2r_joined": C2R_JOINED, "c2r_status": C2R_STATUS, "c2r": C2R}

C2R_AMOUNTS = ["list_price", "contracted_price", *RECEIPT_AMOUNTS, *REVENUE_AMOUNTS, "allowed_amt", "appeal_amt_applied"]
C2R_PLAIN = ["oli_id", "order_id", "test", "order_start_dt", "business_unit", "billed_currency", "bi_current_ticket_no",
             "case_cnt", "current_ticket_no", "current_case_no", "ticket_cnt", "ticket_plan_vendor", "claim_entry_dt",
             "days_to_init_payment", "days_to_last_payment", "dos", "delivered_dt", "original_test_delivered",
             "test_delivered", "is_claim", "is_fully_adjudicated", "line_cancel_reason", "order_cancel_reason", "status",
             "tier1_payor", "tier2_payor", "tier4_payor", "financial_category", "primary_tier2_payor",
             "primary_financial_category", "rerouted_ticket", "period_cnt", "period_init", "period_last",
             "procedure_type", "specimen_age", "somn_status", "appeal_case_no", "appeal_success", "appeal_den_reason",
             "appeal_result", "is_appeal", "in_process", "removed", "case_status_sum2", "case_status",
             "orig_case_status", "is_contract", "is_accrual", "prior_auth_result", "pre_claim_failure",
             *SETS, *[f"primary_{s}" for s in SETS]]


# What the code table adds to the fixed groups: a group and all categories.
CODE_COLUMNS = {"grp_new_group": ("adj_group", "New Group"), **{
    f"cat_{c.lower().replace(' ', '_')}": ("category_desc", c) for c in
    ("Abandoned", "Charged in Error", "Contractual", "Financial Assistance", "New", "None", "Refund")}}
CODE_SUMS = f"""
select oli_id, {', '.join(f"cast(coalesce(sum(txn_amount) filter (where txn_type in ('AC', 'AD') and {by} = '{v}'), 0) as double) as {n}"
                          for n, (by, v) in CODE_COLUMNS.items())}
from pay_signed where oli_id is not null group by oli_id"""


@register("q_claim_to_revenue", C2R_VIEWS, f"""
select {', '.join('c.' + n for n in C2R_PLAIN)}, {doubles(*C2R_AMOUNTS, source='c')},
  {', '.join(f'case when c.charge is not null then coalesce(s.{n}, 0) end as {n}' for n in CODE_COLUMNS)}
from c2r c left join code_sums s on c.oli_id = s.oli_id""", **C2R_SQL, code_sums=CODE_SUMS)
def claim_to_revenue(t):
    return reports.claim_to_revenue(claim_tables(t)).select(*C2R_PLAIN, *C2R_AMOUNTS, *CODE_COLUMNS)


RISK_PLAIN = ["order_id", "oli_id", "test", "delivered_dt", "claim_entry_dt", "days_to_init_payment",
              "days_to_last_payment", "current_ticket_no", "ticket_cnt", "case_cnt", "case_status_sum2", "case_status",
              "orig_case_status", "tier1_payor", "tier1_payor_id", "tier2_payor", "tier2_payor_id", "tier4_payor",
              "tier4_payor_id", "ticket_plan_vendor", "financial_category", "test_delivered", "is_claim",
              "is_fully_adjudicated", "rerouted_ticket", "status", "business_unit", "territory", "order_start_dt",
              "procedure_type", "specimen_age", "adjuvant_chemo_candidate", "somn_status", "appeal_den_reason",
              "appeal_den_reason_desc", "appeal_success", "appeal_result", "prior_auth_result", "prior_auth_category",
              "prior_auth_number", "pre_claim_failure"]
RISK_AMOUNTS = ["total_billed", "charge", "total_payment", "payor_paid", "patient_paid", "allowed_amt", *GROUPS]


@register("q_payment_risk", C2R_VIEWS, f"""
select {', '.join(RISK_PLAIN)}, {doubles(*RISK_AMOUNTS)} from c2r where business_unit = 'Domestic'""", **C2R_SQL)
def payment_risk(t):
    out = reports.payment_risk(reports.claim_to_revenue(claim_tables(t)))
    return out.drop("tier1_payor_name", "tier2_payor_name", "tier4_payor_name")


LEDGER_ROWS = f"""
select oli_id, currency, txn_type, txn_amount, vendor_adj_code, adj_desc, house_adj_code, category_desc, adj_group,
  case when txn_type in ('accrual_usd_revenue', 'cash_usd_revenue') then 'USDRevenue'
    when txn_type in ('accrual_revenue', 'cash_revenue') then 'Revenue'
    when txn_type in ('charge', 'GH04:Charged in Error') then 'Billing' else 'Receipts' end as txn_category
from ({' union all '.join(f"""
  select oli_id, billed_currency as currency, '{'Outstanding' if m == 'outstanding' else m}' as txn_type, cast({m} as double) as txn_amount,
    null as vendor_adj_code, null as adj_desc, null as house_adj_code, null as category_desc, null as adj_group
  from c2r where current_ticket_no is not null and billed_currency is not null and {m} <> 0""" for m in ledger.DETAIL_METRICS)}
  union all
  select oli_id, currency, house_adj_code || ':' || category_desc, cast(sum(txn_amount) as double), vendor_adj_code, adj_desc,
    house_adj_code, category_desc, adj_group
  from pay_signed where txn_type in ('AC', 'AD') and oli_id is not null and vendor_adj_code is not null
    and adj_desc is not null and house_adj_code is not null and category_desc is not null and adj_group is not null
  group by all having sum(txn_amount) <> 0)"""
BILLING_PLAIN = ["oli_id", "order_id", "test", "order_start_dt", "status", "case_status_sum2", "case_status", "billed_currency",
                 "tier1_payor", "tier2_payor", "tier4_payor", "financial_category", "primary_tier2_payor", "business_unit",
                 "territory", "last_level", "first_entry_dt", "a1_status_desc", "appeal_den_reason",
                 "appeal_den_reason_desc", "appeal_success", "appeal_result", "prior_auth_result", "prior_auth_category"]
BILLING_AMOUNTS = ["list_price", "contracted_price", "outstanding", "total_billed", "charge", "total_payment", "payor_paid",
                   "patient_paid", "total_adjustment", *GROUPS, "allowed_amt", *REVENUE_AMOUNTS]


@register("q_domestic_billing", C2R_VIEWS, f"""
select {', '.join(BILLING_PLAIN)}, {doubles(*BILLING_AMOUNTS)} from c2r where business_unit = 'Domestic'""", **C2R_SQL)
def domestic_billing(t):
    out = reports.domestic_billing(reports.claim_to_revenue(claim_tables(t)))
    return out.select(*BILLING_PLAIN, *BILLING_AMOUNTS)


@register("q_oli_transactions", C2R_VIEWS, f"""
select l.*, c.test, {', '.join(f'c.{n}' for n in SETS)} from ({LEDGER_ROWS}) l
left join c2r c on l.oli_id = c.oli_id""", **C2R_SQL)
def oli_transactions(t):
    tables = claim_tables(t)
    out = reports.oli_transactions(reports.claim_to_revenue(tables), tables)
    return out.select("oli_id", "currency", "txn_type", "txn_amount", "vendor_adj_code", "adj_desc", "house_adj_code",
                      "category_desc", "adj_group", "txn_category", "test", *SETS)


@register("q_appeals_detail", C2R_VIEWS, """
select primary_tier1_payor_id, primary_tier2_payor_id, primary_tier4_payor_id, primary_financial_category,
  appeal_result as "Appeal Result", appeal_den_reason_desc as "Appeal Den Reason Desc", delivered_dt,
  case_status_sum2 as "Billing Case", current_case_no as "Case Number", oli_id as "Oliid", a1_status_desc as "A1",
  cast(appeal_amt_applied as double) as "Appeal Amt Apl Rec"
from c2r where test = 'Prostate' and business_unit = 'Domestic' and appeal_result is not null""", **C2R_SQL)
def appeals_detail(t):
    out = reports.appeals_detail(reports.claim_to_revenue(claim_tables(t)), "Prostate")
    levels = [lv for lv in rules.APPEAL_LEVELS if lv != "A1"]
    return out.drop(*levels, *[f"primary_tier{n}_payor_name" for n in (1, 2, 4)])


@register("q_appeal_extract", C2R_VIEWS, f"""
select order_id, oli_id, test, order_start_dt, delivered_dt, current_ticket_no, current_case_no, case_status_sum2, case_status,
  primary_tier2_payor, is_claim, er_status, last_level, first_entry_dt, appeal_den_reason, appeal_result, is_appeal, in_process,
  removed, {', '.join(f'primary_{s}' for s in SETS)}
from c2r where test = 'Prostate'""", **C2R_SQL)
def appeal_extract(t):
    tables = claim_tables(t)
    out = reports.appeal_extract(reports.claim_to_revenue(tables), tables, "Prostate")
    return out.select("order_id", "oli_id", "test", "order_start_dt", "delivered_dt", "current_ticket_no",
                      "current_case_no", "case_status_sum2", "case_status", "primary_tier2_payor", "is_claim",
                      "er_status", "last_level", "first_entry_dt", "appeal_den_reason", "appeal_result", "is_appeal",
                      "in_process", "removed", *[f"primary_{s}" for s in SETS])


@register("q_managed_care", C2R_VIEWS, f"""
select oli_id, billed_currency, is_contract, is_accrual, {', '.join(SETS)},
  {doubles('total_billed', 'total_payment', 'total_adjustment', 'allowed_amt')},
  cast(accrual_usd_revenue as double) as accrual_usd_revenue_, cast(total_payment as double) as total_payment_,
  cast(outstanding as double) as outstanding_ from c2r""", **C2R_SQL)
def managed_care(t):
    tables = claim_tables(t)
    out = reports.managed_care(reports.claim_to_revenue(tables), tables)
    return out.select("oli_id", "billed_currency", "is_contract", "is_accrual", *SETS, "total_billed", "total_payment",
                      "total_adjustment", "allowed_amt", "accrual_usd_revenue_", "total_payment_", "outstanding_")


HEADER = f"""
select coalesce(r.oli_id, o.oli_id) as oli_id, coalesce(r.ticket_no, o.current_ticket_no) as ticket_no, o.current_ticket_no,
  {', '.join(f'case when r.oli_id is null then o.{c} else r.{c} end as {c}' for c in PAYOR)}, s.case_status_sum2
from (select * from (select *, row_number() over (partition by oli_id, ticket_no order by period desc nulls last,
    plan desc, tier1_payor desc, tier2_payor desc, tier4_payor desc) as rn from revenue) where rn = 1) r
full join oli o on r.oli_id = o.oli_id and r.ticket_no = o.current_ticket_no
left join oli s on coalesce(r.oli_id, o.oli_id) = s.oli_id"""


def appeal_reports(t: Tables):
    return reports.appeal_reports(claim_tables(t), PAYOR, ["case_status_sum2"])


@register("q_appeal_cases", VIEWS + " revenue oli", f"""
select j.event_id, j.accession, h.ticket_no, h.current_ticket_no, h.tier2_payor, f.appeal_success,
  case when h.current_ticket_no = j.appeal_ticket_no then '1' when h.current_ticket_no is not null then '0' end as current_is_appealed,
  case when f.appeal_success = '1' then 'Success' when f.appeal_success = '0' then 'Failed'
    when h.case_status_sum2 in {DONE} then 'Removed' when h.case_status_sum2 is not null then 'In process' end as appeal_result
from journal j join header h on j.accession = h.oli_id and j.appeal_ticket_no = h.ticket_no
left join complete_appeal f on j.appeal_case_no = f.appeal_case_no and j.appeal_ticket_no = f.appeal_ticket_no
  and j.accession = f.accession""", journal=WIDE["journal"], header=HEADER)
def appeal_cases(t):
    return appeal_reports(t).cases.select("event_id", "accession", "ticket_no", "current_ticket_no", "tier2_payor",
                                          "appeal_success", "current_is_appealed", "appeal_result")


@register("q_appeal_lines", VIEWS + " revenue oli", f"""
select h.oli_id, h.ticket_no, h.current_ticket_no, h.tier2_payor, h.case_status_sum2, w.appeal_case_no, w.appeal_ticket_no,
  w.case_level_cnt, w.a2_status_desc, w.appeal_success, w.appeal_ins_code,
  case when h.current_ticket_no = w.appeal_ticket_no then '1' when h.current_ticket_no <> w.appeal_ticket_no then '0' end as current_is_appealed,
  case when w.appeal_success = '1' then 'Success' when w.appeal_success = '0' then 'Failed'
    when h.case_status_sum2 in {DONE} then 'Removed' else 'In Process' end as appeal_result
from appeal_wide w left join header h on w.accession = h.oli_id and w.appeal_ticket_no = h.ticket_no""", **WIDE, header=HEADER)
def appeal_lines(t):
    return appeal_reports(t).lines.select(
        "oli_id", "ticket_no", "current_ticket_no", "tier2_payor", "case_status_sum2", "appeal_case_no",
        "appeal_ticket_no", "case_level_cnt", "a2_status_desc", "appeal_success", "appeal_ins_code",
        "current_is_appealed", "appeal_result")


@register("q_allowable", "payment adjustment_code oli", """
select p.oli_id, p.ticket_no, cast(-txn_amount as double) as payor_paid,
  cast(-txn_amount + deductible_amt + coins_amt as double) as compare_amt, o.tier2_payor
from pay_std p left join oli o on p.oli_id = o.oli_id and p.ticket_no = o.current_ticket_no
where txn_type = 'RI' and p.oli_id in (select oli_id from single)""", pay_std=PAY_STD, single=SINGLE)
def allowable(t):
    return reports.allowable(claim_tables(t)).single.select(
        "oli_id", "ticket_no", "payor_paid", "compare_amt", "tier2_payor")


@register("q_unit_price", "payment adjustment_code oli", f"""
select a.oli_id, cast(allowed_amt as double) as allowed_amt, o.delivered_dt, o.tier2_payor, o.current_ticket_no,
  {doubles('list_price', 'contracted_price', source='o')}
from (select oli_id, max(allowed_amt) as allowed_amt from pay_std where txn_type = 'RI' and txn_amount < 0 and oli_id is not null
  group by oli_id) a left join oli o on a.oli_id = o.oli_id""", pay_std=PAY_STD)
def unit_price(t):
    return reports.unit_price(claim_tables(t)).select(
        "oli_id", "allowed_amt", "delivered_dt", "tier2_payor", "current_ticket_no", "list_price", "contracted_price")


@register("q_revenue_errors", "revenue", f"""
select oli_id, ticket_no, period, {doubles('total')} from revenue
where oli_id in (select oli_id from conflicts) or not regexp_matches(cast(oli_id as varchar), '[0-8]$')""", conflicts=CONFLICTS)
def revenue_errors(t):
    ok = quality.well_formed_id("oli_id", "[0-8]$", ())
    out = reports.oli_revenue(t.oli, t.revenue, ["oli_id"], id_ok=ok)
    return out.errors.select("oli_id", "ticket_no", "period", "total")


@register("q_payor_subset", "revenue oli", f"""
select o.oli_id, o.test, o.tier2_payor_name, {doubles('total_usd', source='r')}
from oli o left join (select oli_id, sum(total_usd) as total_usd from revenue
  where oli_id not in (select oli_id from conflicts) group by oli_id) r on o.oli_id = r.oli_id
where o.test = 'Prostate' and o.tier1_payor is not null and o.tier2_payor_name like '%yor 1%'""", conflicts=CONFLICTS)
def payor_subset(t):
    # Order lines without a payor of their own take the one of the revenue file.
    lines = t.oli.filter(F.col("tier1_payor").isNotNull())
    subset = reports.oli_revenue(lines, t.revenue, ["oli_id"], payor="YOR 1").subset
    return subset.select("oli_id", "test", "tier2_payor_name", "total_usd")


# ticket and period -----------------------------------------------------------

MONTHLY_VIEWS = "bill payment adjustment_code revenue oli payor ins_codes view_set"
MONTHLY = f"""
select p.*, {', '.join(_set_sql(n, c, n) for n, c in SETS.items())} from (
select a.oli_id, a.ticket_no, a.acct_period, {doubles('charge', 'grp_other', 'outstanding', source='a')},
  cast(grp_all_other_adjustment + grp_house_adjustment + grp_insurance_adjustment + grp_revenue_impact_adjustment + grp_other
    as double) as adjustment, o.territory, c.ticket_cnt, h.tier1_payor_id, h.tier2_payor_id, h.tier4_payor_id, h.tier4_payor
from p_all a left join ticket_head k on a.oli_id = k.oli_id and a.ticket_no = k.ticket_no
left join revenue_head r on a.oli_id = r.oli_id and a.ticket_no = r.ticket_no
left join oli o on a.oli_id = o.oli_id
left join (select oli_id, count(distinct ticket_no) as ticket_cnt from bill group by oli_id) c on a.oli_id = c.oli_id
left join hierarchy h on coalesce(k.plan, r.plan) = h.tier4_payor_id) p"""
MONTHLY_COLUMNS = ["oli_id", "ticket_no", "acct_period", "charge", "grp_other", "outstanding", "adjustment", "territory",
                   "ticket_cnt", "tier1_payor_id", "tier2_payor_id", "tier4_payor_id", "tier4_payor", *SETS]


@register("q_accounting_period", MONTHLY_VIEWS, MONTHLY, **PAY, **PERIOD_PARTS, **HEADS)
def accounting_period(t):
    return reports.accounting_period(claim_tables(t), ("territory",), wanted=MONTHLY_COLUMNS).select(*MONTHLY_COLUMNS)


# Sums of vendor signs turned afterwards equal the sums of turned amounts.
@register("q_accounting_period_criteria", MONTHLY_VIEWS, MONTHLY, **PAY, **PERIOD_PARTS, **HEADS)
def accounting_period_criteria(t):
    return reports.accounting_period(claim_tables(t), ("territory",), flip_after=True, wanted=MONTHLY_COLUMNS).select(*MONTHLY_COLUMNS)


@register("q_ticket_journal_v2", "bill payment adjustment_code revenue oli payor ins_codes prior_auth view_set", f"""
select x.*, {', '.join(_set_sql(n, c, n) for n, c in SETS.items())} from (
select j.* replace (case when txn_category = 'Revenue' then r.currency else j.currency end as currency),
  k.case_no, c.ticket_cnt, h.tier1_payor_id, h.tier2_payor_id, h.tier4_payor_id, a.prior_auth_result, a.prior_auth_number
from journal j left join ticket_head k on j.oli_id = k.oli_id and j.ticket_no = k.ticket_no
left join revenue_head r on j.oli_id = r.oli_id and j.ticket_no = r.ticket_no
left join (select oli_id, count(distinct ticket_no) as ticket_cnt from bill group by oli_id) c on j.oli_id = c.oli_id
left join hierarchy h on r.plan = h.tier4_payor_id
left join prior_auth a on k.case_no = a.prior_auth_case_no) x""", **JOURNAL_SQL, **{k: v for k, v in HEADS.items() if k != "bill_std"})
def ticket_journal_v2(t):
    out = reports.ticket_journal(claim_tables(t), 2)
    return out.select(*ledger.JOURNAL_COLUMNS, "case_no", "ticket_cnt", "tier1_payor_id", "tier2_payor_id", "tier4_payor_id",
                      "prior_auth_result", "prior_auth_number", *SETS)


# ticket report ---------------------------------------------------------------

CHECKED = """
select * from revenue where oli_id not in (select oli_id from conflicts) and regexp_matches(cast(oli_id as varchar), '[0-8]$')"""
CHECKED_TICKETS = TICKET_REVENUE.replace("from revenue", "from checked")
TICKET_VIEWS = {"conflicts": CONFLICTS, "checked": CHECKED, "transactions": TRANSACTIONS, "ticket_revenue": CHECKED_TICKETS}


def ticket_report(t: Tables):
    bills = (t.bill.filter(F.col("oli_id").isNotNull()).groupBy("oli_id", "ticket_no")
             .agg(F.sum("txn_amount").alias("ticket_billed"), F.count(F.lit(1)).alias("line_cnt")))
    lines = t.oli.select("oli_id", "current_ticket_no", "delivered_dt", "test", "billed_currency")
    return reports.ticket_revenue(bills, t.revenue, lines, ["oli_id", "ticket_no", "test", "billed_currency"],
                                  id_ok=quality.well_formed_id("oli_id", "[0-8]$", ()), since="1996-06-01")


@register("q_ticket_report", "bill revenue oli", f"""
select o.oli_id, o.current_ticket_no as ticket_no, o.test, o.delivered_dt, cast(x.ticket_billed as double) as ticket_billed,
  x.line_cnt, cast(x.total_usd as double) as total_usd, x.period_cnt
from oli o left join ticket_revenue x on o.oli_id = x.oli_id and o.current_ticket_no = x.ticket_no
where o.current_ticket_no is not null and o.delivered_dt >= date '1996-06-01'""", **TICKET_VIEWS)
def ticket_report_current(t):
    return ticket_report(t).current.select("oli_id", "ticket_no", "test", "delivered_dt", "ticket_billed", "line_cnt",
                                           "total_usd", "period_cnt")


@register("q_ticket_report_outdated", "bill revenue oli", f"""
select oli_id, ticket_no, {doubles('ticket_billed', 'total_usd')}, line_cnt, period_cnt from ticket_revenue
where ticket_no not in (select current_ticket_no from oli where current_ticket_no is not null)""", **TICKET_VIEWS)
def ticket_report_outdated(t):
    return ticket_report(t).outdated.select("oli_id", "ticket_no", "ticket_billed", "total_usd", "line_cnt", "period_cnt")


@register("q_ticket_report_ledger", "bill revenue oli", f"""
select oli_id, ticket_no, test, billed_currency, txn_subtype, value, 'Revenue' as txn_type
from ({' union all '.join(f"""
  select o.oli_id, o.current_ticket_no as ticket_no, o.test, o.billed_currency, '{m}' as txn_subtype, cast(s.v as double) as value
  from oli o join transactions x on o.oli_id = x.oli_id and o.current_ticket_no = x.ticket_no
  join (select oli_id, ticket_no, sum({m}) as v from checked group by all) s on s.oli_id = x.oli_id and s.ticket_no = x.ticket_no
  where o.current_ticket_no is not null and o.delivered_dt >= date '1996-06-01'""" for m in ("accrual_usd", "cash_usd"))})
where value <> 0 and test is not null and billed_currency is not null""", **TICKET_VIEWS)
def ticket_report_ledger(t):
    return ticket_report(t).ledger


# policies by the enum tables ---------------------------------------------------

TESTS = ("IBC", "Prostate", "DCIS", "Colon")
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@register("q_criteria_report", "policy criteria_enum", f"""
select {', '.join('p.' + c for c in POLICY_HEADER)}, e.label as criteria, e.value as condition,
  case when f = '' then '' when list_contains(string_split(f, ';'), e.value) then '1' else '0' end as coverage
from policy p join criteria_enum e on p.test = e.test and e.field <> 'absent_field'
cross join lateral (select coalesce(case e.field when 'brand_field' then p.brand_field else p.type_field end, '') as f)
where p.test in {TESTS}""")
def criteria_report(t):
    return reports.policy_criteria(t.policy, t.criteria_enum, POLICY_HEADER, TESTS).long


@register("q_criteria_report_wide", "policy", f"""
select {', '.join(POLICY_HEADER)}, type_field, {', '.join(f'{_flag_sql("type_field", v)} as "type_field={v}"' for v in TYPES)}
from policy where test = 'Prostate'""")
def criteria_report_wide(t):
    return reports.policy_criteria(t.policy, t.criteria_enum, POLICY_HEADER, TESTS).wide["Prostate"]


@register("q_validation_report", "validation pa_enum", """
select name, test, tier4_payor_id, e.value as pa_requirement, case when prior_authorization = '' then ''
    when list_contains(string_split(prior_authorization, ';'), e.value) then '1' else '0' end as requirement
from validation join pa_enum e on e.field = 'prior_authorization' and e.value is not null""")
def validation_report(t):
    return reports.policy_validation(t.validation, t.pa_enum, ["name", "test", "tier4_payor_id"], TESTS).long


REQUIREMENTS = ("Lab initiates PA", "New requirement", "No CVP (no PA)", "Online or Telephonic", "Post-DOS", "Pre-DOS", "SOMN")


@register("q_validation_report_wide", "validation", f"""
select name, test, tier4_payor_id, {', '.join(f'{_flag_sql("prior_authorization", r)} as "{r}"' for r in REQUIREMENTS)}
from validation where test = 'IBC'""")
def validation_report_wide(t):
    return reports.policy_validation(t.validation, t.pa_enum, ["name", "test", "tier4_payor_id"], TESTS).wide["IBC"]
