"""Registered queries: period report, journals, ledgers, revenue lines."""

from pyspark.sql import functions as F

from claimtide import rules
from claimtide.lens import tables
from claimtide.lens.queries_claims import (
    PAY, bill_std, hierarchy, pay_std, receipts, revenue_sums)
from claimtide.lens.registry import (
    BILL_STD, GROUPS, HIERARCHY, ORACLE, PAY_STD, RECEIPT, REVENUE_ROLLUP, Tables, doubles, register)
from claimtide.operators import ledger, period, quality, revenue_lines, rollup

# transaction detail --------------------------------------------------------

def claim_amounts(t: Tables):
    lines = t.oli.select("oli_id", "current_ticket_no", "billed_currency", "test", "territory")
    return lines.join(receipts(t), "oli_id", "left").join(revenue_sums(t).drop("currency"), "oli_id", "left")


@register("q_txn_detail", "oli bill payment adjustment_code revenue", f"""
select l.oli_id, l.currency, l.txn_type, l.txn_amount, l.vendor_adj_code, l.adj_desc,
  l.house_adj_code, l.category_desc, l.adj_group,
  case when l.txn_type in ('accrual_usd_revenue', 'cash_usd_revenue') then 'USDRevenue'
    when l.txn_type in ('accrual_revenue', 'cash_revenue') then 'Revenue'
    when l.txn_type in ('charge', 'GH04:Charged in Error') then 'Billing' else 'Receipts' end as txn_category,
  o.test, o.territory
from ({' union all '.join(f'''
  select o.oli_id, billed_currency as currency, '{"Outstanding" if m == "outstanding" else m}' as txn_type, cast({m} as double) as txn_amount,
    null as vendor_adj_code, null as adj_desc, null as house_adj_code, null as category_desc, null as adj_group
  from oli o join {"revenue_rollup" if m.endswith("revenue") else "receipt"} r on o.oli_id = r.oli_id
  where current_ticket_no is not null and {m} <> 0''' for m in ledger.DETAIL_METRICS)}
  union all
  select oli_id, currency, house_adj_code || ':' || category_desc, cast(sum(txn_amount) as double), vendor_adj_code, adj_desc,
    house_adj_code, category_desc, adj_group
  from pay_signed where txn_type in ('AC', 'AD') and oli_id is not null and vendor_adj_code is not null
    and adj_desc is not null and house_adj_code is not null and category_desc is not null and adj_group is not null
  group by all having sum(txn_amount) <> 0) l
left join oli o on l.oli_id = o.oli_id""", **PAY, receipt=RECEIPT, revenue_rollup=REVENUE_ROLLUP)
def txn_detail(t):
    payment = rollup.normalise_payment_sign(pay_std(t))
    return ledger.transaction_detail(claim_amounts(t), payment, ("test", "territory"))


# period report -------------------------------------------------------------

PERIOD_AMOUNTS = ["charge", "payor_paid", "patient_paid", *GROUPS, "grp_other", "total_revenue", "accrual_revenue", "cash_revenue",
                  "total_usd_revenue", "accrual_usd_revenue", "cash_usd_revenue", "outstanding"]
KEYS = "oli_id, ticket_no, acct_period"
PERIOD_PARTS = {
    "p_claim": f"select {KEYS}, sum(txn_amount) as charge from bill where oli_id is not null group by all",
    "p_pay": f"""select {KEYS}, sum(txn_amount) filter (where txn_type = 'RI') as payor_paid,
  sum(txn_amount) filter (where txn_type = 'RP') as patient_paid,
  {', '.join(f"sum(txn_amount) filter (where adj_group = '{g}') as {n}" for n, g in GROUPS.items())},
  sum(txn_amount) filter (where adj_group not in ({', '.join(f"'{g}'" for g in GROUPS.values())})) as grp_other
from pay_signed where oli_id is not null and (txn_type in ('RI', 'RP') or adj_group is not null) group by all""",
    "p_rev": """select oli_id, ticket_no, period as acct_period, sum(total) as total_revenue, sum(accrual) as accrual_revenue,
  sum(cash) as cash_revenue, sum(total_usd) as total_usd_revenue, sum(accrual_usd) as accrual_usd_revenue,
  sum(cash_usd) as cash_usd_revenue from revenue where recon_flag = '0' group by all""",
    "p_max": """select max(acct_period) as acct_period from (select acct_period from p_claim union all
  select acct_period from p_pay union all select acct_period from p_rev)""",
    "p_open": """select oli_id, ticket_no, (select acct_period from p_max) as acct_period, sum(ticket_balance) as outstanding
from bill where oli_id is not null group by all having sum(ticket_balance) <> 0""",
    "p_all": f"""select {KEYS}, {', '.join(f'coalesce({c}, 0) as {c}' for c in PERIOD_AMOUNTS)}
from p_claim full join p_pay using ({KEYS}) full join p_rev using ({KEYS}) full join p_open using ({KEYS})""",
}
PERIOD_TOTALS = """payor_paid + patient_paid + grp_refund_refund_reversal as payment, charge + grp_charged_in_error as billed,
  grp_all_other_adjustment + grp_house_adjustment + grp_insurance_adjustment + grp_revenue_impact_adjustment + grp_other as adjustment,
  case when charge + grp_charged_in_error > 0 then 1 else 0 end as new_claim"""


def period_inputs(t: Tables):
    return bill_std(t), pay_std(t), quality.reconciled(t.revenue)


@register("q_period_amounts", "bill payment adjustment_code revenue", f"""
select {KEYS}, {doubles(*PERIOD_AMOUNTS)}, cast(payment as double) as payment, cast(billed as double) as billed,
  cast(adjustment as double) as adjustment, new_claim
from (select *, {PERIOD_TOTALS} from p_all)""", **PAY, **PERIOD_PARTS)
def period_amounts(t):
    return period.accounting_period_amounts(*period_inputs(t))


TICKET_HEAD = """
select oli_id, ticket_no, case_no, test, currency, plan, delivered_dt, claim_entry_dt, primary_plan from (
  select oli_id, ticket_no, case_no, test, currency, ticket_plan_house as plan, dos as delivered_dt, txn_date as claim_entry_dt,
    primary_plan_house as primary_plan,
    row_number() over (partition by oli_id, ticket_no order by case_no desc, test desc, currency desc,
      ticket_plan_house desc nulls last, dos desc, txn_date desc, primary_plan_house desc) as rn
  from bill_std where oli_id is not null) where rn = 1"""
REVENUE_HEAD = """
select oli_id, ticket_no, currency, delivered_dt, test, plan from (
  select *, row_number() over (partition by oli_id, ticket_no order by period desc, currency desc nulls last,
    delivered_dt desc, test desc, plan desc) as rn from revenue where recon_flag = '0') where rn = 1"""
HEADS = {"bill_std": BILL_STD, "ticket_head": TICKET_HEAD, "revenue_head": REVENUE_HEAD, "hierarchy": HIERARCHY}
PERIOD_REPORT_COLUMNS = ["oli_id", "ticket_no", "acct_period", "charge", "payment", "billed", "adjustment", "outstanding",
                         "new_claim", "case_no", "claim_entry_dt", "currency", "test", "delivered_dt", "territory",
                         "ticket_cnt", "tier2_payor", "tier4_payor", "tier4_payor_id", "financial_category"]


@register("q_period_report", "bill payment adjustment_code revenue oli payor ins_codes", f"""
select a.oli_id, a.ticket_no, a.acct_period, {doubles('charge', source='a')},
  cast(payor_paid + patient_paid + grp_refund_refund_reversal as double) as payment,
  cast(charge + grp_charged_in_error as double) as billed,
  cast(grp_all_other_adjustment + grp_house_adjustment + grp_insurance_adjustment + grp_revenue_impact_adjustment + grp_other as double) as adjustment,
  {doubles('outstanding', source='a')}, case when charge + grp_charged_in_error > 0 then 1 else 0 end as new_claim,
  k.case_no, k.claim_entry_dt, coalesce(k.currency, r.currency) as currency,
  case when coalesce(k.test, r.test, o.test) = 'Unknown' then o.test else coalesce(k.test, r.test, o.test) end as test,
  coalesce(o.delivered_dt, k.delivered_dt, r.delivered_dt) as delivered_dt, o.territory, c.ticket_cnt,
  h.tier2_payor, h.tier4_payor, h.tier4_payor_id, h.financial_category
from p_all a left join ticket_head k on a.oli_id = k.oli_id and a.ticket_no = k.ticket_no
left join revenue_head r on a.oli_id = r.oli_id and a.ticket_no = r.ticket_no
left join oli o on a.oli_id = o.oli_id
left join (select oli_id, count(distinct ticket_no) as ticket_cnt from bill group by oli_id) c on a.oli_id = c.oli_id
left join hierarchy h on coalesce(k.plan, r.plan) = h.tier4_payor_id""", **PAY, **PERIOD_PARTS, **HEADS)
def period_report(t):
    payors = hierarchy(t).select("tier2_payor", "tier4_payor", "tier4_payor_id", "financial_category")
    out = period.period_report(*period_inputs(t), t.oli, payors, oli_columns=("territory",), wanted=PERIOD_REPORT_COLUMNS)
    return out.select(*PERIOD_REPORT_COLUMNS)


@register("q_period_criteria", "bill payment adjustment_code revenue", f"""
select {KEYS}, {doubles('payor_paid', 'patient_paid', *GROUPS, 'grp_other')} from p_all""", **PAY, **PERIOD_PARTS)
def period_criteria(t):
    out = period.accounting_period_amounts(*period_inputs(t), flip_after=True)
    return out.select("oli_id", "ticket_no", "acct_period", "payor_paid", "patient_paid", *GROUPS, "grp_other")


# journals ------------------------------------------------------------------

JOURNAL_REVENUE = """
select oli_id, ticket_no, period, sum(accrual) as accrual, sum(cash) as cash, sum(accrual_usd) as accrual_usd,
  sum(cash_usd) as cash_usd, avg(accrual) as mean_accrual from revenue where recon_flag = '0' group by all"""
JOURNAL = """
select oli_id, ticket_no, -1 as txn_line, acct_period, txn_date, currency, cast(txn_amount as double) as txn_amount,
  'Billing' as txn_category, 'Charge' as txn_type, null as vendor_adj_code, null as adj_desc, null as house_adj_code, null as adj_group
from bill_std where txn_amount <> 0
union all
select oli_id, ticket_no, -2, p.acct_period, p.acct_period, currency, cast(ticket_balance as double), 'Outstanding',
  'Outstanding', null, null, null, null
from bill_std, p_max p where ticket_balance <> 0
union all
select oli_id, ticket_no, txn_line, acct_period, txn_date, currency, cast(txn_amount as double),
  case when vendor_adj_code in ('C6', 'CCD') then 'Billing' when vendor_adj_code in ('D4', 'CF') then 'Payment'
    when txn_type in ('AC', 'AD') then 'Adjustment' else 'Payment' end,
  case txn_type when 'RI' then 'PayorPaid' when 'RP' then 'PatientPaid' else house_adj_code || ':' || category_desc end,
  vendor_adj_code, adj_desc, house_adj_code, adj_group
from pay_signed where txn_amount <> 0
union all
select oli_id, ticket_no, -3, period, period, null, cast(accrual as double), 'Revenue', 'AccrualRevenue', null, null, null, null
from journal_revenue where accrual <> 0
union all
select oli_id, ticket_no, -4, period, period, null, cast(cash as double), 'Revenue', 'CashRevenue', null, null, null, null
from journal_revenue where cash <> 0"""
JOURNAL_SQL = {**PAY, "bill_std": BILL_STD, **PERIOD_PARTS, "journal_revenue": JOURNAL_REVENUE, "journal": JOURNAL}


def journal(t: Tables):
    bill, payment, revenue = period_inputs(t)
    base = period.staged_base(bill, payment, revenue, headers=False)
    signed = rollup.normalise_payment_sign(payment)
    return ledger.ticket_journal(bill, signed, revenue, period.base_period(base), totals=base)


def attributed(t: Tables, payor_of: str, oli_columns=()):
    bill, payment, revenue = period_inputs(t)
    rows = period.staged_journal(bill, rollup.normalise_payment_sign(payment), revenue, period.line_attributes(t.oli, oli_columns),
                                 payor_of=payor_of)
    payors = hierarchy(t).select("tier4_payor_id", "tier4_payor", "financial_category")
    return period.attributed_journal(rows, payors, payor_of).drop("tier4_payor_id")


@register("q_journal", "bill payment adjustment_code revenue", "select * from journal", **JOURNAL_SQL)
def journal_rows(t):
    return journal(t)


@register("q_journal_v1", "bill payment adjustment_code revenue oli payor ins_codes", """
select j.*, case when txn_category = 'Revenue' then coalesce(r.test, o.test)
    when k.test = 'Unknown' then o.test else k.test end as test,
  case when txn_category = 'Revenue' then coalesce(r.delivered_dt, o.delivered_dt) else k.delivered_dt end as delivered_dt,
  c.ticket_cnt, h.tier4_payor, h.financial_category
from (select * replace (case when txn_category = 'Revenue' then (select currency from revenue_head r
    where r.oli_id = journal.oli_id and r.ticket_no = journal.ticket_no) else currency end as currency) from journal) j
left join ticket_head k on j.oli_id = k.oli_id and j.ticket_no = k.ticket_no
left join revenue_head r on j.oli_id = r.oli_id and j.ticket_no = r.ticket_no
left join oli o on j.oli_id = o.oli_id
left join (select oli_id, count(distinct ticket_no) as ticket_cnt from bill group by oli_id) c on j.oli_id = c.oli_id
left join hierarchy h on case when txn_category = 'Revenue' then r.plan else k.plan end = h.tier4_payor_id""",
          **JOURNAL_SQL, **{k: v for k, v in HEADS.items() if k != "bill_std"})
def journal_v1(t):
    return attributed(t, "claim")


@register("q_journal_v2", "bill payment adjustment_code revenue oli payor ins_codes", """
select j.* replace (case when txn_category = 'Revenue' then r.currency else j.currency end as currency),
  coalesce(r.test, o.test) as test, coalesce(r.delivered_dt, o.delivered_dt) as delivered_dt, k.case_no, k.claim_entry_dt,
  o.territory, o.business_unit, c.ticket_cnt, h.tier4_payor, h.financial_category
from journal j left join ticket_head k on j.oli_id = k.oli_id and j.ticket_no = k.ticket_no
left join revenue_head r on j.oli_id = r.oli_id and j.ticket_no = r.ticket_no
left join oli o on j.oli_id = o.oli_id
left join (select oli_id, count(distinct ticket_no) as ticket_cnt from bill group by oli_id) c on j.oli_id = c.oli_id
left join hierarchy h on r.plan = h.tier4_payor_id""",
          **JOURNAL_SQL, **{k: v for k, v in HEADS.items() if k != "bill_std"})
def journal_v2(t):
    return attributed(t, "revenue", ("territory", "business_unit"))


@register("q_journal_mean", "revenue", """
select oli_id, ticket_no, period as acct_period, round(cast(mean_accrual as double), 6) as mean_accrual
from journal_revenue where mean_accrual <> 0""", journal_revenue=JOURNAL_REVENUE)
def journal_mean(t):
    rows = ledger.revenue_entries(quality.reconciled(t.revenue), "mean").filter("txn_type = 'AccrualRevenue'")
    return rows.select("oli_id", "ticket_no", "acct_period",
                       F.round(F.col("txn_amount").cast("double"), 6).alias("mean_accrual"))


@register("q_journal_criteria", "bill payment adjustment_code revenue", """
select oli_id, ticket_no, txn_line, acct_period,
  cast(case when vendor_adj_code in ('C6', 'CCD') then txn_amount else -txn_amount end as double) as txn_amount,
  case when vendor_adj_code in ('C6', 'CCD') then 'Billing' else 'Receipts' end as txn_category,
  case when vendor_adj_code in ('C6', 'CCD') then 'Charged in Error' when vendor_adj_code in ('D4', 'CF') or txn_type in ('RI', 'RP')
    then 'Payment' else 'Adjustment' end as txn_subcategory,
  case when vendor_adj_code in ('C6', 'CCD') then 'CIE' when vendor_adj_code in ('D4', 'CF') then 'RR'
    when txn_type in ('AC', 'AD') then house_adj_code else txn_type end as txn_type,
  case when vendor_adj_code in ('C6', 'CCD') then 'Charged in Error' when vendor_adj_code in ('D4', 'CF') then 'Refund'
    when txn_type = 'RI' then 'PayorPaid' when txn_type = 'RP' then 'PatientPaid'
    else house_adj_code || ' : ' || category_desc end as txn_type_desc,
  case txn_type when 'RI' then 'PayorPaid' when 'RP' then 'PatientPaid' else adj_desc end as adj_desc,
  vendor_adj_code, payment_plan_vendor, is_primary_payment
from pay_std where txn_amount <> 0
union all
select oli_id, ticket_no, 0, acct_period, cast(txn_amount as double), 'Billing', 'Charges', 'CL', 'Claim Amount', null, null, null, null
from bill_std where txn_amount <> 0
union all
select oli_id, ticket_no, 0, acct_period, cast(ticket_balance as double), 'Receipts', 'Outstanding', 'RO', 'Outstanding',
  'Outstanding', null, null, null
from bill_std where ticket_balance <> 0
union all
select oli_id, ticket_no, -1, period, cast(amount as double), case when usd then 'USDRevenue' else 'Revenue' end,
  case when usd then 'USD' else '' end || kind, case kind when 'Accrual' then 'FA' else 'FC' end || case when usd then 'U' else '' end,
  case when usd then 'USD' else '' end || kind || 'Revenue', null, null, null, null
from (select *, accrual as amount, 'Accrual' as kind, false as usd from journal_revenue
  union all select *, cash, 'Cash', false from journal_revenue
  union all select *, accrual_usd, 'Accrual', true from journal_revenue
  union all select *, cash_usd, 'Cash', true from journal_revenue) where amount <> 0""",
          pay_std=PAY_STD, bill_std=BILL_STD, journal_revenue=JOURNAL_REVENUE)
def journal_criteria(t):
    out = ledger.ticket_journal_criteria(*period_inputs(t))
    return out.select("oli_id", "ticket_no", "txn_line", "acct_period", "txn_amount", "txn_category", "txn_subcategory",
                      "txn_type", "txn_type_desc", "adj_desc", "vendor_adj_code", "payment_plan_vendor",
                      "is_primary_payment")


# revenue lines -------------------------------------------------------------

EDGES = ["period", "claim_period", "currency", "ticket_no", "in_coverage", "revenue_status", "tier1_payor", "tier2_payor",
         "tier4_payor"]
SUMMARY = f"""
select s.*, {', '.join(f'a.{c} as {c}_init' for c in EDGES)}, {', '.join(f'b.{c} as {c}_last' for c in EDGES)}
from (select oli_id, sum(total_usd) as total_usd, sum(accrual_usd) as accrual_usd, sum(cash_usd) as cash_usd,
    cast(count(period) as bigint) as period_cnt, count(distinct ticket_no) as ticket_cnt from revenue group by oli_id) s
join (select *, row_number() over (partition by oli_id order by period nulls last,
    {', '.join(c + ' nulls first' for c in EDGES)}) as rn from revenue) a on s.oli_id = a.oli_id and a.rn = 1
join (select *, row_number() over (partition by oli_id order by {', '.join(c + ' desc nulls last' for c in EDGES)}) as rn
  from revenue) b on s.oli_id = b.oli_id and b.rn = 1"""
FILLED = """
select * replace (coalesce(claim_period, case when day(delivered_dt) = 1 then cast(delivered_dt - interval 1 month as date)
    else cast(date_trunc('month', delivered_dt) as date) end) as claim_period)
from (select coalesce(o.oli_id, s.oli_id) as oli_id, o.test, o.delivered_dt, o.billed_currency, o.list_price, o.contracted_price,
  case when o.tier1_payor is null then s.tier1_payor_last else o.tier1_payor end as tier1_payor,
  case when o.tier1_payor is null then s.tier2_payor_last else o.tier2_payor end as tier2_payor,
  case when o.tier1_payor is null then split_part(s.tier2_payor_last, ' (', 1) else o.tier2_payor_name end as tier2_payor_name,
  case when o.tier1_payor is null then regexp_extract(s.tier2_payor_last, '\\(([^)]*)\\)', 1) else o.tier2_payor_id end as tier2_payor_id,
  s.claim_period_last as claim_period, s.total_usd, s.accrual_usd, s.cash_usd, s.period_cnt, s.ticket_cnt,
  s.ticket_no_init, s.ticket_no_last
from oli o full join summary s on o.oli_id = s.oli_id)"""


@register("q_revenue_summary", "revenue", f"""
select * replace ({doubles('total_usd', 'accrual_usd', 'cash_usd')}) from summary""", summary=SUMMARY)
def revenue_summary(t):
    return revenue_lines.revenue_summary(t.revenue)


LINE_COLUMNS = ["oli_id", "test", "delivered_dt", "tier1_payor", "tier2_payor", "tier2_payor_name", "tier2_payor_id",
                "claim_period", "period_cnt", "ticket_cnt", "ticket_no_init", "ticket_no_last"]


@register("q_oli_revenue", "oli revenue", f"""
select {', '.join(LINE_COLUMNS)}, {doubles('total_usd', 'accrual_usd', 'cash_usd')},
  strftime(claim_period, '%b %Y') as claim_period_label
from filled""", summary=SUMMARY, filled=FILLED)
def oli_revenue(t):
    out = revenue_lines.oli_payment_revenue(t.oli, t.revenue)
    return out.select(*LINE_COLUMNS, "total_usd", "accrual_usd", "cash_usd", "claim_period_label")


@register("q_oli_ledger", "oli revenue", f"""
select oli_id, test, claim_period, billed_currency, txn_subtype, value,
  case when txn_subtype in ('accrual_usd', 'cash_usd') then 'Revenue' else 'PriceBook' end as txn_type
from ({' union all '.join(f"select *, '{m}' as txn_subtype, cast({m} as double) as value from filled" for m in
      ('accrual_usd', 'cash_usd', 'list_price', 'contracted_price'))})
where value <> 0 and oli_id is not null and test is not null and claim_period is not null and billed_currency is not null""",
          summary=SUMMARY, filled=FILLED)
def oli_ledger(t):
    lines = revenue_lines.oli_payment_revenue(t.oli, t.revenue)
    return ledger.classed_ledger(lines, ["oli_id", "test", "claim_period", "billed_currency"])


TRANSACTIONS = """
select oli_id, ticket_no, sum(txn_amount) as ticket_billed, count(*) as line_cnt from bill where oli_id is not null group by all"""
TICKET_REVENUE = """
select x.*, s.total_usd, s.period_cnt from transactions x left join (
  select oli_id, ticket_no, sum(total_usd) as total_usd, cast(count(period) as bigint) as period_cnt from revenue group by all) s
  on x.oli_id = s.oli_id and x.ticket_no = s.ticket_no"""


def ticket_revenue(t: Tables):
    bills = (t.bill.filter(F.col("oli_id").isNotNull()).groupBy("oli_id", "ticket_no")
             .agg(F.sum("txn_amount").alias("ticket_billed"), F.count(F.lit(1)).alias("line_cnt")))
    lines = t.oli.select("oli_id", "current_ticket_no", "delivered_dt", "test")
    return revenue_lines.oli_ticket_revenue(bills, t.revenue, lines, since="1996-06-01")


@register("q_ticket_revenue", "bill revenue oli", f"""
select o.oli_id, o.current_ticket_no, o.delivered_dt, o.test, o.current_ticket_no as ticket_no,
  cast(x.ticket_billed as double) as ticket_billed, x.line_cnt, cast(x.total_usd as double) as total_usd, x.period_cnt
from oli o left join ticket_revenue x on o.oli_id = x.oli_id and o.current_ticket_no = x.ticket_no
where o.current_ticket_no is not null and o.delivered_dt >= date '1996-06-01'""",
          transactions=TRANSACTIONS, ticket_revenue=TICKET_REVENUE)
def current_ticket_revenue(t):
    return ticket_revenue(t).current.drop("accrual_usd", "cash_usd")


@register("q_outdated", "bill revenue oli", f"""
select oli_id, ticket_no, {doubles('ticket_billed', 'total_usd')}, line_cnt, period_cnt from ticket_revenue
where ticket_no not in (select current_ticket_no from oli where current_ticket_no is not null)""",
          transactions=TRANSACTIONS, ticket_revenue=TICKET_REVENUE)
def outdated(t):
    return ticket_revenue(t).outdated.drop("accrual_usd", "cash_usd")


# revenue without an order line -------------------------------------------------

class Unlinked:
    """The claims tables with ids as text, and all revenue of the fourth and later lines under the sentinel."""

    def __init__(self, t: Tables):
        text = F.col("oli_id").cast("string")
        self.bill, self.payment, self.oli = (x.withColumn("oli_id", text) for x in (t.bill, t.payment, t.oli))
        self.revenue = t.revenue.withColumn("oli_id", F.when(F.col("ticket_no") % 10 > 3, rules.NO_ORDER_LINE).otherwise(text))
        self.adjustment_code, self.payor, self.ins_codes = t.adjustment_code, t.payor, t.ins_codes


UNLINKED_IDS = {
    **{v: "cast(oli_id as varchar)" for v in ("bill", "payment", "oli")},
    "revenue": f"case when ticket_no % 10 > 3 then '{rules.NO_ORDER_LINE}' else cast(oli_id as varchar) end"}


def register_unlinked(name: str, like: str, *changes: tuple[str, str]):
    """A query over ``Unlinked``; its SQL is that of ``like`` over the same tables, with the changes given."""
    def wrap(fn):
        register(name)(lambda t: fn(Unlinked(t)))
        text = ORACLE[like]
        for view, ids in UNLINKED_IDS.items():
            own = tables.sql(view)
            text = text.replace(f"{view} as (\n{own}\n)", f"{view} as (\nselect * replace ({ids} as oli_id) from (\n{own}\n))")
        for old, new in changes:
            if old not in text:
                raise ValueError(f"{old} is not in the SQL of {like}")
            text = text.replace(old, new)
        ORACLE[name] = text
        return fn
    return wrap


@register_unlinked("q_revenue_rollup_unlinked", "q_revenue_rollup")
def revenue_rollup_unlinked(t):
    return revenue_sums(t)


# A test that is unknown stays so where there is no order line to ask.
@register_unlinked("q_period_report_unlinked", "q_period_report", (
    "when coalesce(k.test, r.test, o.test) = 'Unknown'",
    f"when coalesce(k.test, r.test, o.test) = 'Unknown' and a.oli_id <> '{rules.NO_ORDER_LINE}'"))
def period_report_unlinked(t):
    return period_report(t)


@register_unlinked("q_journal_v2_unlinked", "q_journal_v2")
def journal_v2_unlinked(t):
    return journal_v2(t)
