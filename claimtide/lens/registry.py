"""Registration of queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.lens import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Claims tables and base tables of one data folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    def base(self, name: str) -> DataFrame:
        return tables.base(self.spark, self.sf_dir, name)


def as_double(df: DataFrame) -> DataFrame:
    """Exact decimals to doubles, once, at the very end."""
    return df.select(*[F.col(f"`{n}`").cast("double").alias(n) if t.startswith("decimal") else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def with_tables(views: str, body: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{v} as (\n{tables.sql(v)}\n)" for v in views.split()]
    parts += [f"{n} as (\n{q.strip()}\n)" for n, q in (extra or {}).items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def register(name: str, views: str = "", body: str | None = None, **extra: str):
    """Register a query; ``views`` names the claims tables its SQL starts from."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: as_double(fn(Tables(spark, sf_dir)))
        if body is not None:
            ORACLE[name] = with_tables(views, body, extra)
        return fn

    return wrap


def doubles(*names: str, source: str = "") -> str:
    p = f"{source}." if source else ""
    return ", ".join(f"cast({p}{n} as double) as {n}" for n in names)


# SQL of intermediate tables, written independently of the operators ---------

LABEL = """case test when 'GL' then 'IBC' when 'GLD' then 'DCIS' when 'GLC' then 'Colon' when 'MMR' then 'MMR'
  when 'GLP' then 'Prostate' when 'UNK' then 'Unknown' when 'ARV7' then 'Prostate-AR-V7' else test end"""

BILL_STD = f"""
select b.* replace ({LABEL} as test, case when case_status_sum2 = 'Claim In Process' then 'Claim in Process'
    else case_status_sum2 end as case_status_sum2),
  cast(init_payment_dt - init_bill_dt as integer) as days_to_init_payment,
  cast(last_payment_dt - init_bill_dt as integer) as days_to_last_payment,
  case when rerouted_plan_vendor is null then primary_plan_vendor
    when rerouted_plan_vendor = 'ROST' then rerouted_plan_house else rerouted_plan_vendor end as ticket_plan_vendor,
  case when rerouted_plan_vendor is null then primary_plan_house else rerouted_plan_house end as ticket_plan_house,
  case when rerouted_plan_vendor is null then primary_plan_name else rerouted_plan_name end as ticket_plan_name
from bill b"""

PAY_STD = f"""
select p.oli_id, p.ticket_no, {LABEL.replace('test', 'p.test')} as test, p.txn_date, p.acct_period, p.txn_line, p.currency,
  p.txn_type, p.txn_amount, p.allowed_amt, p.deductible_amt, p.coins_amt,
  p.primary_plan_vendor, p.primary_plan_house,
  case when p.ticket_plan_vendor is null then p.primary_plan_house else p.ticket_plan_house end as ticket_plan_house,
  p.ticket_plan_vendor,
  case when p.txn_type in ('RI', 'RP') then p.vendor_adj_code end as payment_plan_vendor,
  case when p.txn_type in ('RI', 'RP') then '' else p.vendor_adj_code end as vendor_adj_code,
  case when p.txn_type in ('RI', 'RP') then '' when p.vendor_adj_code = 'PRAC' then 'GH07'
    when p.vendor_adj_code = 'BAO' then 'GH13' else p.house_adj_code end as house_adj_code,
  case when p.txn_type = 'RI' then case when p.ticket_plan_vendor <> p.vendor_adj_code then 0 else 1 end end
    as is_primary_payment,
  a.adj_desc, a.category_desc, a.adj_group
from payment p left join adjustment_code a
  on p.vendor_adj_code = a.vendor_adj_code and p.txn_type in ('AC', 'AD')"""

PAY_SIGNED = """
select * replace (case when txn_type in ('RI', 'RP') or vendor_adj_code not in ('C6', 'CCD') then -txn_amount
    else txn_amount end as txn_amount)
from pay_std"""

GROUPS = {
    "grp_all_other_adjustment": "All other Adjustment",
    "grp_charged_in_error": "Charged in Error",
    "grp_house_adjustment": "House Adjustment",
    "grp_insurance_adjustment": "Insurance Adjustment",
    "grp_refund_refund_reversal": "Refund & Refund Reversal",
    "grp_revenue_impact_adjustment": "Revenue Impact Adjustment",
}
GROUP_SUMS = ",\n  ".join(
    f"sum(txn_amount) filter (where txn_type in ('AC', 'AD') and adj_group = '{g}') as {n}" for n, g in GROUPS.items())

RECEIPT = f"""
select coalesce(b.oli_id, p.oli_id) as oli_id,
  {', '.join(f'coalesce({c}, 0) as {c}' for c in ['charge', 'received', 'claim_adjusted', 'outstanding', 'payor_paid',
                                                  'patient_paid', 'adjusted', *GROUPS])},
  coalesce(charge, 0) + coalesce(grp_charged_in_error, 0) as total_billed,
  coalesce(received, 0) + coalesce(grp_refund_refund_reversal, 0) as total_payment,
  coalesce(adjusted, 0) - coalesce(grp_charged_in_error, 0) - coalesce(grp_refund_refund_reversal, 0) as total_adjustment
from (select oli_id, sum(txn_amount) as charge, sum(-amt_received) as received, sum(-amt_adjusted) as claim_adjusted,
    sum(ticket_balance) as outstanding from bill where oli_id is not null group by oli_id) b
full join (select oli_id, sum(txn_amount) filter (where txn_type = 'RI') as payor_paid,
    sum(txn_amount) filter (where txn_type = 'RP') as patient_paid,
    sum(txn_amount) filter (where txn_type in ('AC', 'AD')) as adjusted,
  {GROUP_SUMS}
  from pay_signed where oli_id is not null group by oli_id) p on b.oli_id = p.oli_id"""
RECEIPT_AMOUNTS = ["charge", "received", "claim_adjusted", "outstanding", "payor_paid", "patient_paid", "adjusted",
                   *GROUPS, "total_billed", "total_payment", "total_adjustment"]

TICKET_PAYLOAD = ["case_no", "case_status_sum2", "case_status", "ticket_plan_vendor", "ticket_plan_house",
                  "primary_plan_vendor", "primary_plan_house", "dos", "txn_date", "days_to_init_payment",
                  "days_to_last_payment"]
CURRENT_TICKET = f"""
select oli_id, ticket_no, {', '.join(TICKET_PAYLOAD)}, ticket_cnt from (
  select *, count(*) over (partition by oli_id) as ticket_cnt,
    row_number() over (partition by oli_id order by txn_date desc nulls last, ticket_no desc) as rn2
  from (select *, row_number() over (partition by oli_id, ticket_no order by
      {', '.join(c + ' desc nulls last' for c in TICKET_PAYLOAD)}) as rn
    from bill_std where oli_id is not null)
  where rn = 1) where rn2 = 1"""
CURRENT_CASE = """
select oli_id, case_no as max_case_no, case_cnt from (
  select accession as oli_id, case_no, count(distinct case_no) over (partition by accession) as case_cnt,
    row_number() over (partition by accession order by added_ts desc, case_no desc) as rn
  from claim_case where accession is not null) where rn = 1"""
CURRENT_REFERENCE = """
select c.oli_id, case_cnt, ticket_no as current_ticket_no, case_status_sum2, case_status, ticket_plan_vendor,
  ticket_plan_house, primary_plan_vendor, primary_plan_house, dos as vendor_dos, txn_date as claim_entry_dt,
  days_to_init_payment, days_to_last_payment, ticket_cnt, coalesce(t.case_no, c.max_case_no) as current_case_no
from current_case c left join current_ticket t on c.oli_id = t.oli_id"""
HIERARCHY = """
select tier1_payor_name || ' (' || tier1_payor_id || ')' as tier1_payor, tier1_payor_name, tier1_payor_id,
  tier2_payor_name || ' (' || tier2_payor_id || ')' as tier2_payor, tier2_payor_name, tier2_payor_id,
  tier4_payor_name || ' (' || p.tier4_payor_id || ')' as tier4_payor, tier4_payor_name, p.tier4_payor_id,
  coalesce(financial_category, vendor_fc) as financial_category, line_of_benefit
from payor p left join (select tier4_payor_id, max(vendor_fc) as vendor_fc from ins_codes group by tier4_payor_id) i
  on p.tier4_payor_id = i.tier4_payor_id"""
REVENUE_AMOUNTS = ["total_revenue", "accrual_revenue", "cash_revenue", "total_usd_revenue", "accrual_usd_revenue",
                   "cash_usd_revenue"]
REVENUE_ROLLUP = """
select s.*, l.currency from (
  select oli_id, sum(total) as total_revenue, sum(accrual) as accrual_revenue, sum(cash) as cash_revenue,
    sum(total_usd) as total_usd_revenue, sum(accrual_usd) as accrual_usd_revenue, sum(cash_usd) as cash_usd_revenue,
    count(period) as period_cnt, min(period) as period_init, max(period) as period_last
  from revenue where recon_flag = '0' group by oli_id) s
join (select oli_id, currency, row_number() over (partition by oli_id order by period desc nulls last,
    currency desc nulls last) as rn from revenue where recon_flag = '0') l on s.oli_id = l.oli_id and l.rn = 1"""
JOURNAL_CASE = """
select a.* replace (case when a.campaign_code = 'uhclnp' then 'UHCLNP' else a.campaign_code end as campaign_code),
  c.ticket_no as appeal_ticket_no, c.accession
from appeal a join appeal_case c on a.appeal_case_no = c.case_no"""
