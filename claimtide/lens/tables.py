"""Claims tables as views over the driver's Parquet tables.

One SQL text per table serves Spark and the comparison engine, so that both
start from the same rows.  ``{lineitem}`` and the like name the Parquet tables.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

PRICE = "cast(l_extendedprice as decimal(12,2))"
DISCOUNT = "cast(l_discount as decimal(4,2))"
TAX = "cast(l_tax as decimal(4,2))"
MONTH = "cast(date_trunc('month', l_shipdate) as date)"
DAY = "cast(l_shipdate as date)"
# Some rows have no usable order line.
OLI = "case when l_orderkey % 97 <> 0 then l_orderkey end"
TEST_CODE = """case l_partkey % 7 when 0 then 'GL' when 1 then 'GLD' when 2 then 'GLC' when 3 then 'MMR'
  when 4 then 'GLP' when 5 then 'UNK' else 'ARV7' end"""
SUPP = "cast(l_suppkey as varchar(20))"
ADJ = "l_returnflag in ('N', 'R')"

LENS = {
    "bill": f"""
select {OLI} as oli_id, l_orderkey * 10 + l_linenumber as ticket_no, l_partkey as case_no,
  {TEST_CODE} as test, {DAY} as dos, {DAY} as txn_date, {MONTH} as acct_period,
  case when l_orderkey % 5 = 0 then 'EUR' else 'USD' end as currency,
  {PRICE} as txn_amount,
  -({PRICE} * (cast(1 as decimal(4,2)) - {DISCOUNT})) as amt_received,
  -({PRICE} * {DISCOUNT}) as amt_adjusted, {PRICE} * {TAX} as ticket_balance,
  case when l_partkey % 5 = 0 then 'Completed' when l_partkey % 5 = 1 then 'Final Review'
    when l_partkey % 5 = 2 then 'Due from Patient' when l_partkey % 5 = 3 then 'Appeals'
    else 'Claim In Process' end as case_status_sum2,
  case when l_linestatus = 'F' then 'Paid!' else 'Open' end as case_status,
  case when l_returnflag = 'R' then case when l_suppkey % 23 = 0 then 'ROST' else {SUPP} end end as rerouted_plan_vendor,
  case when l_returnflag <> 'A' then {SUPP} end as rerouted_plan_house,
  case when l_suppkey % 9 <> 0 then 'C' || cast(l_suppkey as varchar(20)) end as rerouted_plan_name,
  cast(l_suppkey - l_suppkey % 2 as varchar(20)) as primary_plan_vendor,
  cast(l_suppkey - l_suppkey % 3 as varchar(20)) as primary_plan_house,
  'P' || cast(l_suppkey as varchar(20)) as primary_plan_name,
  {DAY} as init_bill_dt,
  case when l_quantity >= 5 then cast({DAY} + l_linenumber * 9 as date) end as init_payment_dt,
  case when l_quantity >= 10 then cast({DAY} + l_linenumber * 9 + 20 as date) end as last_payment_dt
from {{lineitem}}""",
    "payment": f"""
select {OLI} as oli_id, l_orderkey * 10 + l_linenumber as ticket_no, {TEST_CODE} as test,
  {DAY} as txn_date, {MONTH} as acct_period, l_linenumber as txn_line,
  case when l_orderkey % 5 = 0 then 'EUR' else 'USD' end as currency,
  case when l_returnflag = 'N' then 'AC' when l_returnflag = 'R' then 'AD'
    when l_linestatus = 'F' then 'RI' else 'RP' end as txn_type,
  case when {ADJ} then case l_linenumber when 1 then 'C6' when 2 then 'D4' when 3 then 'PRAC' when 4 then 'NAC'
      when 5 then 'CF' when 6 then case l_suppkey % 10 when 3 then 'NEWC' when 4 then 'NOGR' else 'BAO' end
      else 'CCD' end
    when l_partkey % 4 = 0 then cast(l_suppkey + 1 as varchar(20))
    when l_partkey % 4 <> 1 then cast(l_suppkey - l_suppkey % 2 as varchar(20)) end as vendor_adj_code,
  case when {ADJ} then 'GH0' || cast(l_linenumber as varchar(20)) end as house_adj_code,
  -{PRICE} as txn_amount, {PRICE} * (cast(1 as decimal(4,2)) + {TAX}) as allowed_amt,
  {PRICE} * {DISCOUNT} as deductible_amt, {PRICE} * {TAX} as coins_amt,
  case when l_returnflag = 'R' or l_partkey % 3 = 0 then cast(l_suppkey as varchar(20)) end as ticket_plan_vendor,
  case when l_returnflag = 'R' then cast(l_suppkey as varchar(20)) end as ticket_plan_house,
  cast(l_suppkey - l_suppkey % 2 as varchar(20)) as primary_plan_vendor,
  'H' || cast(l_suppkey as varchar(20)) as primary_plan_house
from {{lineitem}}""",
    "adjustment_code": """
select * from (values ('C6', 'Charge error', 'Charged in Error', 'Charged in Error'),
  ('CCD', 'Charge corrected', 'Charged in Error', 'Charged in Error'),
  ('D4', 'Refund', 'Refund', 'Refund & Refund Reversal'),
  ('CF', 'Refund reversal', 'Refund', 'Refund & Refund Reversal'),
  ('PRAC', 'Assistance', 'Financial Assistance', 'House Adjustment'),
  ('NAC', 'Appeal abandoned', 'Abandoned', 'Revenue Impact Adjustment'),
  ('BAO', 'Contract write-off', 'Contractual', 'Insurance Adjustment'),
  ('NEWC', 'New adjustment', 'New', 'New Group'), ('NOGR', 'Adjustment without a group', 'None', null)
) as t(vendor_adj_code, adj_desc, category_desc, adj_group)""",
    "revenue": f"""
select l_orderkey as oli_id, l_orderkey * 10 + l_linenumber as ticket_no, {MONTH} as period,
  case when l_partkey % 3 <> 0 then {MONTH} end as claim_period,
  {PRICE} * {DISCOUNT} + {PRICE} * {TAX} as total, {PRICE} * {DISCOUNT} as accrual, {PRICE} * {TAX} as cash,
  {PRICE} * {DISCOUNT} + {PRICE} * {TAX} + cast(1 as decimal(4,2)) as total_usd,
  {PRICE} * {DISCOUNT} + cast(0.5 as decimal(4,2)) as accrual_usd,
  {PRICE} * {TAX} + cast(0.5 as decimal(4,2)) as cash_usd,
  case when l_linenumber = 7 then null when l_suppkey % 50 = 0 then 'GBP'
    when l_orderkey % 5 = 0 then 'EUR' else 'USD' end as currency,
  case when l_partkey % 11 = 0 then 'Unknown' when l_partkey % 37 = 0 then 'T9'
    else 'T' || cast(l_orderkey % 7 as varchar(20)) end as test,
  case when l_quantity >= 48 then '1' else '0' end as recon_flag,
  {SUPP} as plan, {DAY} as delivered_dt,
  case when l_linestatus = 'F' then 'Yes' else 'No' end as in_coverage,
  case when l_returnflag = 'A' then 'Accrual' else 'Cash' end as revenue_status,
  'Group ' || cast(l_suppkey % 5 as varchar(20)) || ' (G' || cast(l_suppkey % 5 as varchar(20)) || ')' as tier1_payor,
  'Payor ' || cast(l_suppkey % 25 as varchar(20)) || ' (P' || cast(l_suppkey % 25 as varchar(20)) || ')' as tier2_payor,
  'Plan ' || cast(l_suppkey as varchar(20)) || ' (' || cast(l_suppkey as varchar(20)) || ')' as tier4_payor
from {{lineitem}}""",
    "claim_case": f"""
select case when l_linenumber <= 5 then l_orderkey end as accession, l_partkey as case_no,
  l_orderkey * 10 + l_linenumber as ticket_no, l_shipdate as added_ts
from {{lineitem}}""",
    "oli": """
select o_orderkey as oli_id, o_custkey as order_id,
  case o_orderkey % 5 when 0 then 'IBC' when 1 then 'Prostate' when 2 then 'DCIS' when 3 then 'Colon'
    else 'Unknown' end as test,
  cast(o_orderdate as date) as order_start_dt,
  case when o_orderstatus = 'F' then 1 else 0 end as test_delivered,
  case when o_orderstatus = 'F' and o_orderkey % 7 <> 0 then cast(cast(o_orderdate as date) + 10 as date) end as delivered_dt,
  case when o_orderkey % 6 <> 0 then cast(cast(o_orderdate as date) + 5 as date) end as dos,
  case when o_orderkey % 4 <> 0 then cast(cast(o_orderdate as date) + 6 as date) end as vendor_dos,
  case o_orderstatus when 'F' then 'Closed' when 'O' then 'Submitting' else 'Processing' end as customer_status,
  case when o_orderpriority = '5-LOW' then 'Patient' end as order_cancel_reason,
  case when o_orderpriority = '4-NOT SPECIFIED' or (o_orderkey % 10 = 0 and o_orderpriority = '5-LOW')
    then 'Provider' end as line_cancel_reason,
  case when o_orderkey % 3 = 0 and o_orderstatus <> 'F' then 'Insufficient' end as failure_message,
  c_mktsegment as data_entry_status,
  case when o_orderkey % 5 = 0 then 'EUR' else 'USD' end as billed_currency,
  case when o_orderkey % 4 <> 0 then cast(o_totalprice as decimal(12,2)) end as list_price,
  case when o_custkey % 3 <> 0 then cast(o_totalprice as decimal(12,2)) end as contracted_price,
  case when o_orderkey % 2 = 0 then 'Accrual' else 'Cash' end as revenue_status,
  case when o_orderstatus = 'F' and o_orderkey % 8 <> 0 then o_orderkey * 10 + 1 end as current_ticket_no,
  case when o_orderkey % 5 = 0 then 'Completed' when o_orderkey % 5 = 1 then 'Final Review'
    when o_orderkey % 5 = 2 then null when o_orderkey % 5 = 3 then 'Appeals'
    else 'Claim in Process' end as case_status_sum2,
  case when o_orderkey % 2 = 0 then 'Paid!' else 'Open' end as case_status,
  case when c_nationkey < 15 then 'Domestic' else 'International' end as business_unit,
  c_nationkey as territory,
  cast(o_custkey % 100 as varchar(20)) as plan,
  case when o_orderkey % 9 <> 0 then 'Group ' || cast(o_custkey % 5 as varchar(20)) || ' (G'
    || cast(o_custkey % 5 as varchar(20)) || ')' end as tier1_payor,
  'Group ' || cast(o_custkey % 5 as varchar(20)) as tier1_payor_name, 'G' || cast(o_custkey % 5 as varchar(20)) as tier1_payor_id,
  'Payor ' || cast(o_custkey % 25 as varchar(20)) || ' (P' || cast(o_custkey % 25 as varchar(20)) || ')' as tier2_payor,
  'Payor ' || cast(o_custkey % 25 as varchar(20)) as tier2_payor_name, 'P' || cast(o_custkey % 25 as varchar(20)) as tier2_payor_id,
  'Plan ' || cast(o_custkey % 100 as varchar(20)) || ' (' || cast(o_custkey % 100 as varchar(20)) || ')' as tier4_payor,
  'Plan ' || cast(o_custkey % 100 as varchar(20)) as tier4_payor_name, cast(o_custkey % 100 as varchar(20)) as tier4_payor_id
from {orders} join {customer} on o_custkey = c_custkey""",
    "price": """
select case p_partkey % 5 when 0 then 'IBC' when 1 then 'Prostate' when 2 then 'DCIS' when 3 then 'Colon (old)'
    else 'Unknown' end as test,
  case when p_size % 2 = 0 then 'EUR' else 'USD' end as billed_currency,
  cast(max(p_retailprice) as decimal(12,2)) as std_list_price
from {part} group by p_partkey % 5, p_size % 2""",
    "payor": """
select cast(s_suppkey as varchar(20)) as tier4_payor_id, s_name as tier4_payor_name, n_nationkey as tier2_payor_id,
  n_name as tier2_payor_name, r_regionkey as tier1_payor_id, r_name as tier1_payor_name,
  case when s_suppkey % 6 <> 0 then 'FC' || cast(s_suppkey % 4 as varchar(20)) end as financial_category,
  case when s_acctbal > 0 then 'Medical' else 'Pharmacy' end as line_of_benefit
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "ins_codes": """
select case when s_suppkey % 5 <> 0 then cast(s_suppkey as varchar(20)) else 'X' || cast(s_suppkey as varchar(20)) end
    as tier4_payor_id, 'V' || cast(s_suppkey % 3 as varchar(20)) as vendor_fc
from {supplier}
union all
select cast(s_suppkey - s_suppkey % 12 as varchar(20)), 'V' || cast(s_suppkey % 5 as varchar(20)) from {supplier}""",
    "appeal_case": """
select distinct case when user_id % 10 <> 0 then user_id * 10 + event_id % 3 else -1 - user_id * 10 - event_id % 3 end as case_no,
  user_id * 10 + event_id % 3 + 1 as ticket_no, user_id as accession
from {events}""",
    "appeal": """
select event_id, user_id * 10 + event_id % 3 as appeal_case_no,
  case when event_id % 19 = 0 then null when event_id % 23 = 0 then 'B7' else case event_type when 'view' then 'A1'
    when 'click' then 'A2' when 'signup' then 'A3' when 'error' then 'ER' else 'L1' end end as level_code,
  cast(event_id % 4 as varchar(20)) as appeal_status, 'Status ' || cast(event_id % 4 as varchar(20)) as appeal_status_desc,
  cast(ts as date) as denial_dt, case when event_id % 11 <> 0 then cast(ts as date) end as entry_dt,
  case when event_id % 4 <> 0 then cast(cast(ts as date) + 7 as date) end as report_dt,
  regexp_extract(props, '[0-9]+', 0) as ins_code,
  case when event_id % 13 <> 0 then cast(event_id % 9 as varchar(20)) end as den_reason,
  case when event_id % 13 <> 0 then 'Reason ' || cast(event_id % 9 as varchar(20)) end as den_reason_desc,
  case when event_id % 17 = 0 then 'uhclnp' else 'STD' end as campaign_code
from {events}""",
    "complete_appeal": """
select case when user_id % 3 <> 0 and event_type = 'purchase' then user_id * 10 + event_id % 3
    else -1 - user_id * 10 - event_id % 3 end as appeal_case_no, user_id * 10 + event_id % 3 + 1 as appeal_ticket_no,
  user_id as accession, case when min(event_id) % 2 = 0 then '1' else '0' end as appeal_success,
  case when min(event_id) % 5 <> 0 then cast(min(event_id) % 7 as varchar(20)) end as appeal_den_reason,
  case when min(event_id) % 5 <> 0 then 'Final ' || cast(min(event_id) % 7 as varchar(20)) end as appeal_den_reason_desc,
  'V' || cast(min(event_id) % 8 as varchar(20)) as appeal_ins_code,
  cast(-sum(cast(value as decimal(12,2))) as decimal(18,2)) as appeal_amt_applied
from {events} group by user_id, event_id % 3, event_type""",
    "worklist": """
select event_id, user_id as ticket_no, case when event_type = 'error' then 'HS7X' else 'ZZ1' end as worklist_code,
  case when event_id % 5 = 0 then '  ' when event_id % 7 = 0 then null
    else ' W' || cast(event_id % 4 as varchar(20)) || ' ' end as condition
from {events}""",
    "condition_code": """
select * from (values ('HS7X', 'W0', 'Not covered'), ('HS7X', 'W1', 'No authorisation'),
  ('HS7X', 'W2', 'Too late')) as t(worklist_code, condition, condition_desc)""",
    "policy": """
select 'P' || cast(p_partkey as varchar(20)) as name, p_partkey as tier4_payor_id,
  case when p_partkey % 2 = 0 then 'MP' else 'CT' end as policy,
  case when p_size % 3 = 0 then 'Draft' else 'Active' end as policy_status,
  case when p_partkey % 3 = 0 then 'Prostate' else 'IBC' end as test,
  case when p_size % 10 = 0 then null else p_brand || ';' || 'Brand#' || cast(p_partkey % 25 + 1 as varchar(20)) end as brand_field,
  case when p_size % 10 = 0 or p_size % 7 = 0 then null else p_type || ';PROMO' end as type_field
from {part}""",
    "criteria_enum": """
select distinct 'IBC' as test, 'brand_field' as field, 'Brand' as label, p_brand as value from {part}
union all select distinct 'IBC', 'type_field', 'Type', p_type from {part}
union all select distinct 'Prostate', 'type_field', 'Type', p_type from {part}
union all select distinct 'DCIS', 'type_field', 'Type', p_type from {part}
union all select distinct cast(null as varchar(20)), 'type_field', 'Type', p_type from {part}
union all select 'IBC', 'absent_field', 'Absent', 'x'""",
    "pa_enum": """
select 'prior_authorization' as field, r as value from (values ('No CVP (no PA)'), ('Pre-DOS'), ('Post-DOS'), ('SOMN'),
  ('Lab initiates PA'), ('Online or Telephonic'), ('New requirement'), (null)) as t(r)
union all select 'other_field', 'Not for this field'""",
    "validation": """
select 'V' || cast(p_partkey as varchar(20)) as name,
  case when p_partkey % 5 <> 0 then p_partkey else -p_partkey - 1 end as tier4_payor_id,
  case when p_partkey % 3 = 0 then 'Prostate' else 'IBC' end as test,
  case when p_size % 10 = 0 then '' when p_size % 4 = 0 then 'Pre-DOS;SOMN' when p_size % 4 = 1 then 'Post-DOS'
    when p_size % 4 = 2 then 'Lab initiates PA;Online or Telephonic;SOMN' else 'No CVP (no PA)' end as prior_authorization,
  p_size % 2 as pa_required
from {part}""",
    "patient": """
select l_orderkey as oli_id, l_linenumber as line_no, l_suppkey as tier4_payor_id,
  case when l_partkey % 3 = 0 then 'Prostate' else 'IBC' end as test,
  case when l_quantity < 3 then 'Unknown' when l_quantity < 4 then null else p_type end as patient_type,
  case when l_quantity > 45 then null else p_brand end as patient_brand,
  case when l_linenumber = 1 then 'Yes' else 'No' end as multiple_primaries,
  case when l_suppkey % 7 = 0 then 'Failure' when l_suppkey % 7 = 1 then 'PA Denied'
    when l_suppkey % 7 = 2 then null else 'Non Failure' end as pre_claim_failure
from {lineitem} join {part} on l_partkey = p_partkey""",
    "clinical": """
select l_orderkey as oli_id, l_partkey, l_suppkey, l_linenumber as line_no,
  case when l_quantity = 1 then null else cast(l_tax as decimal(4,2)) * 70 end as tumour_size_cm,
  case when l_quantity >= 3 then l_quantity * 2 end as patient_age,
  case when l_quantity >= 2 then l_quantity * 25 end as specimen_age,
  case when l_quantity <> 7 then l_quantity end as psa,
  case l_linenumber when 1 then '' when 2 then '4+3' when 3 then '3+3' when 4 then '3+4'
    when 5 then '3+3' when 6 then '5+5' else null end as gleason,
  case l_returnflag when 'A' then '' when 'N' then 'T1c' else 'T3' end as stage,
  case when l_partkey % 4 = 0 then 'High Risk' else 'Intermediate Risk' end as submitted_risk,
  case when l_partkey % 5 = 0 then 'IBC' else 'Prostate' end as test,
  case when l_linestatus = 'F' then 'Group F' else 'Node Positive (Micromet)' end as reporting_group,
  cast(date '2017-06-01' + cast(l_quantity as int) - 10 as date) as delivered_dt,
  case l_partkey % 6 when 0 then 'Intermediate favorable' when 1 then 'INTERMEDIATE UNFAVORABLE'
    when 2 then 'Indeterminate' end as revised_risk,
  case l_returnflag when 'A' then 'Node Negative' when 'N' then 'Micromets (pN1mi: 0.2 - 2.0mm)'
    else 'Node Positive' end as nodal_status,
  case when l_linestatus = 'F' then 'Non-Biopsy' else 'Biopsy' end as procedure_type,
  case when l_returnflag = 'A' then 'Positive' else 'Negative' end as submitted_er,
  case when l_linestatus = 'F' then 'PR Positive' end as submitted_pr,
  case l_linenumber when 1 then 1 when 2 then null else 0 end as multiple_primaries,
  case l_suppkey % 4 when 0 then 'Oncologist' when 1 then 'Radiation Oncologist' when 2 then 'Surgeon' end as specialty
from {lineitem}""",
    "raw_order_line": """
select o_orderkey as oli_id, case when o_orderkey % 3 = 0 then 'Prostate-AR-V7' else 'IBC' end as test,
  case when o_orderkey % 4 = 0 then '0.0' when o_orderkey % 9 = 0 then null when o_orderkey % 31 = 0 then 'n/a'
    else cast(cast(o_totalprice as decimal(12,2)) as varchar(20)) end as billed_amount,
  case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then 'nan'
    else cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as varchar(20)) || '.0' end as delivered_dt,
  case when o_orderkey % 11 = 0 then '20179999'
    else cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as varchar(20)) end as order_start_dt,
  case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then cast(0 as double)
    else cast(o_orderkey * 10 + 1 as double) end as current_ticket_no,
  c_name as tier4_payor_name, case when o_custkey % 6 <> 0 then cast(o_custkey as varchar(20)) end as tier4_payor_id,
  case when o_orderkey % 2 = 0 then c_mktsegment end as risk_group, case when o_orderkey % 2 = 1 then '3+3' end as gleason,
  case when o_custkey % 4 = 0 then 'Node Positive (Micromet)' else 'Group' end as reporting_group,
  case when o_custkey % 8 <> 0 then 'Micromets' end as nodal_status
from {orders} join {customer} on o_custkey = c_custkey""",
    "raw_revenue": f"""
select case when l_orderkey % 97 <> 0 then l_orderkey end as oli_id,
  case when l_linenumber = 6 then null when l_linenumber = 5 then cast(0 as double)
    else cast(l_orderkey * 10 + l_linenumber as double) end as ticket_no,
  cast({DAY} as varchar(20)) as period, case when l_partkey % 3 <> 0 then cast({DAY} as varchar(20)) || ' 00:00:00'
    when l_partkey % 5 = 0 then '2017-1' end as claim_period,
  {PRICE} as total, 'Plan ' || {SUPP} as tier4_payor_name, {SUPP} as tier4_payor_id
from {{lineitem}}""",
    "raw_case": f"""
select l_orderkey as accession, cast(l_partkey as double) as case_no, cast(l_orderkey * 10 + l_linenumber as double) as ticket_no,
  cast(year(l_shipdate) * 100 + month(l_shipdate) as double) as entry_month,
  case when l_linenumber = 3 then null when l_linenumber = 4 then 'none'
    else cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as varchar(20)) end as update_dt,
  cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as varchar(20)) as added_date,
  case when l_quantity < 10 then '07:08:09' when l_quantity < 12 then 'late' else '23:59:59' end as added_time
from {{lineitem}}""",
    "raw_appeal": """
select user_id * 10 + event_id % 3 as case_number, case event_type when 'view' then 'A1' when 'click' then 'A2' else 'L1' end as level,
  cast(event_id % 4 as varchar(20)) as status, 'Status ' || cast(event_id % 4 as varchar(20)) as status_desc,
  case when event_id % 11 = 0 then null when event_id % 13 = 0 then '20179999' when event_id % 17 = 0 then ' '
    else cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as varchar(20)) end as entry_date,
  cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as varchar(20)) as denial_letter_date,
  case event_id % 5 when 0 then null when 1 then '000' when 2 then '0450' else '45' end as denial_reason,
  regexp_extract(props, '[0-9]+', 0) as insurer_code, 'not in the contract' as remark
from {events}""",
    "raw_complete_appeal": """
select user_id * 10 + event_id % 3 + 1 as ticket_number, user_id * 10 + event_id % 3 as case_number, user_id as accession,
  case event_id % 8 when 0 then 'GL' when 1 then 'GLD' when 2 then 'GLC' when 3 then 'MMR' when 4 then 'GLP' when 5 then 'ARV7'
    when 6 then 'New test' end as test_code,
  cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as varchar(20)) as service_date,
  case when event_id % 7 <> 0 then cast(event_id % 40 as varchar(20)) || '.0' when event_id % 2 = 0 then 'n/a' end as denial_reason,
  cast(cast(value as decimal(12,2)) as varchar(20)) as amount_charged,
  case when event_id % 9 <> 0 then cast(-cast(value as decimal(12,2)) as varchar(20)) else 'none' end as amount_applied,
  cast(event_id % 2 as double) as success, case when event_id % 3 <> 0 then 'USD' end as currency
from {events}""",
    "raw_prior_auth": """
select p_partkey as case_number, case when p_size % 5 = 0 then '2017-01-01' else '201701' || cast(10 + p_size % 20 as varchar(20)) end
    as entered_date, case when p_size % 4 = 0 then 'Denied' else 'Approved' end as result, p_name as request,
  'A' || cast(p_partkey as varchar(20)) as number
from {part}""",
    "view_set": """
select * from (values ('set_region', 1), ('set_region', 3), ('set_nation', 2), ('set_nation', 5),
  ('set_nation', 7), ('set_west', 4), ('set_west', 5)) as t(set_name, payor_id)""",
    "prior_auth": """
select case when p_partkey % 3 <> 0 then p_partkey else -p_partkey - 1 end as prior_auth_case_no, case when p_size % 4 = 0 then 'Denied' else 'Approved' end as prior_auth_result,
  case when p_size % 4 = 0 then 'Closed' else 'Open' end as prior_auth_category,
  'A' || cast(p_partkey as varchar(20)) as prior_auth_number,
  case when p_size % 4 = 0 then 'Failure' when p_size % 4 = 1 then 'PA Denied' else 'Non Failure' end as pre_claim_failure
from {part}""",
    "specimen": """
select case when o_orderkey % 2 = 0 then o_orderkey else -o_orderkey - 1 end as oli_id,
  case when o_custkey % 2 = 0 then 'Biopsy' else 'Non-Biopsy' end as procedure_type,
  o_custkey % 1200 as specimen_age, case when o_orderkey % 4 = 0 then 'Yes' else 'No' end as adjuvant_chemo_candidate
from {orders}""",
    "somn": """
select case when o_orderkey % 3 = 1 then o_orderkey else -o_orderkey - 1 end as oli_id,
  case when o_custkey % 2 = 0 then 'Signed' else 'Sent' end as somn_status
from {orders}""",
    "extract_case": """
select case when user_id % 2 = 0 then user_id else -user_id - 1 end as order_id, event_id % 10 as owner_id, event_id as case_id,
  case event_type when 'error' then 'Missing Data' when 'purchase' then 'Pre-Billing' else 'Other' end as case_type
from {events}""",
}

# Multi-select criteria of payors' policies, IBC and Prostate: field, longer and shorter selection.
CRITERIA = (
    ("age_at_diagnosis", ">= 50;< 50", ">= 50"), ("node_status", "Node Negative (pN0);Micromets (pN1mi: 0.2 2.0mm)", "Node Positive"),
    ("er_status", "Positive;Negative", "Positive"), ("pr_status", "PR Positive;PR Negative", "PR Negative"),
    ("hormone_receptor", "ER Positive and PR Positive (HR positive);Other", "Other"), ("her2_status", "Negative;Positive", "Negative"),
    ("procedure_type", "Biopsy;Non Biopsy;Non-Biopsy", "Biopsy"), ("med_onc_order", "Med Onc Order;Non-Med Onc Order", "Med Onc Order"),
    ("multi_tumour", "Yes;No", "No"), ("age_of_biopsy", "Less than 6 months;6-36 months", "6-36 months"),
    ("risk_category", "Intermediate Favorable;Intermediate Unfavorable;Very Low", "Very Low"), ("gleason_score", "3+3;3+4", "3+3"),
    ("clinical_stage", "T1c;T2a", "T1c"), ("tumour_involvement", "less than 50%;Greater than or Equal to 50%", "less than 50%"),
    ("ctr", "Yes;No", "No"), ("recent_diagnosis", "Yes", "No"), ("prior_assay", "Yes", "No"), ("patient_gender", "Female", "Male"),
    ("stage", "I;II", "I"), ("her2_mode", "FISH", "IHC"), ("tumour_size", "Size > 5.0 cm", "Unknown"), ("tumour_histology", "Ductal", "Lobular"),
    ("post_menopausal", "Yes", "No"), ("distant_metastasis", "Yes", "No"), ("multi_tumour_execution", "Yes", "No"),
    ("life_expectancy", "10 years", "20 years"))


def _selected(at: int, field: str, longer: str, shorter: str) -> str:
    """A selection for most payors, nothing for every 13th; blanks as NULL and as empty text."""
    return (f"case when p_partkey % 13 = 0 or (p_partkey + p_size) % {at % 3 + 4} = 0 then null when (p_partkey + {at}) % 7 = 0 then '' "
            f"when (p_partkey + {at}) % 3 <> 0 then '{longer}' else '{shorter}' end as {field}")


LENS["payor_policy"] = " union all ".join(f"""
select '{kind} {test} ' || cast(p_partkey as varchar(20)) as name, case when p_partkey % 17 <> 0 then p_partkey end as tier4_payor_id,
  '{kind}' as policy, case when p_size % 3 = 0 then 'Draft' else 'Active' end as policy_status, '{test}' as test,
  {', '.join(_selected(i, *c) for i, c in enumerate(CRITERIA))}
from {{part}} where p_partkey % {without} <> 0""" for test, kind, without in (
    ("IBC", "MP", 7), ("IBC", "CT", 3), ("Prostate", "MP", 11), ("Prostate", "CT", 5)))
LENS["order_risk"] = f"""
select l_orderkey as oli_id, l_linenumber as line_no, l_orderkey - l_orderkey % 4 as order_id,
  case when l_partkey % 9 = 0 then 'DCIS' when l_partkey % 2 = 0 then 'Prostate' else 'IBC' end as test,
  case when l_orderkey % 8 <> 0 then l_orderkey * 10 + l_linenumber end as current_ticket_no,
  case when l_orderkey % 29 <> 0 then {DAY} end as order_start_dt, cast({DAY} + 10 as date) as delivered_dt,
  cast(l_suppkey % 5 as int) as tier1_payor_id, cast(l_suppkey % 25 as int) as tier2_payor_id,
  case when l_suppkey % 19 <> 0 then l_suppkey end as tier4_payor_id, 'Plan ' || {SUPP} as tier4_payor_name,
  'FC' || cast(l_suppkey % 4 as varchar(20)) as financial_category,
  cast(l_tax as decimal(4,2)) * 70 as tumour_size_cm, case when l_partkey % 11 <> 0 then l_partkey % 100 end as patient_age,
  case when l_partkey % 10 <> 0 then l_partkey % 1200 - 30 end as specimen_age,
  case l_linenumber when 1 then '' when 2 then '4+3' when 3 then '3+3' when 4 then '3+4' when 5 then 'Unknown' when 6 then '3+3' end as gleason,
  case l_returnflag when 'A' then '' when 'N' then 'T1c' else 'T2a' end as stage,
  case l_partkey % 6 when 0 then 'Favorable Intermediate' when 2 then 'Unfavorable Intermediate' when 4 then 'Very Low' end as submitted_risk,
  case l_returnflag when 'A' then 'Node Negative' when 'N' then 'Micromets (pN1mi: 0.2 - 2.0mm)' else 'Node Positive' end as nodal_status,
  case when l_partkey % 4 = 0 then null when l_linestatus = 'F' then 'Non-Biopsy' else 'Biopsy' end as procedure_type,
  case when l_returnflag = 'A' then 'Positive' when l_returnflag = 'N' then 'Negative' end as submitted_er,
  case when l_linestatus = 'F' then 'PR Positive' when l_linenumber = 3 then 'Unknown' else 'PR Negative' end as submitted_pr,
  case when l_partkey % 3 = 0 then 'Negative' when l_partkey % 3 = 1 then 'Positive' end as submitted_her2,
  case l_linenumber when 1 then 1 when 2 then null else 0 end as multiple_primaries,
  case l_suppkey % 4 when 0 then 'Oncologist' when 1 then 'Radiation Oncologist' when 2 then 'Surgeon' end as specialty,
  case l_partkey % 3 when 0 then 1 when 1 then 0 end as is_hcp_ctr,
  case l_partkey % 5 when 0 then '> 50%' when 1 then '≤ 50%' when 2 then 'Unknown' end as max_tumour_involvement,
  case l_suppkey % 7 when 0 then 'Failure' when 1 then 'PA Denied' when 2 then null else 'Non Failure' end as pre_claim_failure
from {{lineitem}}"""

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def base_tables(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", LENS[name])))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A claims table over the Parquet tables of ``sf_dir``."""
    inputs = {b: base(spark, sf_dir, b) for b in base_tables(name)}
    return spark.sql(LENS[name], **inputs) if inputs else spark.sql(LENS[name])


@lru_cache
def sql(name: str) -> str:
    """The same table as plain SQL over the tables' own names."""
    text = LENS[name]
    for b in base_tables(name):
        text = text.replace("{" + b + "}", b)
    return text.strip()
