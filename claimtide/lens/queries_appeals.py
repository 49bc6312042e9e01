"""Registered queries: appeals, payor headers, view sets, policies, clinical values."""

from pyspark.sql import functions as F

from claimtide import rules
from claimtide.lens.queries_claims import hierarchy
from claimtide.lens.registry import HIERARCHY, JOURNAL_CASE, Tables, register
from claimtide.operators import appeals, policy, risk, standardise, status, views
from claimtide.operators.reference import attach_payor_hierarchies
from claimtide.sources import order_case_extract

ORDER = ("entry_dt", "denial_dt", "report_dt", "event_id")
VIEWS = "appeal appeal_case complete_appeal"
FIELDS = appeals.LEVEL_FIELDS
RANK = "entry_dt nulls last, denial_dt nulls last, report_dt nulls last, event_id"
DENIAL_PAYLOAD = ["appeal_case_no", "appeal_ticket_no", "ins_code", "level_code", "den_reason", "den_reason_desc",
                  "entry_dt", "denial_dt", "campaign_code"]
DENIAL_RANK = "denial_dt desc nulls last, entry_dt desc nulls last, event_id desc"

COMPLETE = "select * replace (-appeal_amt_applied as appeal_amt_applied) from complete_appeal"
LAST_DENIAL = f"""
select accession, appeal_case_no, appeal_ticket_no, ins_code as last_ins_code, level_code as last_level,
  den_reason as last_den_reason, den_reason_desc as last_den_reason_desc, entry_dt as last_entry_dt,
  denial_dt as last_denial_dt, campaign_code, oli_level_cnt, first_entry_dt
from (select *, count(*) over (partition by accession) as oli_level_cnt,
    min(entry_dt) over (partition by accession) as first_entry_dt,
    row_number() over (partition by accession order by {DENIAL_RANK}) as rn from journal) where rn = 1"""


def _first_sql(level: str, name: str, source: str) -> str:
    return (f"first({source} order by {RANK}) filter (where level_code = '{level}' and {source} is not null) "
            f"as {level.lower()}_{name}")


LEVELS_WIDE = "select appeal_case_no, appeal_ticket_no, count(*) as case_level_cnt,\n  " + ",\n  ".join(
    _first_sql(lv, n, s) for lv in rules.APPEAL_LEVELS for n, s in FIELDS.items()) + (
    "\nfrom journal where appeal_case_no is not null and appeal_ticket_no is not null group by all")
WIDE_NAMES = [f"{lv.lower()}_{n}" for n in FIELDS for lv in rules.APPEAL_LEVELS]
APPEAL_WIDE = f"""
select w.*, c.accession, d.last_level, d.last_den_reason, d.last_den_reason_desc, d.last_entry_dt, d.last_ins_code,
  d.last_denial_dt, d.first_entry_dt, d.campaign_code, d.oli_level_cnt, f.appeal_success,
  cast(f.appeal_amt_applied as double) as appeal_amt_applied,
  case when f.appeal_den_reason_desc is null then d.last_den_reason else f.appeal_den_reason end as appeal_den_reason,
  coalesce(f.appeal_den_reason_desc, d.last_den_reason_desc) as appeal_den_reason_desc,
  case when f.appeal_den_reason_desc is null then d.last_ins_code else f.appeal_ins_code end as appeal_ins_code
from levels_wide w
left join appeal_case c on w.appeal_case_no = c.case_no and w.appeal_ticket_no = c.ticket_no
left join last_denial d on c.accession = d.accession
left join complete f on w.appeal_case_no = f.appeal_case_no and w.appeal_ticket_no = f.appeal_ticket_no
  and c.accession = f.accession"""
WIDE = {"complete": COMPLETE, "journal": JOURNAL_CASE, "last_denial": LAST_DENIAL, "levels_wide": LEVELS_WIDE,
        "appeal_wide": APPEAL_WIDE}


def journal(t: Tables):
    return appeals.attach_case(appeals.fix_campaign_code(t.appeal), t.appeal_case)


def denial(t: Tables):
    return appeals.last_denial(journal(t), ("denial_dt", "entry_dt", "event_id"))


def wide(t: Tables):
    return appeals.appeal_wide(journal(t), t.appeal_case, appeals.prepare_complete(t.complete_appeal), order=ORDER,
                               denial_order=("denial_dt", "entry_dt", "event_id"))


@register("q_appeal_counts", VIEWS, """
select j.event_id, j.accession, j.appeal_case_no, j.appeal_ticket_no, j.level_code, j.campaign_code, f.appeal_success,
  count(*) over (partition by j.appeal_case_no, j.appeal_ticket_no) as case_level_cnt,
  count(*) over (partition by j.accession) as oli_level_cnt
from journal j left join complete_appeal f on j.appeal_case_no = f.appeal_case_no
  and j.appeal_ticket_no = f.appeal_ticket_no and j.accession = f.accession""", journal=JOURNAL_CASE)
def appeal_counts(t):
    out = appeals.appeal_journal(journal(t), t.complete_appeal)
    return out.select("event_id", "accession", "appeal_case_no", "appeal_ticket_no", "level_code", "campaign_code",
                      "appeal_success", "case_level_cnt", "oli_level_cnt")


@register("q_appeal_levels", VIEWS, "select * from levels_wide", journal=JOURNAL_CASE, levels_wide=LEVELS_WIDE)
def appeal_levels(t):
    return appeals.levels_wide(journal(t), order=ORDER)


@register("q_appeal_wide", VIEWS, "select * from appeal_wide", **WIDE)
def appeal_wide(t):
    return wide(t)


@register("q_last_denial", VIEWS, "select * from last_denial", journal=JOURNAL_CASE, last_denial=LAST_DENIAL)
def last_denial(t):
    return denial(t)


@register("q_first_entry", VIEWS, """
select accession, min(entry_dt) as first_entry_dt from journal where accession is not null group by accession""",
          journal=JOURNAL_CASE)
def first_entry(t):
    return appeals.first_entry(journal(t))


@register("q_appeal_result", VIEWS + " oli", """
select oli_id, appeal_case_no, appeal_success, appeal_den_reason,
  case when appeal_success = '1' then 'Success' when appeal_success = '0' then 'Failed'
    when appeal_den_reason is null then null when done then 'Removed' else 'In Process' end as appeal_result,
  case when appeal_den_reason is null then 0 else 1 end as is_appeal,
  case when appeal_success = '1' then 1 else 0 end as succeeded, case when appeal_success = '0' then 1 else 0 end as failed,
  case when appeal_success is null then 0 else 1 end as completed_appeal,
  case when appeal_success is null and appeal_den_reason is not null and not done then 1 else 0 end as in_process,
  case when appeal_success is null and appeal_den_reason is not null and done then 1 else 0 end as removed,
  case when appeal_success is null and appeal_den_reason is not null and not done then 'Appeals'
    when appeal_success is not null and not done then 'Final Review'
    when appeal_success is null and appeal_den_reason is null and case_status_sum2 = 'Appeals' then 'Claim in Process'
    else case_status_sum2 end as case_status_sum2,
  case when appeal_success is not null and not done then 'Final Review' else case_status end as case_status
from (select o.*, w.appeal_case_no, w.appeal_success, w.appeal_den_reason,
    coalesce(o.case_status_sum2 in ('Completed', 'Final Review', 'Due from Patient'), false) as done
  from oli o left join appeal_wide w on o.oli_id = w.accession)""", **WIDE)
def appeal_result(t):
    outcome = wide(t).select("accession", "appeal_case_no", "appeal_success", "appeal_den_reason")
    lines = t.oli.select("oli_id", "case_status_sum2", "case_status")
    return status.appeal_result(lines.join(outcome, lines.oli_id == outcome.accession, "left").drop("accession"))


@register("q_appeal_result_journal", VIEWS + " oli", """
select event_id, oli_id, current_is_appealed_raw as current_is_appealed,
  case when appeal_success = '1' then 'Success' when appeal_success = '0' then 'Failed'
    when case_status_sum2 in ('Completed', 'Final Review', 'Due from Patient') then 'Removed'
    when case_status_sum2 is not null then 'In process' end as appeal_result
from (select j.event_id, o.oli_id, o.case_status_sum2, f.appeal_success,
    case when o.current_ticket_no = j.appeal_ticket_no then '1' when o.current_ticket_no is not null then '0' end
      as current_is_appealed_raw
  from journal j join oli o on j.accession = o.oli_id left join complete_appeal f
    on j.appeal_case_no = f.appeal_case_no and j.appeal_ticket_no = f.appeal_ticket_no and j.accession = f.accession)""",
          journal=JOURNAL_CASE)
def appeal_result_journal(t):
    rows = appeals.appeal_journal(journal(t), t.complete_appeal)
    lines = t.oli.select("oli_id", "case_status_sum2", "current_ticket_no")
    out = status.appeal_result_simple(rows.join(lines, rows.accession == lines.oli_id, "inner"), status_required=True)
    return out.select("event_id", "oli_id", "current_is_appealed", "appeal_result")


@register("q_appeal_result_detail", VIEWS + " oli", """
select oli_id, appeal_case_no,
  case when current_ticket_no = appeal_ticket_no then '1' when current_ticket_no <> appeal_ticket_no then '0' end as current_is_appealed,
  case when appeal_success = '1' then 'Success' when appeal_success = '0' then 'Failed' when appeal_case_no is null then null
    when case_status_sum2 in ('Completed', 'Final Review', 'Due from Patient') then 'Removed' else 'In Process' end as appeal_result
from (select o.oli_id, o.case_status_sum2, o.current_ticket_no, w.appeal_case_no, w.appeal_ticket_no, w.appeal_success
  from oli o left join appeal_wide w on o.oli_id = w.accession)""", **WIDE)
def appeal_result_detail(t):
    outcome = wide(t).select("accession", "appeal_case_no", "appeal_ticket_no", "appeal_success")
    lines = t.oli.select("oli_id", "case_status_sum2", "current_ticket_no")
    out = status.appeal_result_simple(lines.join(outcome, lines.oli_id == outcome.accession, "left"),
                                      status_required=False)
    return out.select("oli_id", "appeal_case_no", "current_is_appealed", "appeal_result")


PAYOR = ("plan", "tier1_payor", "tier2_payor", "tier4_payor")


@register("q_payor_header", "revenue oli", f"""
select coalesce(r.oli_id, o.oli_id) as oli_id, coalesce(r.ticket_no, o.current_ticket_no) as ticket_no, o.current_ticket_no,
  {', '.join(f'case when r.oli_id is null then o.{c} else r.{c} end as {c}' for c in PAYOR)}, s.case_status_sum2
from (select * from (select *, row_number() over (partition by oli_id, ticket_no order by period desc nulls last,
    plan desc, tier1_payor desc, tier2_payor desc, tier4_payor desc) as rn from revenue) where rn = 1) r
full join oli o on r.oli_id = o.oli_id and r.ticket_no = o.current_ticket_no
left join oli s on coalesce(r.oli_id, o.oli_id) = s.oli_id""")
def payor_header(t):
    return appeals.ticket_payor_header(t.revenue, t.oli, PAYOR, ["case_status_sum2"])


# view sets -----------------------------------------------------------------

SETS = {"set_region": "tier1_payor_id", "set_nation": "tier2_payor_id", "set_west": "tier2_payor_id"}


def _set_sql(name: str, column: str, alias: str) -> str:
    return (f"case when {column} in (select payor_id from view_set where set_name = '{name}') then '1' end as {alias}")


@register("q_view_sets", "bill payor ins_codes view_set", f"""
select b.oli_id, b.ticket_no, a.tier1_payor_id, a.tier2_payor_id,
  p.tier1_payor_id as primary_tier1_payor_id, p.tier2_payor_id as primary_tier2_payor_id,
  {', '.join(_set_sql(n, 'a.' + c, n) for n, c in SETS.items())},
  {', '.join(_set_sql(n, 'p.' + c, 'primary_' + n) for n, c in SETS.items())}
from bill b left join hierarchy a on b.rerouted_plan_house = a.tier4_payor_id
left join hierarchy p on b.primary_plan_house = p.tier4_payor_id""", hierarchy=HIERARCHY)
def view_sets(t):
    tiers = hierarchy(t).select("tier1_payor_id", "tier2_payor_id", "tier4_payor_id")
    payors = views.payor_view_sets(tiers, t.view_set, SETS)
    rows = t.bill.select("oli_id", "ticket_no", "rerouted_plan_house", "primary_plan_house")
    out = attach_payor_hierarchies(rows, payors, ticket_plan="rerouted_plan_house")
    return out.drop("rerouted_plan_house", "primary_plan_house", "tier4_payor_id", "primary_tier4_payor_id")


@register("q_top_payors", "oli payor", """
select o.oli_id, case when t.s_nationkey is null then 0 else coalesce(t.top_payors, 0) end as top_payors,
  coalesce(t.bcbs, 0) as bcbs
from oli o left join (select distinct s_nationkey, case when s_nationkey % 2 = 0 then 1 end as top_payors,
    case when s_nationkey % 3 = 0 then 1 end as bcbs from supplier) t on o.territory = t.s_nationkey""")
def top_payors(t):
    n = F.col("s_nationkey")
    listed = t.base("supplier").select(n.alias("territory"), F.when(n % 2 == 0, 1).alias("top_payors"),
                                       F.when(n % 3 == 0, 1).alias("bcbs"))
    lines = t.oli.select("oli_id", "territory")
    return views.top_payor_flags(lines, listed, key="territory").drop("territory")


# policies ------------------------------------------------------------------

BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CRITERIA = (policy.Criterion("brand_field", "Brand", BRANDS), policy.Criterion("type_field", "Type", TYPES))
POLICY_HEADER = ["name", "policy", "policy_status", "test", "tier4_payor_id"]


def _flag_sql(field: str, value: str) -> str:
    return (f"case when coalesce({field}, '') = '' then '' when list_contains(string_split({field}, ';'), '{value}') "
            f"then '1' else '0' end")


@register("q_criteria_wide", "policy", f"""
select {', '.join(POLICY_HEADER)}, brand_field, type_field,
  {', '.join(f'{_flag_sql(c.field, v)} as "{c.field}={v}"' for c in CRITERIA for v in c.values)}
from policy where test = 'IBC'""")
def criteria_wide(t):
    return policy.criteria_wide(t.policy, CRITERIA, POLICY_HEADER, test="IBC")


VALUE_LIST = ", ".join(f"('{c.label}', '{v}')" for c in CRITERIA for v in c.values)


@register("q_criteria_long", "policy", f"""
select {', '.join('p.' + c for c in POLICY_HEADER)}, v.criteria, v.condition,
  case when field = '' then '' when list_contains(string_split(field, ';'), v.condition) then '1' else '0' end as coverage
from policy p cross join (values {VALUE_LIST}) as v(criteria, condition)
cross join lateral (select coalesce(case when v.criteria = 'Brand' then p.brand_field else p.type_field end, '') as field)
where p.test = 'IBC' or v.criteria = 'Type'""")
def criteria_long(t):
    return policy.criteria_long(t.policy, {"IBC": CRITERIA, "Prostate": CRITERIA[1:]}, POLICY_HEADER)


PA_LIST = ", ".join(f"('{r}')" for r in rules.PA_REQUIREMENTS)


@register("q_validation_wide", "validation", f"""
select name, test, tier4_payor_id, {', '.join(f'{_flag_sql("prior_authorization", r)} as "{r}"' for r in rules.PA_REQUIREMENTS)}
from validation where test = 'Prostate'""")
def validation_wide(t):
    return policy.validation_wide(t.validation, ["name", "test", "tier4_payor_id"], test="Prostate")


@register("q_validation_long", "validation", f"""
select name, test, tier4_payor_id, r.pa_requirement, case when prior_authorization = '' then ''
    when list_contains(string_split(prior_authorization, ';'), r.pa_requirement) then '1' else '0' end as requirement
from validation cross join (values {PA_LIST}) as r(pa_requirement)""")
def validation_long(t):
    return policy.validation_long(t.validation, ["name", "test", "tier4_payor_id"])


AVAILABLE = """
select a.oli_id, a.line_no, a.tier4_payor_id, a.test, a.patient_type, a.patient_brand, a.multiple_primaries, a.pre_claim_failure,
  m.name as mp_policy, m.policy_status as mp_policy_status, m.brand_field as mp_brand_field, m.type_field as mp_type_field,
  case when m.name is null then 'No PTC' when m.brand_field is null and m.type_field is null then 'Blank PTC' else 'Yes PTC' end as mp_status_detail,
  c.name as ct_policy, c.policy_status as ct_policy_status, c.brand_field as ct_brand_field, c.type_field as ct_type_field,
  case when c.name is null then 'No PTC' when c.brand_field is null and c.type_field is null then 'Blank PTC' else 'Yes PTC' end as ct_status_detail,
  v.name as validation, v.pa_required, case when v.name is null then 'No' else 'Yes' end as validation_available
from patient a
left join policy m on m.policy = 'MP' and a.tier4_payor_id = m.tier4_payor_id and a.test = m.test
left join policy c on c.policy = 'CT' and a.tier4_payor_id = c.tier4_payor_id and a.test = c.test
left join validation v on a.tier4_payor_id = v.tier4_payor_id and a.test = v.test"""
FIELDS_OF_POLICY = ["brand_field", "type_field"]


def available(t: Tables):
    return policy.policy_availability(t.patient, t.policy, t.validation, FIELDS_OF_POLICY)


@register("q_blank_policy", "patient policy validation", """
select oli_id, line_no, tier4_payor_id, test, mp_policy, mp_policy_status, mp_status_detail, ct_policy, ct_policy_status,
  ct_status_detail, validation, pa_required, validation_available,
  case when mp_status_detail = 'Yes PTC' then 'Published policy' else 'No policy' end as mp_status,
  case when ct_status_detail = 'Yes PTC' then 'Contracted policy' else 'No policy' end as ct_status
from available""", available=AVAILABLE)
def blank_policy(t):
    return available(t).drop("patient_type", "patient_brand", "multiple_primaries", "pre_claim_failure",
                             *[f"{p}_{c}" for p in ("mp", "ct") for c in FIELDS_OF_POLICY])


COVERAGE_RULES = (
    policy.CoverageRule("type", "patient_type", "mp_type_field"),
    policy.CoverageRule("brand", "patient_brand", "mp_brand_field"),
    policy.CoverageRule("multi", "multiple_primaries", "mp_type_field", only_when="Yes"),
)


def _cell_sql(name: str, patient: str, field: str) -> str:
    return f"""
  case when mp_status_detail <> 'Yes PTC' then '..Out' when coalesce({field}, '') = '' then '.In'
    when coalesce({patient}, 'Unknown') = 'Unknown' then '..Out'
    when list_contains(string_split({field}, ';'), {patient}) then '.In' else '..Out' end as {name}_coverage,
  case when mp_status_detail <> 'Yes PTC' then mp_status_detail when coalesce({field}, '') = '' then 'Unspecified criteria'
    when coalesce({patient}, 'Unknown') = 'Unknown' then 'Indeterminable'
    when list_contains(string_split({field}, ';'), {patient}) then 'Meet criteria' else 'Out of criteria' end as {name}_reason"""


CELLS = f"""
select oli_id, line_no, mp_status_detail <> 'Yes PTC' as no_policy, coalesce(pre_claim_failure, 'PA not required') as pre_claim_failure,
  coalesce(cast(pa_required as varchar), '.PTV unknown') as pa_required,
  {_cell_sql('type', 'patient_type', 'mp_type_field')}, {_cell_sql('brand', 'patient_brand', 'mp_brand_field')},
  case when mp_status_detail <> 'Yes PTC' then '..Out' when multiple_primaries <> 'Yes' or mp_type_field is null then '.In'
    else '..Out' end as multi_coverage,
  case when mp_status_detail <> 'Yes PTC' then mp_status_detail when multiple_primaries <> 'Yes' then 'Meet criteria'
    when mp_type_field is null then 'Unspecified criteria' else 'Out of criteria' end as multi_reason
from available"""


@register("q_coverage", "patient policy validation", """
select oli_id, line_no, pre_claim_failure, pa_required, type_coverage, type_reason, brand_coverage, brand_reason,
  multi_coverage, multi_reason,
  case when pre_claim_failure = 'Failure' or (pre_claim_failure = 'PA Denied' and not no_policy) then '..Out' else '.In' end
    as pa_requirement_coverage,
  case when not no_policy then considered end as criteria_considered,
  case when not no_policy and considered > 0 and not any_out then '.In' else '..Out' end as mp_in_criteria,
  case when not no_policy and not any_out and pre_claim_failure not in ('Failure', 'PA Denied') then '.In' else '..Out' end
    as oli_in_criteria
from (select *, cast((type_reason <> 'Unspecified criteria') as integer) + cast((brand_reason <> 'Unspecified criteria') as integer)
    + cast((multi_reason = 'Out of criteria') as integer) as considered,
  '..Out' in (type_coverage, brand_coverage, multi_coverage) as any_out from cells)""", available=AVAILABLE, cells=CELLS)
def coverage(t):
    out = policy.coverage_in_out(available(t), COVERAGE_RULES)
    return out.select(
        "oli_id", "line_no", "pre_claim_failure", "pa_required",
        *[f"{r.name}_{c}" for r in COVERAGE_RULES for c in ("coverage", "reason")],
        "pa_requirement_coverage", "criteria_considered", "mp_in_criteria", "oli_in_criteria")


def _strict_sql(patient: str, field: str, name: str) -> str:
    return f"""
  case when mp_status_detail <> 'Yes PTC' then '.Out'
    when coalesce({patient}, 'Unknown') = 'Unknown' and {field} is null then 'Patient & MP_Criteria blank'
    when list_contains(string_split({field}, ';'), {patient}) then '..In' else '.Out' end as {name}_coverage_2"""


@register("q_coverage_strict", "patient policy validation", f"""
select *, case when no_policy then null when failure then '.Out' else '..In' end as pa_requirement_2,
  case when no_policy or failure or '.Out' in (type_coverage_2, brand_coverage_2) then '.Out' else '..In' end as mp_in_criteria_2
from (select oli_id, line_no, mp_status_detail <> 'Yes PTC' as no_policy, coalesce(pre_claim_failure = 'Failure', false) as failure,
  {_strict_sql('patient_type', 'mp_type_field', 'type')}, {_strict_sql('patient_brand', 'mp_brand_field', 'brand')} from available)""",
          available=AVAILABLE)
def coverage_strict(t):
    out = policy.coverage_in_out_strict(available(t), COVERAGE_RULES[:2])
    return out.select("oli_id", "line_no", (F.col("mp_status") == "No policy").alias("no_policy"),
                      F.coalesce(F.col("pre_claim_failure") == "Failure", F.lit(False)).alias("failure"),
                      "type_coverage_2", "brand_coverage_2", "pa_requirement_2", "mp_in_criteria_2")


# clinical values -----------------------------------------------------------

CLINICAL = ["nodal_status", "procedure_type", "hormone_receptor", "multiple_primaries", "patient_age", "tumour_size",
            "med_onc_order"]


@register("q_clinical_bins", "clinical", """
select oli_id, line_no, l_partkey,
  case nodal_status when 'Node Negative' then 'Node Negative (pN0)' when 'Micromets (pN1mi: 0.2 - 2.0mm)'
    then 'Micromets (pN1mi: 0.2 2.0mm)' else nodal_status end as nodal_status,
  replace(procedure_type, '-', ' ') as procedure_type,
  case when submitted_er = 'Positive' and submitted_pr = 'PR Positive' then 'ER Positive and PR Positive (HR positive)' end as hormone_receptor,
  case multiple_primaries when 1 then 'Yes' when 0 then 'No' end as multiple_primaries,
  case when patient_age is null then 'Unknown' when patient_age >= 50 then '>= 50' else '< 50' end as patient_age,
  case when tumour_size_cm is null then 'Unknown' when tumour_size_cm <= 0.5 then '.Size <= 0.5 cm'
    when tumour_size_cm < 0.6 then '0.5 < Size < 0.6 cm' when tumour_size_cm <= 1 then '0.6 <= Size <= 1.0 cm'
    when tumour_size_cm <= 5 then '1.0 < Size <= 5.0 cm' else 'Size > 5.0 cm' end as tumour_size,
  case when specialty in ('Oncologist', 'Radiation Oncologist') then 'Med Onc Order' when specialty is not null
    then 'Non-Med Onc Order' end as med_onc_order,
  case when specimen_age < 180 then 'Less than 6 months' when specimen_age <= 1080 then '6-36 months' else 'Unknown' end as biopsy_age
from clinical""")
def clinical_bins(t):
    out = standardise.clinical_standardise_ibc(t.clinical)
    return out.select("oli_id", "line_no", "l_partkey", *CLINICAL,
                      standardise.biopsy_age_bin("specimen_age").alias("biopsy_age"))


@register("q_risk", "clinical", """
select oli_id, line_no, l_partkey, submitted_risk as source_risk,
  case when wanted then refined else submitted_risk end as submitted_risk,
  case when wanted then 'NCCN - ' || refined else reporting_group end as reporting_group
from (select *, submitted_risk = 'Intermediate Risk' and test = 'Prostate' and delivered_dt >= date '2017-06-01' as wanted,
  case when lower(revised_risk) = 'intermediate favorable' then 'Favorable Intermediate'
    when lower(revised_risk) = 'intermediate unfavorable' then 'Unfavorable Intermediate'
    when coalesce(gleason, '') = '' then submitted_risk
    when gleason = '4+3' then 'Unfavorable Intermediate'
    when gleason = '3+3' and psa < 10 then 'Favorable Intermediate'
    when (gleason = '3+3' and psa < 20) or (gleason = '3+4' and psa < 10) then
      case when stage = '' then submitted_risk when stage in ('T1c', 'T2a') then 'Favorable Intermediate' else 'Unfavorable Intermediate' end
    when gleason in ('3+3', '3+4') then 'Unfavorable Intermediate' end as refined
  from clinical)""")
def refined_risk(t):
    return risk.refine_risk(t.clinical).select("oli_id", "line_no", "l_partkey", "source_risk", "submitted_risk",
                                               "reporting_group")


@register("q_order_case_extract", "extract_case", """
select o.o_orderkey as order_id, o.o_custkey as account_id, cast(o.o_orderdate as date) as start_dt, l.l_linenumber as line_no,
  c.c_name as account_name, k.case_id, k.case_type, n.n_name as owner_name
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
left join customer c on o.o_custkey = c.c_custkey left join extract_case k on o.o_orderkey = k.order_id
left join nation n on k.owner_id = n.n_nationkey
where cast(o.o_orderdate as date) between date '1996-01-07' and date '1997-04-10'
  and (k.case_type in ('Pre-Billing', 'Missing Data') or k.case_type is null)""")
def case_extract(t):
    items = t.base("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"))
    orders = t.base("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("account_id"),
                                     F.col("o_orderdate").cast("date").alias("start_dt"))
    accounts = t.base("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"))
    groups = t.base("nation").select(F.col("n_nationkey").cast("bigint").alias("owner_id"),
                                     F.col("n_name").alias("owner_name"))
    return order_case_extract(items, orders, accounts, t.extract_case, groups, "1996-01-07", "1997-04-10").drop("owner_id")


@register("q_view_sets_rows", "oli view_set", f"""
select oli_id, territory, mod as group_id, {_set_sql('set_nation', 'territory', 'set_nation')},
  {_set_sql('set_region', 'mod', 'set_region')}, {_set_sql('set_nation', 'mod', 'primary_set_nation')},
  {_set_sql('set_region', 'territory', 'primary_set_region')}
from (select oli_id, territory, cast(order_id % 5 as integer) as mod from oli)""")
def view_sets_rows(t):
    rows = t.oli.select("oli_id", "territory", (F.col("order_id") % 5).cast("int").alias("group_id"))
    sets = {"set_nation": "territory", "set_region": "group_id"}
    out = views.payor_view_sets(rows, t.view_set, sets)
    return views.payor_view_sets(out, t.view_set, sets, prefix="primary_",
                                 column_of={"territory": "group_id", "group_id": "territory"})
