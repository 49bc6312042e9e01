"""Registered queries: policy gap and coverage of both tests by the rules of the reports."""

from pyspark.sql import functions as F

from claimtide.lens.queries_appeals import SETS, _set_sql
from claimtide.lens.registry import Tables, register
from claimtide.plans import reports

SINCE = "1994-06-01"
TIERS = "tier1_payor_id, tier2_payor_id, tier4_payor_id, tier4_payor_name"

# Patient values in the wording of the policies.
PATIENT = {
    "IBC": """
select * replace (
  case nodal_status when 'Node Negative' then 'Node Negative (pN0)' when 'Micromets (pN1mi: 0.2 - 2.0mm)'
    then 'Micromets (pN1mi: 0.2 2.0mm)' else nodal_status end as nodal_status,
  replace(procedure_type, '-', ' ') as procedure_type,
  case multiple_primaries when 1 then 'Yes' when 0 then 'No' end as multiple_primaries,
  case when patient_age is null then 'Unknown' when patient_age >= 50 then '>= 50' else '< 50' end as patient_age),
  case when submitted_er = 'Positive' and submitted_pr = 'PR Positive' then 'ER Positive and PR Positive (HR positive)' end as hormone_receptor,
  case when specialty in ('Oncologist', 'Radiation Oncologist') then 'Med Onc Order' when specialty is not null
    then 'Non-Med Onc Order' end as med_onc_order""",
    "Prostate": """
select * replace (
  case is_hcp_ctr when 1 then 'Yes' when 0 then 'No' end as is_hcp_ctr,
  case max_tumour_involvement when '> 50%' then 'Greater than or Equal to 50%' when '≤ 50%' then 'less than 50%'
    else max_tumour_involvement end as max_tumour_involvement,
  case submitted_risk when 'Favorable Intermediate' then 'Intermediate Favorable'
    when 'Unfavorable Intermediate' then 'Intermediate Unfavorable' else submitted_risk end as submitted_risk),
  case when specimen_age < 0 or specimen_age > 1080 or specimen_age is null then 'Unknown' when specimen_age < 180
    then 'Less than 6 months' else '6-36 months' end as biopsy_age,
  case when specialty = 'Oncologist' then 'Med Onc Order' when specialty is not null then 'Non-Med Onc Order' end as med_onc_order"""}

# Criterion, patient value, policy field, whether it counts, and the one value it is compared for.
CELLS = {
    "IBC": [("age_at_diagnosis", "patient_age", "age_at_diagnosis", True, None), ("node_status", "nodal_status", "node_status", True, None),
            ("er_status", "submitted_er", "er_status", True, None), ("pr_status", "submitted_pr", "pr_status", True, None),
            ("hormone_receptor", "hormone_receptor", "hormone_receptor", True, None),
            ("her2_status", "submitted_her2", "her2_status", True, None), ("procedure_type", "procedure_type", "procedure_type", True, None),
            ("med_onc_order", "med_onc_order", "med_onc_order", True, None),
            ("multi_tumour", "multiple_primaries", "multi_tumour", True, "Yes")],
    "Prostate": [("age_of_biopsy", "biopsy_age", "age_of_biopsy", True, None), ("risk_category", "submitted_risk", "risk_category", True, None),
                 ("gleason_score", "gleason", "gleason_score", True, None), ("clinical_stage", "stage", "clinical_stage", True, None),
                 ("procedure_type", "procedure_type", "procedure_type", True, None), ("ctr", "is_hcp_ctr", "ctr", True, None),
                 ("med_onc_order", "med_onc_order", "med_onc_order", False, None),
                 ("tumour_involvement", "max_tumour_involvement", "tumour_involvement", False, None)]}
OUT = {"IBC": "Out of criteria", "Prostate": "..Out"}
CONTRACT = {"IBC": "Contracted policy", "Prostate": "Published policy"}
PLANS = {"IBC": reports.IBC_COVERAGE, "Prostate": reports.PROSTATE_COVERAGE}
VIEWS = "order_risk payor_policy validation view_set"


def _policies(test: str, kind: str) -> str:
    blank = " and ".join(f"{c} is null" for c in PLANS[test].criteria)
    return f"select *, {blank} as blank from payor_policy where policy = '{kind}' and test = '{test}' and tier4_payor_id is not null"


def _available(test: str) -> dict[str, str]:
    """Claimed orders with their policies, under the names that the decision uses."""
    fields = sorted({c[2] for c in CELLS[test]})
    return {
        "patients": f"{PATIENT[test]} from order_risk where test = '{test}' and current_ticket_no is not null and order_start_dt >= date '{SINCE}'",
        "medical": _policies(test, "MP"), "contract": _policies(test, "CT"),
        "available": f"""
select p.*, m.name as mp_policy, m.policy_status as mp_policy_status, {', '.join(f'm.{c} as mp_{c}' for c in fields)},
  case when m.name is null then 'No PTC' when m.blank then 'Blank PTC' else 'Yes PTC' end as mp_status_detail,
  case when m.name is null or m.blank then 'No policy' else 'Published policy' end as mp_status,
  c.name as ct_policy, c.policy_status as ct_policy_status,
  case when c.name is null then 'No PTC' when c.blank then 'Blank PTC' else 'Yes PTC' end as ct_status_detail,
  case when c.name is null or c.blank then 'No policy' else '{CONTRACT[test]}' end as ct_status,
  v.name as validation, v.pa_required
from patients p left join medical m on p.tier4_payor_id = m.tier4_payor_id left join contract c on p.tier4_payor_id = c.tier4_payor_id
left join validation v on p.tier4_payor_id = v.tier4_payor_id and p.test = v.test"""}


def _cell(test: str, name: str, patient: str, field: str, only: str | None) -> str:
    skipped = f"coalesce({patient}, 'Unknown') <> '{only}'" if only else "false"
    ways = f"""when {skipped} then {{skip}} when coalesce(mp_{field}, '') = '' then {{blank}}
    when coalesce({patient}, 'Unknown') in ('', 'Unknown') then {{unknown}}
    when list_contains(string_split(mp_{field}, ';'), {patient}) then {{ok}} else {{out}} end"""
    cover = ways.format(skip="'.In'", blank="'.In'", unknown="'..Out'", ok="'.In'", out="'..Out'")
    reason = ways.format(skip="'Meet criteria'", blank="'Unspecified criteria'", unknown="'Indeterminable'",
                         ok="'Meet criteria'", out=f"'{OUT[test]}'")
    return f"""
  case when no_policy then '..Out' {cover} as {name}_coverage,
  case when no_policy then mp_status_detail {reason} as {name}_reason,
  case when not no_policy and not ({skipped}) and coalesce(mp_{field}, '') = '' then 'Unspecified criteria' else mp_{field} end as shown_{field},
  cast(not ({skipped}) and coalesce(mp_{field}, '') <> '' as int) as {name}_counts"""


def _coverage_columns(test: str) -> list[str]:
    return [f"{n}_{x}" for n, *_ in CELLS[test] for x in ("coverage", "reason")]


def _coverage(test: str) -> tuple[str, dict[str, str]]:
    counted = [n for n, _, _, counts, _ in CELLS[test] if counts]
    passed = " and ".join(f"{n}_coverage = '.In'" for n in counted)
    parts = {**_available(test), "noted": """
select *, mp_status = 'No policy' as no_policy, coalesce(pre_claim_failure, 'PA not required') as failure from available""",
             "decided": "select *, " + ", ".join(_cell(test, n, p, f, only) for n, p, f, _, only in CELLS[test]) + " from noted",
             "summed": f"select *, {' + '.join(f'{n}_counts' for n in counted)} as considered, {passed} as all_in from decided"}
    return f"""
select oli_id, line_no, {TIERS}, mp_policy, mp_status, ct_status, failure as pre_claim_failure,
  coalesce(cast(pa_required as varchar), '.PTV unknown') as pa_required, {', '.join(_coverage_columns(test))},
  {', '.join(f'shown_{c[2]} as mp_{c[2]}' for c in CELLS[test])},
  case when failure = 'Failure' or (failure = 'PA Denied' and not no_policy) then '..Out' else '.In' end as pa_requirement_coverage,
  case when not no_policy then considered end as criteria_considered,
  case when not no_policy and considered > 0 and all_in then '.In' else '..Out' end as mp_in_criteria,
  case when not no_policy and all_in and failure not in ('Failure', 'PA Denied') then '.In' else '..Out' end as oli_in_criteria,
  {', '.join(_set_sql(n, c, n) for n, c in SETS.items())}
from summed""", parts


GAP = f"""
select oli_id, order_id, test, delivered_dt, order_start_dt, {TIERS}, financial_category, mp_policy, mp_policy_status, mp_status,
  mp_status_detail, ct_policy, ct_policy_status, ct_status, ct_status_detail, validation,
  {', '.join(_set_sql(n, c, n) for n, c in SETS.items())}
from available"""


def policy_inputs(t: Tables, test: str):
    claims = reports.ClaimTables(*[None] * 6, view_members=t.view_set, view_sets=SETS)
    return reports.coverage_input(t.order_risk, t.payor_policy, t.validation, PLANS[test], SINCE), claims


def _register(test: str) -> None:
    sql, parts = _coverage(test)
    wanted = ["oli_id", "line_no", *TIERS.split(", "), "mp_policy", "mp_status", "ct_status", "pre_claim_failure", "pa_required",
              *_coverage_columns(test), *[f"mp_{c[2]}" for c in CELLS[test]], "pa_requirement_coverage", "criteria_considered",
              "mp_in_criteria", "oli_in_criteria", *SETS]

    @register(f"q_policy_gap_{test.lower()}", VIEWS, GAP, **_available(test))
    def policy_gap(t):
        return reports.policy_gap(*policy_inputs(t, test))

    @register(f"q_coverage_{test.lower()}", VIEWS, sql, **parts)
    def coverage(t):
        data, claims = policy_inputs(t, test)
        return reports.coverage(data, claims, PLANS[test]).select(*[F.col(c) for c in wanted])


for _test in PLANS:
    _register(_test)
