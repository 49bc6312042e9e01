import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.operators import policy, risk, standardise
from claimtide.plans import reports
from helpers import values

CRITERIA = (policy.Criterion("node", "Node", ("N0", "N1")), policy.Criterion("er", "ER", ("N0", "+")))


def test_criteria_three_states_and_prefix_values(frame):
    df = frame("name string, test string, node string, er string",
               ("a", "IBC", "N0;N10", "+"), ("b", "IBC", "", None), ("c", "Colon", "N1", "+"))
    wide = policy.criteria_wide(df, CRITERIA, ["name"], test="IBC")
    assert values(wide, "name", "node=N0", "node=N1", "er=N0", "er=+") == [
        ("a", "1", "0", "0", "1"), ("b", "", "", "", "")]
    long = policy.criteria_long(df, {"IBC": CRITERIA, "Colon": CRITERIA[:1]}, ["name"])
    assert values(long.filter("name <> 'b'")) == [
        ("a", "ER", "+", "1"), ("a", "ER", "N0", "0"), ("a", "Node", "N0", "1"), ("a", "Node", "N1", "0"),
        ("c", "Node", "N0", "0"), ("c", "Node", "N1", "1")]
    assert {r.coverage for r in long.filter("name = 'b'").collect()} == {""}


def test_validation_rows_once(frame):
    df = frame("name string, test string, prior_authorization string",
               ("a", "IBC", "Pre-DOS;SOMN"), ("b", "Colon", ""))
    long = policy.validation_long(df, ["name"])
    assert long.count() == 2 * len(rules.PA_REQUIREMENTS) == long.distinct().count()
    assert values(long.filter("requirement = '1'"), "name", "pa_requirement") == [("a", "Pre-DOS"), ("a", "SOMN")]
    assert values(policy.validation_wide(df, ["name"], test="IBC"), "SOMN", "Post-DOS") == [("1", "0")]


def test_policy_availability(frame):
    oli = frame("oli_id int, tier4_payor_id string, test string", (1, "p", "IBC"), (2, "q", "IBC"), (3, None, "IBC"))
    ptc = frame("name string, policy string, policy_status string, tier4_payor_id string, test string, node string, er string",
                ("m", "MP", "Active", "p", "IBC", "N0", None), ("c", "CT", "Active", "p", "IBC", None, None),
                ("n", "MP", "Active", None, "IBC", "N0", None))
    ptv = frame("name string, tier4_payor_id string, test string, pa_required string", ("v", "q", "IBC", "1"))
    out = policy.policy_availability(oli, ptc, ptv, ["node", "er"])
    assert values(out, "oli_id", "mp_status_detail", "mp_status", "ct_status_detail", "ct_status", "validation_available") == [
        (1, "Yes PTC", "Published policy", "Blank PTC", "No policy", "No"),
        (2, "No PTC", "No policy", "No PTC", "No policy", "Yes"),
        (3, "No PTC", "No policy", "No PTC", "No policy", "No")]


RULES = (policy.CoverageRule("node", "p_node", "mp_node"), policy.CoverageRule("er", "p_er", "mp_er", counted=False),
         policy.CoverageRule("multi", "p_multi", "mp_multi", only_when="Yes"))
SCHEMA = ("mp_status string, mp_status_detail string, p_node string, mp_node string, p_er string, mp_er string,"
          " p_multi string, mp_multi string, pre_claim_failure string")


def decide(row):
    """The decision table in plain Python."""
    status, detail, p_node, mp_node, p_er, mp_er, p_multi, mp_multi, pa = row
    if status == "No policy":
        return ("..Out", detail) * 3 + ("..Out" if pa == "Failure" else ".In", None, "..Out", "..Out")
    counted, cells = [], []
    for value, listed, counts, skip in ((p_node, mp_node, True, False), (p_er, mp_er, False, False),
                                        (p_multi, mp_multi, True, p_multi != "Yes")):
        known = value not in (None, "", "Unknown")
        if skip:
            cells += [".In", "Meet criteria"]
        elif not listed:
            cells += [".In", "Unspecified criteria"]
        else:
            ok = known and value in listed.split(";")
            cells += [".In" if ok else "..Out", "Meet criteria" if ok else "Out of criteria" if known else "Indeterminable"]
            if counts:
                counted.append(ok)
    auth = pa not in ("Failure", "PA Denied")
    return (*cells, ".In" if auth else "..Out", len(counted), ".In" if counted and all(counted) else "..Out",
            ".In" if all(counted) and auth else "..Out")


def test_coverage_decision_table(frame):
    rows = [("Published policy", "Yes PTC", *c) for c in itertools.product(
        ("N0", "N9", "Unknown", "", None), ("N0;N1", "", None), ("+", None), ("+", None), ("Yes", "No", None),
        ("Yes;No", "No", None), (None, "Failure", "PA Denied"))]
    rows += [("No policy", d, "N0", "N0", "+", "+", "Yes", "Yes", pa) for d in ("No PTC", "Blank PTC")
             for pa in (None, "Failure", "PA Denied")]
    df = frame("i int, " + SCHEMA, *[(i, *r) for i, r in enumerate(rows)])
    out = policy.coverage_in_out(df, RULES)
    columns = [f"{r.name}_{c}" for r in RULES for c in ("coverage", "reason")] + [
        "pa_requirement_coverage", "criteria_considered", "mp_in_criteria", "oli_in_criteria"]
    got = {r[0]: tuple(r[1:]) for r in out.select("i", *columns).collect()}
    assert got == {i: decide(r) for i, r in enumerate(rows)}


def test_blank_policy_field_is_marked(frame):
    df = frame(SCHEMA, ("Published policy", "Yes PTC", "N0", None, "+", "+", "No", None, None))
    r = policy.coverage_in_out(df, RULES).collect()[0]
    assert (r.mp_node, r.mp_er, r.mp_multi, r.pre_claim_failure) == ("Unspecified criteria", "+", None, "PA not required")


@pytest.mark.parametrize("patient,listed,cell,decision", [
    ("N0", "N0", "..In", "..In"), ("N0", "N1", ".Out", ".Out"), ("N0", None, ".Out", ".Out"),
    (None, "N0", ".Out", ".Out"), (None, None, "Patient & MP_Criteria blank", "..In")])
def test_strict_coverage(frame, patient, listed, cell, decision):
    df = frame(SCHEMA, ("Published policy", "Yes PTC", patient, listed, None, None, None, None, "PA Denied"))
    r = policy.coverage_in_out_strict(df, RULES[:1]).collect()[0]
    assert (r.node_coverage_2, r.pa_requirement_2, r.mp_in_criteria_2) == (cell, "..In", decision)


def expected_risk(g, p, s, orig):
    fav, unf = rules.FAVORABLE, rules.UNFAVORABLE
    small, medium = p is not None and p < 10, p is not None and p < 20
    by_stage = orig if s == "" else fav if s in rules.LOW_STAGES else unf
    if g == "":
        return orig
    if g == "4+3":
        return unf
    if g == "3+3":
        return fav if small else by_stage if medium else unf
    if g == "3+4":
        return by_stage if small else unf
    return None


def test_risk_every_branch(frame):
    cases = list(itertools.product(("", "4+3", "3+3", "3+4", "5+5"), (5.0, 10.0, 19.9, 20.0, None), ("", "T1c", "T2A", "T3")))
    df = frame("i int, g string, p double, s string, o string", *[(i, *c, "orig") for i, c in enumerate(cases)])
    got = {r.i: r.v for r in df.select("i", risk.risk_rule(F.col("g"), F.col("p"), F.col("s"), F.col("o")).alias("v")).collect()}
    assert got == {i: expected_risk(*c, "orig") for i, c in enumerate(cases)}


def test_refine_risk_scope(frame):
    schema = ("oli_id int, test string, delivered_dt date, submitted_risk string, reporting_group string, gleason string,"
              " psa double, stage string")
    new, old = dt.date(2017, 6, 1), dt.date(2017, 5, 31)
    df = frame(schema, (1, "Prostate", new, "Intermediate Risk", "g", "3+3", 5.0, ""),
               (2, "Prostate", old, "Intermediate Risk", "g", "3+3", 5.0, ""), (3, "IBC", new, "Intermediate Risk", "g", "3+3", 5.0, ""),
               (4, "Prostate", new, "High Risk", "g", "3+3", 5.0, ""), (5, "Prostate", new, "Intermediate Risk", "g", None, None, None),
               (6, "Prostate", None, "Intermediate Risk", "g", "3+3", 5.0, ""))
    revised = frame("oli_id int, test string, revised_risk string", (1, "Prostate", "INTERMEDIATE UNFAVORABLE"), (5, "Prostate", "odd"))
    out = risk.refine_risk(df, revised)
    assert values(out, "oli_id", "submitted_risk", "reporting_group") == [
        (1, "Unfavorable Intermediate", "NCCN - Unfavorable Intermediate"), (2, "Intermediate Risk", "g"),
        (3, "Intermediate Risk", "g"), (4, "High Risk", "g"), (5, "Intermediate Risk", "NCCN - Intermediate Risk"),
        (6, "Intermediate Risk", "g")]


def test_reporting_group(frame):
    df = frame("test string, reporting_group string, nodal_status string",
               ("IBC", "Node Positive (Micromet)", "Micro"), ("Prostate-AR-V7", "x", None), ("IBC", "x", "y"))
    assert values(risk.standardise_reporting_group(df), "reporting_group") == [("ARV7",), ("Micro",), ("x",)]


def test_bins(frame):
    sizes = frame("v double", *[(v,) for v in (None, 0.5, 0.55, 0.6, 1.0, 1.1, 5.0, 5.1)])
    got = [r[0] for r in sizes.select(standardise.tumour_size_bin("v")).collect()]
    assert got == ["Unknown", ".Size <= 0.5 cm", "0.5 < Size < 0.6 cm", "0.6 <= Size <= 1.0 cm", "0.6 <= Size <= 1.0 cm",
                   "1.0 < Size <= 5.0 cm", "1.0 < Size <= 5.0 cm", "Size > 5.0 cm"]
    days = frame("v int", *[(v,) for v in (None, -1, 0, 179, 180, 1080, 1081)])
    assert [r[0] for r in days.select(standardise.biopsy_age_bin("v")).collect()] == [
        "Unknown", "Unknown", "Less than 6 months", "Less than 6 months", "6-36 months", "6-36 months", "Unknown"]
    ages = frame("v int", (None,), (49,), (50,))
    assert [r[0] for r in ages.select(standardise.age_bin("v")).collect()] == ["Unknown", "< 50", ">= 50"]


IBC_PATIENT = ("oli_id int, test string, current_ticket_no int, order_start_dt date, tier4_payor_id string, nodal_status string,"
               " procedure_type string, submitted_er string, submitted_pr string, submitted_her2 string, multiple_primaries int,"
               " patient_age int, tumour_size_cm double, specialty string, pre_claim_failure string")


def policy_rows(frame, criteria, filled, test):
    schema = "name string, policy string, policy_status string, tier4_payor_id string, test string, " + ", ".join(
        f"{c} string" for c in criteria)
    return frame(schema, ("m", "MP", "Active", "p", test, *[filled.get(c) for c in criteria]))


NO_VALIDATION = "name string, tier4_payor_id string, test string, pa_required string"


def test_ibc_coverage_end_to_end(frame):
    plan = reports.IBC_COVERAGE
    new = dt.date(2017, 2, 1)
    orders = frame(IBC_PATIENT,
                   (1, "IBC", 1, new, "p", "Node Negative", "Non-Biopsy", "Positive", "PR Positive", "Negative", 1, 61, 1.2, "Oncologist", None),
                   (2, "IBC", 1, new, "p", "Node Positive", "Biopsy", "Positive", None, "Negative", 0, 61, 1.2, None, None),
                   (3, "IBC", 1, new, "q", "Node Negative", "Biopsy", "Positive", None, "Negative", 0, 61, 1.2, None, "Failure"),
                   (4, "IBC", None, new, "p", None, None, None, None, None, 0, 1, 1.0, None, None),
                   (5, "IBC", 1, dt.date(2016, 12, 31), "p", None, None, None, None, None, 0, 1, 1.0, None, None))
    ptc = policy_rows(frame, plan.criteria, {
        "node_status": "Node Negative (pN0)", "age_at_diagnosis": ">= 50;< 50", "multi_tumour": "Yes",
        "hormone_receptor": "ER Positive and PR Positive (HR positive)", "procedure_type": "Non Biopsy"}, "IBC")
    data = reports.coverage_input(orders, ptc, frame(NO_VALIDATION), plan)
    out = policy.coverage_in_out(data, plan.rules, plan.words)
    assert values(out, "oli_id", "mp_in_criteria", "oli_in_criteria", "node_status_reason", "multi_tumour_reason",
                  "hormone_receptor_reason", "criteria_considered") == [
        (1, ".In", ".In", "Meet criteria", "Meet criteria", "Meet criteria", 5),
        (2, "..Out", "..Out", "Out of criteria", "Meet criteria", "Indeterminable", 4),
        (3, "..Out", "..Out", "No PTC", "No PTC", "No PTC", None)]


def test_prostate_coverage_end_to_end(frame):
    plan = reports.PROSTATE_COVERAGE
    orders = frame("oli_id int, test string, current_ticket_no int, order_start_dt date, tier4_payor_id string, specialty string,"
                   " is_hcp_ctr int, max_tumour_involvement string, submitted_risk string, specimen_age int, gleason string,"
                   " stage string, procedure_type string, pre_claim_failure string",
                   (1, "Prostate", 1, dt.date(2017, 2, 1), "p", "Surgeon", 1, "> 50%", "Favorable Intermediate", 200, "3+4", None, None, None))
    ptc = policy_rows(frame, plan.criteria, {"risk_category": "Intermediate Favorable", "age_of_biopsy": "6-36 months",
                                             "med_onc_order": "Med Onc Order", "gleason_score": "3+3"}, "Prostate")
    data = reports.coverage_input(orders, ptc, frame(NO_VALIDATION), plan)
    r = policy.coverage_in_out(data, plan.rules, plan.words).collect()[0]
    assert (r.risk_category_reason, r.age_of_biopsy_reason, r.gleason_score_reason) == ("Meet criteria", "Meet criteria", "..Out")
    # Shown but not counted, and a blank field is unspecified.
    assert (r.med_onc_order_coverage, r.tumour_involvement_reason, r.criteria_considered) == ("..Out", "Unspecified criteria", 3)
    assert r.mp_in_criteria == "..Out" and r.mp_status == "Published policy"


def test_conditions_come_from_the_enum_table(spark, frame):
    policies = frame("name string, test string, a string, b string", ("p", "IBC", "x;y", None), ("q", "Prostate", "", "z"),
                     ("r", "Colon", "x", "z"), ("s", None, "x", "z"))
    enum = frame("test string, field string, label string, value string", ("IBC", "a", "A", "x"), ("IBC", "a", "A", "w"),
                 ("IBC", "b", "B", "z"), ("Prostate", "a", "A2", "x"), ("Prostate", "missing", "M", "m"), (None, "a", "A", "x"),
                 ("IBC", "a", "A", None), ("IBC", "a", "A", "x"))
    long = policy.criteria_long_listed(policies, enum, ["name", "test"])
    assert values(long) == sorted([("p", "IBC", "A", "x", "1"), ("p", "IBC", "A", "w", "0"), ("p", "IBC", "B", "z", ""),
                                   ("q", "Prostate", "A2", "x", "")], key=repr)
    wide = policy.criteria_wide_listed(policies, enum, ["name"], "IBC")
    assert wide.columns == ["name", "a", "b", "a=w", "a=x", "b=z"] and values(wide) == [("p", "x;y", None, "0", "1", "")]
    assert policy.criteria_wide_listed(policies, enum, ["name"], "Colon").columns == ["name"]
    assert policy.criteria_long_listed(policies, enum.filter("field = 'missing'"), ["name"]).count() == 0
    more = enum.unionByName(frame("test string, field string, label string, value string", ("Colon", "b", "B", "z")))
    assert ("r", "Colon", "B", "z", "1") in values(policy.criteria_long_listed(policies, more, ["name", "test"]))


def test_requirements_come_from_the_enum_table(frame):
    rows = frame("name string, test string, prior_authorization string", ("v", "IBC", "SOMN;New"), ("w", "Prostate", ""))
    enum = frame("field string, value string", ("prior_authorization", "New"), ("prior_authorization", "Old"), ("other", "SOMN"))
    assert values(policy.validation_long_listed(rows, enum, ["name"])) == [
        ("v", "New", "1"), ("v", "Old", "0"), ("w", "New", ""), ("w", "Old", "")]
    assert values(policy.validation_wide_listed(rows, enum, ["name"], "IBC")) == [("v", "1", "0")]
