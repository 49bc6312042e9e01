import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.operators import latest, quality, reference, rollup, standardise, status
from helpers import values

D = dt.date


def test_latest_row_ties_nulls_and_partitioning(frame):
    df = frame("k int, o int, tie int, p string",
               (1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "c"), (2, None, 1, "d"), (None, 9, 9, "e"), (3, 1, 1, "f"))
    expected = [(1, 5, 2, "b"), (2, None, 1, "d"), (3, 1, 1, "f")]
    assert values(latest.latest_row(df, ["k"], ["o", "tie"])) == expected
    assert values(latest.latest_row(df.repartition(5), ["k"], ["o", "tie"])) == expected
    assert values(latest.first_row(df, ["k"], ["o", "tie"])) == [(1, 5, 1, "a"), (2, None, 1, "d"), (3, 1, 1, "f")]
    both = latest.first_and_last(df, ["k"], ["o", "tie"], ["p"])
    assert values(both) == [(1, "a", "b"), (2, "d", "d"), (3, "f", "f")]


def test_text_ids_order_by_number(frame):
    bill = frame("oli_id string, ticket_no string, case_no string", ("O", "T", "9"), ("O", "T", "10"))
    assert values(reference.latest_case_per_ticket(bill)) == [("O", "T", "10")]


def test_hot_key_gives_the_same_row(spark):
    rows = spark.range(0, 30000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    got = latest.latest_row(rows, ["k"], ["o"]).filter("k = 0").collect()
    assert [tuple(r) for r in got] == [(0, 29997)]


BILL = "oli_id string, ticket_no int, case_no int, txn_date date, case_status_sum2 string"


def test_current_reference(frame):
    bill = frame(BILL,
                 ("A", 1, 10, D(2017, 1, 1), "Completed"), ("A", 1, 12, D(2017, 1, 1), "Appeals"),
                 ("A", 2, 11, D(2016, 1, 1), "Completed"),      # older date, greater ticket
                 ("A", None, 99, D(2018, 1, 1), "Completed"),   # counts as a ticket, is never current
                 ("B", 5, 20, D(2017, 1, 1), None))             # absent from the case file
    case = frame("accession string, case_no int, added_ts timestamp",
                 ("A", 12, dt.datetime(2017, 1, 2)), ("A", 13, dt.datetime(2017, 1, 3)), ("A", 13, dt.datetime(2016, 1, 3)),
                 ("C", 30, None), (None, 40, dt.datetime(2017, 1, 1)))
    out = reference.current_reference(bill, case, ("txn_date", "case_status_sum2"))
    assert values(out, "oli_id", "current_ticket_no", "ticket_cnt", "current_case_no", "case_cnt", "case_status_sum2") == [
        ("A", 1, 3, 12, 2, "Appeals"), ("C", None, None, 30, 1, None)]


def test_claim_flags(frame):
    df = frame("current_ticket_no int, case_status_sum2 string, dos date, vendor_dos date",
               (1, "Completed", None, D(2017, 1, 1)), (1, "Appeals", D(2016, 1, 1), D(2017, 1, 1)), (None, None, None, None))
    assert values(reference.claim_flags(df), "is_claim", "is_fully_adjudicated", "dos") == [
        (0, None, None), (1, 0, D(2016, 1, 1)), (1, 1, D(2017, 1, 1))]


def test_hierarchies_remap_retired_plans(frame):
    payors = frame("tier4_payor_id string, tier1_payor_name string, tier1_payor_id string, tier2_payor_name string,"
                   " tier2_payor_id string, tier4_payor_name string, financial_category string, line_of_benefit string",
                   ("PL0006511", "T1", "1", "T2", "2", "T4", None, "M"))
    dim = reference.payor_hierarchy(payors, frame("tier4_payor_id string, vendor_fc string", ("PL0006511", "V")))
    oli = frame("oli_id int, ticket_plan_house string, primary_plan_house string",
                (1, "PL0001459", None), (2, "zzz", "PL0006511"))
    out = reference.reroute_flags(reference.attach_payor_hierarchies(oli, dim))
    assert values(out, "oli_id", "tier4_payor", "primary_tier4_payor", "financial_category", "rerouted_ticket") == [
        (1, "T4 (PL0006511)", None, "V", "Yes"), (2, None, "T4 (PL0006511)", None, "Yes")]


def test_sign_rule(frame):
    rows = [(t, c, a) for t in ("RI", "RP", "AC", "AD", "CL") for c in ("C6", "CCD", "D4", None) for a in (5.0, -5.0, 0.0)]
    out = rollup.normalise_payment_sign(frame("txn_type string, vendor_adj_code string, txn_amount double", *rows))
    for (t, c, a), r in zip(rows, out.collect()):
        flips = t in ("RI", "RP") or (t in ("AC", "AD") and c not in ("C6", "CCD"))
        assert r.txn_amount == (-a if flips else a) and str(r.txn_amount) != "-0.0"
    twice = rollup.normalise_payment_sign(out)
    assert [r.txn_amount for r in twice.collect()] == [a for _, _, a in rows]


def test_ticket_payor_follows_the_plan(frame):
    fields = ("plan_vendor", "plan_house", "plan_name")
    df = frame("rerouted_plan_vendor string, rerouted_plan_house string, rerouted_plan_name string,"
               " primary_plan_vendor string, primary_plan_house string, primary_plan_name string",
               (None, "rh", "rn", "p", "ph", "pn"), ("r", None, "rn", "p", "ph", "pn"), ("ROST", "rh", None, "p", "ph", "pn"))
    assert values(standardise.resolve_ticket_payor(df, fields), *[f"ticket_{f}" for f in fields]) == [
        ("p", "ph", "pn"), ("r", None, "rn"), ("rh", "rh", None)]


def test_payment_standardisation(frame):
    payment = frame("test string, txn_type string, vendor_adj_code string, house_adj_code string, ticket_plan_vendor string,"
                    " ticket_plan_house string, primary_plan_house string",
                    ("GL", "RI", "7", None, "7", "h", "p"), ("GL", "RI", "8", "x", "7", "h", "p"),
                    ("GL", "RI", "8", "x", None, "h", "p"), ("GLD", "AC", "PRAC", "GH01", "7", "h", "p"),
                    ("GLD", "AD", "ZZ", "GH02", "7", "h", "p"))
    codes = frame("vendor_adj_code string, adj_desc string, category_desc string, adj_group string",
                  ("PRAC", "d", "c", "g"), (None, "n", "n", "n"))
    out = standardise.standardise_payment(payment, codes)
    assert values(out, "txn_type", "vendor_adj_code", "house_adj_code", "payment_plan_vendor", "ticket_plan_house",
                  "is_primary_payment", "adj_group") == sorted([
                      ("RI", "", "", "7", "h", 1, None), ("RI", "", "", "8", "h", 0, None), ("RI", "", "", "8", "p", 1, None),
                      ("AC", "PRAC", "GH07", None, "h", None, "g"), ("AD", "ZZ", "GH02", None, "h", None, None)], key=repr)


def test_conflicts(frame):
    df = frame("oli_id string, test string, currency string",
               ("ok", "A", "USD"), ("ok", "Unknown", None), ("test", "A", "USD"), ("test", "B", "USD"),
               ("cur", "A", "USD"), ("cur", "A", "EUR"), ("nulltest", "A", "USD"), ("nulltest", None, "USD"),
               ("unknown", "Unknown", "USD"), ("unknown", None, "USD"), (None, "A", "X"), (None, "B", "Y"))
    assert values(quality.conflict_keys(df)) == [
        ("cur", False, True), ("nulltest", True, False), ("test", True, False)]
    dropped = quality.split_conflicts(df)
    assert dropped.kept.count() == 6 and dropped.rejected.count() == 6   # rows without a key stay
    kept = quality.split_conflicts(df, drop=False)
    assert kept.kept.count() == 12 and kept.rejected.count() == 6


def test_malformed_ids_are_errors(frame):
    df = frame("oli_id string, test string, currency string",
               ("OL1", "A", "USD"), ("XX", "A", "USD"), ("Unknown()", "A", "USD"), (None, "A", "USD"))
    split = quality.split_conflicts(df, id_ok=quality.well_formed_id())
    assert values(split.kept, "oli_id") == [("OL1",), ("Unknown()",)]
    assert values(split.rejected, "oli_id") == [("XX",), (None,)]


def test_key_and_row_filters(frame):
    df = frame("oli_id string, ticket_no int, total double, cash double",
               ("A", 1, 0.0, None), ("B", 1, None, 2.0), ("NONE", 1, 1.0, 1.0), (None, 1, 1.0, 1.0), ("C", None, 5.0, 5.0))
    kept, rejected = quality.split_valid_keys(df)
    assert values(kept, "oli_id") == [("A",), ("B",), ("C",)] and rejected.count() == 2
    assert values(quality.drop_no_impact(kept, ["total", "cash"]), "oli_id") == [("B",)]
    assert values(kept.filter(quality.not_zero("total")), "oli_id") == [("B",), ("C",)]


def test_receipt_rollup_conserves_amounts(frame):
    bill = frame("oli_id string, txn_amount decimal(12,2), amt_received decimal(12,2), amt_adjusted decimal(12,2),"
                 " ticket_balance decimal(12,2)",
                 ("A", Decimal(100), Decimal(-40), Decimal(-10), Decimal(50)), ("B", Decimal(7), Decimal(0), None, Decimal(7)))
    payment = frame("oli_id string, txn_type string, vendor_adj_code string, adj_group string, category_desc string,"
                    " txn_amount decimal(12,2), allowed_amt decimal(12,2)",
                    ("A", "RI", "", None, None, Decimal(-30), Decimal(60)), ("A", "RI", "", None, None, Decimal(5), Decimal(99)),
                    ("A", "RP", "", None, None, Decimal(-10), None), ("A", "AC", "C6", "Charged in Error", "c", Decimal(-20), None),
                    ("A", "AD", "D4", "Refund & Refund Reversal", "r", Decimal(3), None),
                    ("A", "AD", "BAO", "Insurance Adjustment", "i", Decimal(-8), None), ("A", "AD", "??", None, None, Decimal(-1), None),
                    ("C", "RP", "", None, None, Decimal(-2), None))
    out = rollup.receipt_rollup(bill, payment, with_allowed=True)
    got = {r.oli_id: {k: (None if v is None else float(v)) for k, v in r.asDict().items() if k != "oli_id"} for r in out.collect()}
    a = got["A"]
    assert (a["charge"], a["received"], a["claim_adjusted"], a["outstanding"]) == (100, 40, 10, 50)
    assert (a["payor_paid"], a["patient_paid"], a["allowed_amt"]) == (25, 10, 60)
    assert (a["adjusted"], a["grp_charged_in_error"], a["grp_refund_refund_reversal"]) == (-14, -20, -3)
    assert (a["total_billed"], a["total_payment"], a["total_adjustment"]) == (80, 37, 9)
    assert a["grp_insurance_adjustment"] == 8 and a["grp_house_adjustment"] == 0
    assert got["C"]["patient_paid"] == 2 and got["C"]["charge"] == 0 and got["B"]["claim_adjusted"] == 0
    total = sum(g["charge"] for g in got.values())
    assert total == 107


def test_allowed_and_single_payments(frame):
    pay = frame("oli_id string, test string, ticket_no int, txn_type string, txn_amount double, txn_date date, allowed_amt double,"
                " deductible_amt double, coins_amt double",
                ("A", "t", 1, "RI", -5.0, D(2017, 1, 1), 9.0, 1.0, None), ("B", "t", 1, "RI", -5.0, D(2017, 1, 1), 9.0, 0.0, 0.0),
                ("B", "t", 1, "RI", 5.0, D(2017, 1, 2), 90.0, 0.0, 0.0), ("C", "t", 1, "RP", -5.0, D(2017, 1, 1), 9.0, 0.0, 0.0))
    assert values(rollup.allowed_amount(pay, flipped=False)) == [("A", 9.0), ("B", 9.0)]
    split = rollup.single_multi_payment_split(pay)
    assert values(split.single, "oli_id", "payor_paid", "compare_amt") == [("A", 5.0, 6.0)]
    assert values(split.multiple, "oli_id") == [("B",), ("B",)]
    assert rollup.single_payment_share(pay).collect()[0][0] == 0.5


ORDER = ("oli_id int, test_delivered int, current_ticket_no int, delivered_dt date, dos date, order_cancel_reason string,"
         " line_cancel_reason string, failure_message string, customer_status string, data_entry_status string")


def test_order_status_rows(frame):
    d = D(2017, 1, 1)
    df = frame(ORDER,
               (1, 1, None, None, d, None, None, None, "Closed", "x"), (2, 1, None, d, None, "P", None, None, "Closed", "x"),
               (3, 0, 7, None, d, None, None, "F", "Closed", "x"), (4, 0, None, None, d, "P", None, None, "Closed", "x"),
               (5, 0, None, None, None, "P", "Q", None, "Closed", "x"), (6, 0, None, None, None, None, None, "F", "Closed", "x"),
               (7, 0, None, None, None, "P", "Q", "F", "Closed", "x"), (8, 0, None, None, None, None, None, None, "Submitting", "x"),
               (9, 0, None, None, None, None, None, None, "Closed", "x"), (10, 0, None, None, None, None, None, None, None, "x"))
    out = status.order_status(df)
    assert {r[0]: r[1:] for r in values(out, "oli_id", "status", "status_notes", "test_delivered")} == {
        1: ("Delivered", "Test Delivered = 1", 1), 2: ("Delivered", "Test Delivered = 1*", 1),
        3: ("Delivered", "Test Delivered = 1*", 1), 4: ("Canceled", "P", 0), 5: ("Canceled", "P , Q", 0),
        6: ("Failed", "F", 0), 7: ("Failed", "F", 0), 8: ("Submitting", "x", 0), 9: ("Closed", None, 0), 10: (None, "x", 0)}
    dates = {r.oli_id: r.delivered_dt for r in out.collect()}
    assert dates[1] == d and dates[3] == d and dates[4] is None


@pytest.mark.parametrize("success", ["1", "0", None])
@pytest.mark.parametrize("reason", ["r", None])
@pytest.mark.parametrize("state", ["Completed", "Appeals", "Open", None])
def test_appeal_result(frame, success, reason, state):
    df = frame("appeal_success string, appeal_den_reason string, case_status_sum2 string, case_status string",
               (success, reason, state, "Paid!"))
    r = status.appeal_result(df).collect()[0]
    done = state == "Completed"
    if success:
        result = "Success" if success == "1" else "Failed"
    else:
        result = None if reason is None else ("Removed" if done else "In Process")
    expected = state
    if result == "In Process":
        expected = "Appeals"
    elif result in ("Success", "Failed") and not done:
        expected = "Final Review"
    elif result is None and state == "Appeals":
        expected = "Claim in Process"
    assert (r.appeal_result, r.case_status_sum2) == (result, expected)
    assert r.case_status == ("Final Review" if success and not done else "Paid!")
    assert (r.is_appeal, r.in_process, r.removed) == (int(reason is not None), int(result == "In Process"), int(result == "Removed"))
    assert (r.succeeded, r.failed, r.completed_appeal) == (int(success == "1"), int(success == "0"), int(success is not None))


def test_simple_appeal_results_differ_on_missing_status(frame):
    df = frame("appeal_success string, case_status_sum2 string, appeal_case_no int, current_ticket_no int, appeal_ticket_no int",
               (None, None, 1, 5, 5), (None, "Open", 1, 5, 6), (None, "Completed", None, None, 6), ("1", None, 1, 5, None))
    columns = ("appeal_result", "current_is_appealed")
    assert values(status.appeal_result_simple(df, True), *columns) == sorted([
        (None, "1"), ("In process", "0"), ("Removed", None), ("Success", "0")], key=repr)
    assert values(status.appeal_result_simple(df, False), *columns) == sorted([
        ("In Process", "1"), ("In Process", "0"), (None, None), ("Success", None)], key=repr)


def test_worklist(frame):
    work = frame("ticket_no int, worklist_code string, condition string",
                 (1, "HS7X", " A "), (1, "HS7X", "B"), (2, "HS7X", "A"), (2, "HS7X", " "), (3, "OTHER", "A"), (4, "HS7X", None))
    dim = frame("worklist_code string, condition string, condition_desc string", ("HS7X", "A", "desc"))
    rows = standardise.worklist_conditions(work, dim)
    assert values(rows, "ticket_no", "condition", "condition_desc") == [
        (1, "A", "desc"), (1, "B", None), (2, "A", "desc")]
    assert values(standardise.ambiguous_conditions(rows)) == [(1, 2)]


def test_latency_summary(frame):
    df = frame("init_bill_dt date, init_payment_dt date, last_payment_dt date",
               (D(2017, 1, 1), D(2017, 1, 11), D(2017, 2, 1)), (D(2017, 1, 1), None, None), (None, D(2017, 1, 1), None))
    assert values(standardise.claim_latency(df), "days_to_init_payment", "days_to_last_payment") == [
        (10, 31), (None, None), (None, None)]


def test_code_table_decides_the_columns(frame):
    codes = frame("vendor_adj_code string, category_desc string, adj_group string", ("C6", "Error", "Charged in Error"),
                  ("N1", "Brand new", "A-B"), ("N2", None, "A B"), ("N3", "brand New", None))
    listed = rollup.code_columns(codes)
    assert listed.groups == (*rules.ADJUSTMENT_GROUPS, "A B", "A-B") and listed.categories == ("Brand new", "Error", "brand New")
    names = [*rollup.group_columns(listed.groups).values(), *rollup.group_columns(listed.categories, "cat_").values()]
    assert len(names) == len(set(names)) == len(listed.groups) + 3
    with pytest.raises(ValueError):
        rollup.code_columns(codes, most=3)
    more = codes.unionByName(frame("vendor_adj_code string, category_desc string, adj_group string", ("Z", "Later", "Later")))
    assert {"Later"} == set(rollup.code_columns(more).groups) - set(listed.groups) == set(rollup.code_columns(more).categories) - set(listed.categories)
