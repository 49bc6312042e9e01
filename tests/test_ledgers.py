import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from claimtide.operators import appeals, ledger, period, revenue_lines, rollup, views
from helpers import values

D = dt.date
M = Decimal


def test_unpivot_is_inverse_of_pivot(frame):
    df = frame("k int, a decimal(10,2), b decimal(10,2)", (1, M(5), M(0)), (2, None, M(-3)))
    long = ledger.unpivot_amounts(df, ["k"], ["a", "b"])
    assert [(k, t, float(v)) for k, t, v in values(long)] == [(1, "a", 5.0), (2, "b", -3.0)]
    back = long.groupBy("k").pivot("txn_type", ["a", "b"]).agg(F.sum("txn_amount"))
    assert [tuple(None if x is None else float(x) for x in r) for r in values(back)] == [(1.0, 5.0, None), (2.0, None, -3.0)]


BILL = ("oli_id string, ticket_no int, acct_period date, txn_date date, currency string, txn_amount decimal(12,2),"
        " ticket_balance decimal(12,2), txn_line int, txn_type string")
PAY = ("oli_id string, ticket_no int, acct_period date, txn_date date, txn_line int, currency string, txn_type string,"
       " txn_amount decimal(12,2), vendor_adj_code string, house_adj_code string, adj_desc string, category_desc string,"
       " adj_group string")
JAN, FEB, MAR = D(2016, 1, 1), D(2016, 2, 1), D(2016, 3, 1)


def inputs(frame):
    bill = frame(BILL, ("A", 1, JAN, JAN, "USD", M(100), M(40), 0, "CL"), ("A", 1, FEB, FEB, "USD", M(10), M(-40), 0, "CL"),
                 ("A", 2, JAN, JAN, "USD", M(0), M(7), 0, "CL"), (None, 3, JAN, JAN, "USD", M(5), M(5), 0, "CL"))
    pay = frame(PAY, ("A", 1, FEB, FEB, 1, "USD", "RI", M(-30), "", "", None, None, None),
                ("A", 1, FEB, FEB, 2, "USD", "AC", M(-9), "C6", "GH04", "d", "Charged in Error", "Charged in Error"),
                ("A", 1, FEB, FEB, 3, "USD", "AD", M(2), "D4", "GH05", "d", "Refund", "Refund & Refund Reversal"),
                ("A", 2, FEB, FEB, 4, "USD", "AD", M(-1), "ZZ", "GH09", None, None, None))
    rev = frame("oli_id string, ticket_no int, period date, total decimal(12,2), accrual decimal(12,2), cash decimal(12,2),"
                " total_usd decimal(12,2), accrual_usd decimal(12,2), cash_usd decimal(12,2)",
                ("A", 1, MAR, M(6), M(2), M(4), M(6), M(2), M(4)), ("A", 1, MAR, M(2), M(2), M(0), M(2), M(2), M(0)))
    return bill, pay, rev


def test_period_amounts(frame):
    bill, pay, rev = inputs(frame)
    out = period.accounting_period_amounts(bill, pay, rev)
    got = {(r.oli_id, r.ticket_no, r.acct_period): r for r in out.collect()}
    # An ungrouped adjustment makes no row; a zero balance books nothing on the
    # last period, an open one does.
    assert set(got) == {("A", 1, JAN), ("A", 1, FEB), ("A", 1, MAR), ("A", 2, JAN), ("A", 2, MAR)}
    feb = got["A", 1, FEB]
    assert (feb.charge, feb.payor_paid, feb.grp_charged_in_error, feb.grp_refund_refund_reversal) == (10, 30, -9, -2)
    assert (feb.billed, feb.payment, feb.adjustment, feb.new_claim) == (1, 28, 0, 1)
    assert got["A", 2, MAR].outstanding == 7 and got["A", 1, MAR].outstanding == 0
    assert got["A", 1, MAR].total_revenue == 8
    flipped = period.accounting_period_amounts(bill, pay, rev, flip_after=True)
    assert values(flipped) == values(out.select(*flipped.columns))


def test_adjustments_of_unlisted_groups_count(frame):
    bill, pay, rev = inputs(frame)
    extra = pay.filter("txn_type in ('AC', 'AD')").limit(1)
    for group, amount in (("New Group", -5), ("Insurance Adjustment", -7), (None, -100)):
        row = extra.withColumns({
            "oli_id": F.lit("N"), "ticket_no": F.lit(9).cast(dict(pay.dtypes)["ticket_no"]), "acct_period": F.lit(MAR),
            "vendor_adj_code": F.lit("ZZ"), "txn_amount": F.lit(amount).cast(dict(pay.dtypes)["txn_amount"]),
            "adj_group": F.lit(group).cast("string")})
        pay = pay.unionByName(row)
    got = period.accounting_period_amounts(bill, pay, rev).filter("oli_id = 'N'").collect()
    assert [(float(r.adjustment), float(r.grp_other)) for r in got] == [(12.0, 5.0)]


def test_journal_reconciles_with_the_period_report(frame):
    bill, pay, rev = inputs(frame)
    last = period.latest_period(bill, pay, rev)
    rows = ledger.ticket_journal(bill, rollup.normalise_payment_sign(pay), rev, last)
    typed = {(t, c): float(a) for t, c, a in values(rows.filter("oli_id = 'A'").groupBy("txn_type", "txn_category").agg(F.sum("txn_amount")))}
    assert typed == {("Charge", "Billing"): 110.0, ("PayorPaid", "Payment"): 30.0, ("GH04:Charged in Error", "Billing"): -9.0,
                     ("GH05:Refund", "Payment"): -2.0, (None, "Adjustment"): 1.0, ("Outstanding", "Outstanding"): 7.0,
                     ("AccrualRevenue", "Revenue"): 4.0, ("CashRevenue", "Revenue"): 4.0}
    assert {r.acct_period for r in rows.filter("txn_category = 'Outstanding'").collect()} == {MAR}
    assert rows.filter("txn_amount = 0").count() == 0
    mean = ledger.revenue_entries(rev, "mean")
    assert [(t, float(a)) for t, a in values(mean, "txn_type", "txn_amount")] == [("AccrualRevenue", 2.0), ("CashRevenue", 2.0)]


def test_criteria_journal_signs(frame):
    _, pay, _ = inputs(frame)
    rows = ledger.criteria_payment_entries(pay)
    assert sorted((r.txn_type, r.txn_subcategory, r.txn_category, float(r.txn_amount)) for r in rows.collect()) == [
        ("CIE", "Charged in Error", "Billing", -9.0), ("GH09", "Adjustment", "Receipts", 1.0),
        ("RI", "Payment", "Receipts", 30.0), ("RR", "Payment", "Receipts", -2.0)]


def test_merge_rollups_equals_full_outer_join(spark):
    left = spark.range(0, 50).select((F.col("id") % 20).alias("k"), F.col("id").alias("v")).groupBy("k").agg(F.sum("v").alias("a"))
    right = spark.range(10, 60).select((F.col("id") % 30).alias("k"), F.col("id").alias("v")).groupBy("k").agg(F.sum("v").alias("b"))
    joined = left.join(right, "k", "full").select("k", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    assert values(rollup.merge_rollups([left, right], ["k"])) == values(joined)


APPEAL = ("id int, appeal_case_no int, appeal_ticket_no int, accession string, level_code string, appeal_status string,"
          " appeal_status_desc string, denial_dt date, report_dt date, entry_dt date, ins_code string, den_reason string,"
          " den_reason_desc string, campaign_code string")


def journal(frame):
    d1, d2 = D(2017, 1, 1), D(2017, 2, 1)
    return frame(APPEAL,
                 (1, 10, 1, "A", "A1", None, "x", d1, None, d1, "i1", "r1", "R1", "c"),
                 (2, 10, 1, "A", "A1", "S2", "y", d2, None, d2, "i2", "r2", "R2", "c"),     # second row of a level
                 (3, 10, 1, "A", "L1", "S3", "z", None, d2, None, "i3", "r3", "R3", "c"),
                 (4, 11, 2, "A", "ER", "S4", "z", d1, None, d2, "i4", "r4", "R4", "c"),
                 (6, 11, 2, "A", "B7", "S6", "z", None, None, None, "i6", "r6", "R6", "c"),  # a level without columns
                 (7, 11, 2, "A", None, "S7", "z", None, None, None, "i7", "r7", "R7", "c"),
                 (5, 12, None, "B", "A1", "S5", "z", d1, None, None, "i5", "r5", "R5", "c"))


def test_levels_wide_takes_first_values(frame):
    wide = appeals.levels_wide(journal(frame))
    assert values(wide, "appeal_case_no", "case_level_cnt", "a1_status", "a1_status_desc", "a1_ins_code", "l1_status", "a2_status",
                  "er_entry_dt") == [(10, 3, "S2", "x", "i1", "S3", None, None), (11, 3, None, None, None, None, None, D(2017, 2, 1))]


def test_last_denial_and_outcome(frame):
    rows = journal(frame)
    last = appeals.last_denial(rows)
    assert values(last, "accession", "last_level", "last_den_reason", "oli_level_cnt", "first_entry_dt") == [
        ("A", "A1", "r2", 6, D(2017, 1, 1)), ("B", "A1", "r5", 1, None)]
    assert values(appeals.first_entry(rows)) == [("A", D(2017, 1, 1)), ("B", None)]
    case = frame("case_no int, ticket_no int, accession string", (10, 1, "A"), (11, 2, "A"))
    done = frame("appeal_case_no int, appeal_ticket_no int, accession string, appeal_success string, appeal_den_reason string,"
                 " appeal_den_reason_desc string, appeal_ins_code string", (10, 1, "A", "1", "f", "F", "fi"), (11, 2, "A", "0", "g", None, "gi"))
    out = appeals.appeal_wide(rows, case, done)
    assert values(out, "appeal_case_no", "appeal_success", "appeal_den_reason", "appeal_den_reason_desc", "appeal_ins_code") == [
        (10, "1", "f", "F", "fi"), (11, "0", "r2", "R2", "i2")]


def test_case_join_drops_unknown_appeals(frame):
    appeal = frame("appeal_case_no int, campaign_code string", (1, "uhclnp"), (2, "x"), (3, None))
    case = frame("case_no int, ticket_no int, accession string", (1, 5, None), (2, None, None), (4, 1, "Z"))
    out = appeals.attach_case(appeals.fix_campaign_code(appeal), case)
    assert values(out, "appeal_case_no", "campaign_code", "appeal_ticket_no") == [(1, "UHCLNP", 5)]


def test_payor_header_prefers_revenue(frame):
    rev = frame("oli_id string, ticket_no int, period date, plan string", ("A", 1, JAN, "old"), ("A", 1, FEB, None), ("B", 2, JAN, "b"))
    oli = frame("oli_id string, current_ticket_no int, plan string, state string", ("A", 1, "mine", "s"), ("C", 9, "c", "t"), ("D", None, "d", "u"))
    out = appeals.ticket_payor_header(rev, oli, ["plan"], ["state"])
    assert values(out) == sorted([("A", 1, 1, None, "s"), ("B", 2, None, "b", None), ("C", 9, 9, "c", "t"), ("D", None, None, "d", "u")], key=repr)


def test_view_sets(frame):
    df = frame("id int, t1 string, t2 string", (1, "a", "x"), (2, None, "y"), (3, "b", None))
    members = frame("set_name string, payor_id string", ("s1", "a"), ("s1", "b"), ("s1", "a"), ("s2", "x"), ("s3", "y"), ("s2", None))
    out = views.payor_view_sets(df, members, {"s1": "t1", "s2": "t2", "s3": "t2"})
    assert values(out, "id", "s1", "s2", "s3") == [(1, "1", "1", None), (2, None, None, "1"), (3, "1", None, None)]


def test_order_revenue_fills(frame):
    rev = frame("oli_id string, ticket_no int, period date, claim_period date, currency string, total_usd decimal(12,2),"
                " accrual_usd decimal(12,2), cash_usd decimal(12,2), tier1_payor string, tier2_payor string, tier4_payor string",
                ("A", 1, JAN, None, "USD", M(1), M(1), M(0), "G (1)", "P one (2)", "Q"), ("A", 2, FEB, None, None, M(2), M(2), M(0), "H (3)", "P two (4)", "Q (5)"),
                ("Z", 1, JAN, JAN, "USD", M(9), M(9), M(0), "G (1)", None, None))
    oli = frame("oli_id string, delivered_dt date, tier1_payor string, tier1_payor_name string, tier1_payor_id string, tier2_payor string,"
                " tier2_payor_name string, tier2_payor_id string, tier4_payor string, tier4_payor_name string, tier4_payor_id string",
                ("A", D(2016, 3, 1), None, None, None, None, None, None, None, None, None),
                ("B", D(2016, 3, 15), "own", "own", "0", None, None, None, None, None, None))
    out = revenue_lines.oli_payment_revenue(oli, rev)
    assert values(out, "oli_id", "tier1_payor", "tier2_payor_name", "tier2_payor_id", "claim_period_label", "ticket_cnt", "ticket_no_last") == [
        ("A", "H (3)", "P two", "4", "Feb 2016", 2, 2), ("B", "own", None, None, "Mar 2016", None, None),
        ("Z", "G (1)", None, None, "Jan 2016", 1, 1)]


def test_ticket_revenue(frame):
    txn = frame("oli_id string, ticket_no int, billed int", ("A", 1, 5), ("A", 2, 6), ("B", 7, 8))
    rev = frame("oli_id string, ticket_no int, period date, total_usd decimal(12,2), accrual_usd decimal(12,2), cash_usd decimal(12,2)",
                ("A", 1, JAN, M(3), M(1), M(2)))
    oli = frame("oli_id string, current_ticket_no int, delivered_dt date", ("A", 2, FEB), ("C", 9, FEB), ("B", 7, D(2015, 1, 1)), ("D", None, FEB))
    out = revenue_lines.oli_ticket_revenue(txn, rev, oli)
    assert values(out.current, "oli_id", "ticket_no", "billed", "current_ticket_no") == [("A", 2, 6, 2), ("C", 9, None, 9)]
    assert [(o, t, float(r)) for o, t, r in values(out.outdated, "oli_id", "ticket_no", "total_usd")] == [("A", 1, 3.0)]
