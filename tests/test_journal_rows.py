"""The journals' facts are exchanged once, with the prior authorisations of their case."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from claimtide.lens import registry
from claimtide.operators import lookup, period

SF = "/root/testdata/sf0.001"
DAY = datetime.date(2016, 1, 1)


@pytest.mark.parametrize("name", ["q_journal_v1", "q_journal_v2", "q_ticket_journal_v2"])
def test_journal_rows_do_not_move_again(spark, monkeypatch, name):
    """Payors beyond the session's broadcast limit and prior authorisations cost no exchange of the written rows."""
    after = []
    write = period.stage

    def kept(df, *args):
        after.append(write(df, *args))
        return after[-1]

    monkeypatch.setattr(period, "stage", kept)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert len(after) == 1 and "SortMergeJoin" not in plan.split("Subquery")[0].split("BroadcastExchange")[0]
        assert plan.count("Exchange hashpartitioning(plan") == 0
        assert plan.count("Exchange hashpartitioning(case_no") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_broadcast_where_the_session_allows_none(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        payors = spark.range(5).withColumnRenamed("id", "p")
        plan = spark.range(9).join(lookup.as_lookup(payors), F.col("id") == F.col("p"))._jdf.queryExecution().executedPlan()
        assert "BroadcastHashJoin" not in plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def facts(spark, ids):
    money = decimal.Decimal("5.00")
    bill = spark.createDataFrame(
        [(o, t, c, "T", "USD", "1", DAY, DAY, "1", DAY, money, money) for o, t, c in ids],
        "oli_id long, ticket_no long, case_no long, test string, currency string, ticket_plan_house string, dos date, txn_date date,"
        "primary_plan_house string, acct_period date, txn_amount decimal(12,2), ticket_balance decimal(12,2)")
    payment = spark.createDataFrame(
        [(o, t, DAY, DAY, 1, "USD", "RI", money) for o, t, c in ids],
        "oli_id long, ticket_no long, acct_period date, txn_date date, txn_line int, currency string, txn_type string, txn_amount decimal(12,2)")
    payment = payment.withColumns({c: F.lit(None).cast("string") for c in (
        "vendor_adj_code", "adj_desc", "house_adj_code", "category_desc", "adj_group")})
    revenue = spark.createDataFrame(
        [(o, t, DAY, money, money, "EUR", DAY, "R", "1") for o, t, c in ids for _ in range(2) if o is not None],
        "oli_id long, ticket_no long, period date, accrual decimal(12,2), cash decimal(12,2), currency string, delivered_dt date,"
        "test string, plan string")
    lines = spark.createDataFrame([(1, "L", DAY, "here")], "oli_id long, oli_test string, oli_delivered_dt date, territory string")
    payors = spark.createDataFrame([("1", "Plan 1")], "tier4_payor_id string, tier4_payor string")
    return bill, payment, revenue, lines, payors


def test_rows_of_a_case_with_two_authorisations_and_without_an_order_line(spark):
    bill, payment, revenue, lines, payors = facts(spark, [(1, 10, 7), (1, None, 8), (None, 10, 7), (None, None, 7)])
    auth = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c")], "prior_auth_case_no long, prior_auth_number string")
    out = period.attributed_journal(period.staged_journal(bill, payment, revenue, lines, auth), payors, "revenue")
    rows = out.select("oli_id", "ticket_no", "txn_type", F.col("txn_amount").cast("int"), "case_no", "territory", "ticket_cnt",
                      "tier4_payor", "prior_auth_number").collect()
    two = [tuple(r) for r in rows if r.oli_id == 1 and r.ticket_no == 10]
    kinds = [("Charge", 5), ("Outstanding", 5), ("PayorPaid", 5), ("AccrualRevenue", 10), ("CashRevenue", 10)]
    assert sorted(two) == sorted((1, 10, k, v, 7, "here", 2, "Plan 1", a) for k, v in kinds for a in "ab")
    rest = sorted(((r.oli_id, r.ticket_no, r.txn_type, r.case_no, r.territory, r.ticket_cnt, r.prior_auth_number) for r in rows
                   if (r.oli_id, r.ticket_no) != (1, 10)), key=str)
    three = ("Charge", "Outstanding", "PayorPaid")
    assert rest == sorted([(1, None, k, None, "here", 2, None) for k in three]
                          + [(None, t, k, None, None, None, None) for t in (10, None) for k in three], key=str)


def test_rows_without_an_order_line_are_no_single_task(spark):
    bill, payment, revenue, lines, payors = facts(spark, [(None, t, t) for t in range(2000)])
    salted = period.with_salt(bill, ("ticket_no", "txn_date", "txn_amount"))
    assert salted.groupBy("oli_id", "_salt").count().agg(F.max("count")).head()[0] < 2000 // 20
