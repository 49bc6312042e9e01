"""The wide rows of the order-line report are joined in place."""

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from claimtide.lens import registry
from claimtide.plans import reports

SF = "/root/testdata/sf0.001"


def test_wide_rows_are_exchanged_by_order_line_only(spark):
    """Beyond the session's broadcast limit too, and with order lines already dealt when appeals and authorisations come."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = registry.QUERIES["q_claim_to_revenue"](spark, SF)._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
        keys = [x.split("Exchange hashpartitioning(")[1].split(", ")[:-2] for x in moved]
        assert keys and not [k for k in keys if any(c.startswith(("current_ticket_no", "ticket_plan_house", "primary_plan")) for c in k)]
        assert len([k for k in keys if any(c.startswith("current_case_no") for c in k)]) == 1
        wide = [x for x in plan.split("Exchange hashpartitioning(current_case_no")[0].splitlines() if "Generate inline" in x]
        assert len(wide) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_appeals_of_the_current_ticket(spark):
    lines = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "c"), (2, None, "d"), (None, 10, "e"), (3, 30, "f")],
                                  "oli_id long, current_ticket_no long, x string")
    wide = spark.createDataFrame([(1, 10, 7), (1, 10, 8), (1, 12, 9), (2, None, 1), (None, 10, 2), (3, 31, 3)],
                                 "accession long, appeal_ticket_no long, appeal_case_no long")
    plain = lines.join(wide.withColumnsRenamed({"accession": "oli_id", "appeal_ticket_no": "current_ticket_no"}),
                       ["oli_id", "current_ticket_no"], "left")
    out = reports.with_current_appeals(lines.select("x", *[F.col(c) for c in ("oli_id", "current_ticket_no")]), wide)
    assert out.columns == plain.columns
    assert out.exceptAll(plain).count() == 0 == plain.exceptAll(out).count() and out.count() == 8


def moved(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in x]


def test_bills_and_cases_are_exchanged_once(spark):
    """Steps by ticket or case and by order line share one exchange by order line."""
    keys = [x.split("Exchange hashpartitioning(")[1].split("#")[0] for x in moved(registry.QUERIES["q_current_reference"](spark, SF))]
    assert sorted(keys) == ["accession", "oli_id"]


def test_only_numbers_of_current_cases_travel_to_authorisations(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        query = registry.QUERIES["q_payment_risk"](spark, SF)._jdf.queryExecution()
        lines = query.executedPlan().toString().splitlines()
        at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(current_case_no" in x)
        below = next(x for x in lines[at + 1:] if "Project [" in x)
        assert below.split("Project [")[1].count(", ") <= 2 and "case_status" not in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_authorisations_of_a_current_case(spark):
    from claimtide.lens.queries_reports import claim_tables
    tables = claim_tables(registry.Tables(spark, SF))
    number = reports.claim_to_revenue(tables).filter("current_case_no is not null").select("oli_id", "current_case_no").limit(1).collect()[0]
    two = spark.createDataFrame([(number.current_case_no, "a"), (number.current_case_no, "b"), (None, "c"), (-9, "d")],
                                "prior_auth_case_no long, prior_auth_number string")
    out = reports.claim_to_revenue(reports.replace(tables, prior_auth=two)).select("oli_id", "current_case_no", "prior_auth_number")
    assert sorted(r.prior_auth_number for r in out.filter(F.col("oli_id") == number.oli_id).collect()) == ["a", "b"]
    others = out.filter(F.col("prior_auth_number").isNotNull() & (F.col("current_case_no") != number.current_case_no))
    assert others.count() == 0 and out.select("oli_id").distinct().count() == 1500
