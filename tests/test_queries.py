"""Every registered query against its SQL, and what its plan may contain."""

import pytest

import __spark_entry__ as entry
from claimtide.lens import registry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                   "MapInArrow", "Window ["):
        assert banned not in plan, f"{banned} in the plan of {name}"
    assert compare(df, con, ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "tier1_payor" in df.columns


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_exchange_counts(spark):
    """One exchange per source: the merged rollups are not exchanged again."""
    assert exchanges(QUERIES["q_receipt_rollup"](spark, SF)) == 2
    assert exchanges(QUERIES["q_period_amounts"](spark, SF)) == 5
    assert exchanges(QUERIES["q_revenue_rollup"](spark, SF)) == 1
    assert exchanges(QUERIES["q_first_last"](spark, SF)) == 1
    assert exchanges(QUERIES["q_conflicts"](spark, SF)) == 1
    assert exchanges(QUERIES["q_last_denial"](spark, SF)) <= 4
    for narrow in ("q_criteria_long", "q_validation_long", "q_risk", "q_order_status", "q_payment_payor"):
        assert exchanges(QUERIES[narrow](spark, SF)) == 0


def test_scans_are_pruned(spark):
    plan = QUERIES["q_receipt_rollup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_quantity" not in plan
    assert plan.count("FileScan parquet") == 2


def test_result_does_not_depend_on_partitioning(spark, con):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("q_order_to_cash", "q_period_amounts", "q_appeal_wide", "q_revenue_summary"):
            assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_written_reports(spark, tmp_path):
    from claimtide.lens.queries_reports import claim_tables
    from claimtide.lens.registry import Tables
    from claimtide.plans import reports
    reports.write_claim_reports(claim_tables(Tables(spark, SF)), str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {"claim_to_revenue", "oli_transactions", "managed_care", "payment_risk", "domestic_billing",
                     "appeal_extract_prostate", "appeal_extract_ibc", "appeals_detail_prostate", "appeals_detail_ibc"}
    lines = spark.read.parquet(str(tmp_path / "claim_to_revenue"))
    assert lines.count() == lines.select("oli_id").distinct().count() == 1500
    assert set(spark.read.parquet(str(tmp_path / "payment_risk")).columns) <= set(lines.columns)


def test_written_bundles(spark, tmp_path):
    from claimtide.lens.queries_reports import claim_tables
    from claimtide.lens.registry import Tables
    from claimtide.plans import reports
    t = claim_tables(Tables(spark, SF))
    reports.write_period_reports(t, str(tmp_path), ("territory",))
    revenue = reports.oli_revenue(t.oli, t.revenue, ["oli_id", "test"])
    reports.write_named(revenue, str(tmp_path), "revenue_")
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {"accounting_period", "accounting_period_criteria", "ticket_journal_v1", "ticket_journal_v2",
                     "ticket_journal_criteria", "revenue_processed", "revenue_errors", "revenue_lines", "revenue_ledger",
                     "revenue_subset"}
    shown = spark.read.parquet(str(tmp_path / "accounting_period"))
    assert shown.filter("payment = '0' or payment = '0.00'").count() == 0 and shown.filter("payment = ''").count() > 0
    assert spark.read.parquet(str(tmp_path / "revenue_errors")).count() == revenue.errors.count() > 0


@pytest.mark.parametrize("name, most", [("q_period_report", 5), ("q_journal_v2", 5), ("q_journal_v1", 5), ("q_period_amounts", 3),
                                        ("q_journal", 5)])
def test_period_reports_read_each_fact_once(spark, monkeypatch, name, most):
    """The base reads bills, payments and revenue once; a journal reads bills and payments again for its rows."""
    from claimtide.operators import period
    scans, write = [], period.stage

    def count(df):
        return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")

    def staged(df, *args):
        scans.append(count(df))
        return write(df, *args)

    monkeypatch.setattr(period, "stage", staged)
    scans.append(count(registry.QUERIES[name](spark, SF)))
    assert len(scans) == 2 and sum(scans) <= most, scans
