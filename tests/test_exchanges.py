"""How often the reports exchange their rows."""

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from claimtide.lens import registry

SF = "/root/testdata/sf0.001"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name, after", [("q_period_report", 2), ("q_period_amounts", 0), ("q_accounting_period_criteria", 2),
                                         ("q_journal", 0), ("q_journal_v2", 2)])
def test_facts_are_exchanged_once_for_the_base(spark, monkeypatch, name, after):
    """The base exchanges the facts together and the order lines; reports read it in place, two small exchanges make the payor
    table, and a journal joins its heads."""
    from claimtide.operators import period
    staged, write = [], period.stage

    def counted(df, *args):
        staged.append(exchanges(df))
        return write(df, *args)

    monkeypatch.setattr(period, "stage", counted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        out = registry.QUERIES[name](spark, SF)
        assert len(staged) == 1 and staged[0] <= 2
        assert exchanges(out) <= after
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["q_accounting_period", "q_period_report_unlinked"])
def test_report_rows_meet_payors_in_place(spark, name):
    """Payors beyond the session's broadcast limit don't make the report's rows move; all windows of a ticket are one pass."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(plan" not in plan and "Exchange hashpartitioning(coalesce" not in plan
        assert "SortMergeJoin" not in plan.split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
