"""What the written base of the period reports and journals holds."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from claimtide.lens import queries_ledgers, registry
from claimtide.operators import period
from claimtide.operators.quality import REVENUE_MEASURES

SF = "/root/testdata/sf0.001"


def written(spark, monkeypatch, name):
    kept, write = [], period.stage

    def staged(df, *args):
        kept.append(write(df, *args))
        return kept[-1]

    monkeypatch.setattr(period, "stage", staged)
    registry.QUERIES[name](spark, SF)
    return kept[0]


def filled(rows, struct):
    names = rows.schema[struct].dataType.names
    counts = rows.select(*[F.count(f"{struct}.{c}").alias(c) for c in names]).collect()[0].asDict()
    return {c for c, n in counts.items() if n}


def test_a_report_writes_what_it_shows(spark, monkeypatch):
    base = written(spark, monkeypatch, "q_accounting_period")
    assert not [m for m in REVENUE_MEASURES if f"{m}_revenue" in base.columns] and "charge" in base.columns
    assert filled(base, "_case") == {"ticket_plan_house"} and filled(base, "_revenue") == {"plan"}


@pytest.mark.parametrize("name, fields", [("q_journal_v2", {"case_no", "txn_date"}), ("q_journal_v1", {"test", "dos", "ticket_plan_house"}),
                                          ("q_ticket_journal_v2", {"case_no", "txn_date", "_auth"})])
def test_a_journal_writes_what_it_shows(spark, monkeypatch, name, fields):
    rows = written(spark, monkeypatch, name)
    assert filled(rows, "_case") == fields
    assert all(".zstd." in f for f in rows.inputFiles())


def test_the_report_is_the_same_with_and_without_other_columns(spark):
    t = registry.Tables(spark, SF)
    inputs, shown = queries_ledgers.period_inputs(t), queries_ledgers.PERIOD_REPORT_COLUMNS
    payors = queries_ledgers.hierarchy(t).select("tier2_payor", "tier4_payor", "tier4_payor_id", "financial_category")
    narrow = period.period_report(*inputs, t.oli, payors, oli_columns=("territory",), wanted=shown).select(*shown)
    whole = period.period_report(*inputs, t.oli, payors, oli_columns=("territory",))
    assert {f"{m}_revenue" for m in REVENUE_MEASURES} < set(whole.columns)
    assert narrow.exceptAll(whole.select(*shown)).count() == 0 == whole.select(*shown).exceptAll(narrow).count() < narrow.count()
