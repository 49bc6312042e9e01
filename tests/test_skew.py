"""One key with a third of all rows gives the same results as any other key."""

import pytest
from pyspark.sql import functions as F

from claimtide.operators import quality, reference, revenue_lines, rollup
from helpers import values

N = 30000


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(0, N, 1, 12).select(
        F.when(i % 3 == 0, F.lit(-1)).otherwise(i % 5000).alias("oli_id"), (i % 7).alias("ticket_no"), i.alias("case_no"),
        F.date_add(F.lit("2016-01-01").cast("date"), (i % 300).cast("int")).alias("txn_date"),
        F.date_add(F.lit("2016-01-01").cast("date"), (i % 300).cast("int")).alias("period"),
        F.concat(F.lit("T"), i % 2).alias("test"), F.lit("USD").alias("currency"),
        *[F.lit(1).cast("decimal(12,2)").alias(c) for c in quality.REVENUE_MEASURES])


def test_rollup_of_a_hot_key(rows):
    out = rollup.revenue_rollup(rows).filter("oli_id = -1")
    assert [(float(a), n) for a, n in values(out, "total_revenue", "period_cnt")] == [(N / 3, N // 3)]


def test_current_ticket_of_a_hot_key(rows):
    out = reference.current_ticket(rows).filter("oli_id = -1")
    # Latest date first, then the greatest ticket; its case is the greatest one of the ticket.
    hot = [(i % 7, i) for i in range(0, N, 3)]
    cases = {t: max(c for x, c in hot if x == t) for t in range(7)}
    best = max(range(7), key=lambda t: (cases[t] % 300, t))
    assert values(out, "ticket_no", "case_no", "ticket_cnt") == [(best, cases[best], 7)]


def test_conflicts_and_tickets_of_a_hot_key(rows):
    assert values(quality.conflict_keys(rows).filter("oli_id = -1")) == [(-1, True, False)]
    split = quality.split_conflicts(rows)
    assert split.kept.count() + split.rejected.count() == N
    assert values(reference.ticket_counts(rows).filter("oli_id = -1")) == [(-1, 7)]
    summary = revenue_lines.revenue_summary(rows, columns=("period", "currency"))
    assert values(summary.filter("oli_id = -1"), "ticket_cnt", "period_cnt") == [(7, N // 3)]


def test_rows_without_an_order_line_are_dealt_out(spark, rows):
    """All of them stand under one sentinel; no task gets them all, and the joins find what plain ones do."""
    from claimtide import rules
    from claimtide.operators import period
    facts = rows.select(F.when(F.col("oli_id") == -1, rules.NO_ORDER_LINE).otherwise(F.col("oli_id").cast("string")).alias("oli_id"),
                        F.when(F.col("case_no") % 11 != 0, F.col("case_no")).alias("ticket_no"))
    lines = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("oli_id"), (F.col("id") * 2).alias("twice"))
    counts = lines.select("oli_id", F.lit(3).alias("ticket_cnt")).unionByName(
        spark.createDataFrame([(rules.NO_ORDER_LINE, 7), (None, 9)], "oli_id string, ticket_cnt int"))
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        out = period.join_by_line(facts, [lines, counts])
        plain = facts.join(lines, "oli_id", "left").join(counts, "oli_id", "left")
        assert out.columns == plain.columns and out.exceptAll(plain).count() == 0 == plain.exceptAll(out).count()
        tasks = out.filter(F.col("oli_id") == rules.NO_ORDER_LINE).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == N // 3 and max(r["count"] for r in tasks) < N // 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
