"""Appeal journal, one row per appeal level, and its flat form per ticket."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import as_col
from claimtide.operators.latest import latest_row, pick_greatest

CASE_KEYS = ["appeal_case_no", "appeal_ticket_no"]
COMPLETE_KEYS = [*CASE_KEYS, "accession"]
# Wide columns per level: suffix -> journal column.  The bare level name holds
# the status text.
LEVEL_FIELDS = {
    "status": "appeal_status",
    "status_desc": "appeal_status_desc",
    "denial_dt": "denial_dt",
    "report_dt": "report_dt",
    "entry_dt": "entry_dt",
    "ins_code": "ins_code",
    "den_reason": "den_reason",
}
DENIAL_ORDER = ("denial_dt", "entry_dt", "level_code")
DEFAULT_ORDER = ("entry_dt", "denial_dt", "report_dt")


def fix_campaign_code(appeal: DataFrame, wrong: str = "uhclnp", right: str = "UHCLNP") -> DataFrame:
    code = F.col("campaign_code")
    return appeal.withColumn("campaign_code", F.when(code == wrong, right).otherwise(code))


def attach_case(appeal: DataFrame, case: DataFrame) -> DataFrame:
    """Ticket and order line of the appealed case; rows that find neither drop out."""
    ref = (case.filter(F.col("case_no").isNotNull())
           .select(F.col("case_no").alias("appeal_case_no"),
                   F.col("ticket_no").alias("appeal_ticket_no"), "accession"))
    # A row needs a match to have either value, so the join can be inner.
    return (appeal.join(ref, "appeal_case_no", "inner")
            .filter(F.col("appeal_ticket_no").isNotNull() | F.col("accession").isNotNull()))


def level_counts_by_case(journal: DataFrame) -> DataFrame:
    return (journal.filter(F.col("appeal_case_no").isNotNull() & F.col("appeal_ticket_no").isNotNull())
            .groupBy(*CASE_KEYS).agg(F.count(F.lit(1)).alias("case_level_cnt")))


def level_counts_by_line(journal: DataFrame) -> DataFrame:
    return (journal.filter(F.col("accession").isNotNull())
            .groupBy("accession").agg(F.count(F.lit(1)).alias("oli_level_cnt")))


def appeal_journal(journal: DataFrame, complete: DataFrame) -> DataFrame:
    """Journal rows with the outcome of the completed appeal and both level counts."""
    success = complete.select(*COMPLETE_KEYS, "appeal_success")
    return (journal.join(success, COMPLETE_KEYS, "left")
            .join(level_counts_by_case(journal), CASE_KEYS, "left")
            .join(level_counts_by_line(journal), "accession", "left"))


def first_value_by(value: str, order: Sequence) -> Column:
    """Aggregate: first non-missing value along ``order`` (NULL last)."""
    ranks = [x for o in order for x in (as_col(o).isNull(), as_col(o))]
    row = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(ranks)], F.col(value).alias("value"))
    return F.min(F.when(F.col(value).isNotNull(), row))["value"]


def levels_wide(journal: DataFrame, levels: Sequence[str] = rules.APPEAL_LEVELS,
                fields: Mapping[str, str] = LEVEL_FIELDS,
                order: Sequence = DEFAULT_ORDER) -> DataFrame:
    """One row per case and ticket with the fields of every level side by side.

    The level list is fixed, so no pass over the data looks for it.  Rows of other levels, and of none, have no fields
    here but count in ``case_level_cnt``.
    """
    rows = journal.filter(F.col("appeal_case_no").isNotNull() & F.col("appeal_ticket_no").isNotNull())
    # Values of a level first meet in one struct per (case, ticket, level), which keeps the aggregate narrow.
    firsts = F.struct(*[first_value_by(src, order).alias(name) for name, src in fields.items()])
    by_level = rows.groupBy(*CASE_KEYS, "level_code").agg(firsts.alias("first"), F.count(F.lit(1)).alias("rows"))
    at = {lv: F.max(F.when(F.col("level_code") == lv, F.col("first"))).alias(lv) for lv in levels}
    wide = by_level.groupBy(*CASE_KEYS).agg(F.sum("rows").alias("case_level_cnt"), *at.values())
    return wide.select(*CASE_KEYS, "case_level_cnt", *[
        F.col(f"{lv}.{name}").alias(f"{lv.lower()}_{name}") for name in fields for lv in levels])


def last_denial(journal: DataFrame, order: Sequence = DENIAL_ORDER) -> DataFrame:
    """Row of the latest denial per order line, with level count and first entry."""
    columns = ["appeal_case_no", "appeal_ticket_no", "ins_code", "level_code", "den_reason",
               "den_reason_desc", "entry_dt", "denial_dt", "campaign_code"]
    columns = [c for c in columns if c in journal.columns]
    names = {"ins_code": "last_ins_code", "level_code": "last_level", "den_reason": "last_den_reason",
             "den_reason_desc": "last_den_reason_desc", "entry_dt": "last_entry_dt",
             "denial_dt": "last_denial_dt"}
    # One aggregation answers latest denial, first entry and number of levels.
    return (journal.filter(F.col("accession").isNotNull()).groupBy("accession")
            .agg(pick_greatest(order, columns).alias("_pick"),
                 F.count(F.lit(1)).alias("oli_level_cnt"),
                 F.min("entry_dt").alias("first_entry_dt"))
            .select("accession", "_pick.row.*", "oli_level_cnt", "first_entry_dt")
            .withColumnsRenamed(names))


def first_entry(journal: DataFrame) -> DataFrame:
    return (journal.filter(F.col("accession").isNotNull())
            .groupBy("accession").agg(F.min("entry_dt").alias("first_entry_dt")))


def prepare_complete(complete: DataFrame) -> DataFrame:
    """Applied receipts of completed appeals in positive sign."""
    amount = F.col("appeal_amt_applied")
    return complete.withColumn("appeal_amt_applied", F.when(amount != 0, -amount).otherwise(amount))


def appeal_wide(journal: DataFrame, case: DataFrame, complete: DataFrame,
                levels: Sequence[str] = rules.APPEAL_LEVELS,
                order: Sequence = DEFAULT_ORDER,
                denial_order: Sequence = DENIAL_ORDER) -> DataFrame:
    """Flat appeal history per ticket with the last denial and the final outcome.

    Reason and insurer come from the completed appeal, else from the last denial.
    """
    ref = (case.filter(F.col("case_no").isNotNull() & F.col("ticket_no").isNotNull())
           .select(F.col("case_no").alias("appeal_case_no"),
                   F.col("ticket_no").alias("appeal_ticket_no"), "accession"))
    denial = last_denial(journal, denial_order).drop(*CASE_KEYS)
    out = (levels_wide(journal, levels, order=order)
           .join(ref, CASE_KEYS, "left")
           .join(denial, "accession", "left")
           .join(complete, COMPLETE_KEYS, "left"))
    open_ = F.col("appeal_den_reason_desc").isNull()
    fills = {"appeal_den_reason": "last_den_reason", "appeal_den_reason_desc": "last_den_reason_desc",
             "appeal_ins_code": "last_ins_code"}
    return out.withColumns({
        to: F.when(open_, F.col(by)).otherwise(F.col(to)) for to, by in fills.items()
        if to in out.columns})


class AppealData(NamedTuple):
    journal: DataFrame
    wide: DataFrame


def make_appeal_data(appeal: DataFrame, case: DataFrame, complete: DataFrame) -> AppealData:
    """Both appeal tables from the three extracts."""
    journal = attach_case(fix_campaign_code(appeal), case)
    complete = prepare_complete(complete)
    return AppealData(appeal_journal(journal, complete), appeal_wide(journal, case, complete))


def ticket_payor_header(revenue: DataFrame, oli: DataFrame, payor_columns: Sequence[str],
                        status_columns: Sequence[str] = ()) -> DataFrame:
    """Payor per order line and ticket: last revenue row, else the current ticket's.

    Both sides hold one row per pair, so the outer join meets no hot key.
    """
    last = latest_row(revenue, ["oli_id", "ticket_no"], ["period"], payor_columns)
    current = oli.select("oli_id", F.col("current_ticket_no").alias("ticket_no"),
                         F.col("current_ticket_no"),
                         *[F.col(c).alias(f"oli_{c}") for c in payor_columns])
    known = last.withColumn("_from_revenue", F.lit(True))
    out = known.join(current, ["oli_id", "ticket_no"], "full")
    own = F.col("_from_revenue")
    out = out.select("oli_id", "ticket_no", "current_ticket_no", *[
        F.when(own, F.col(c)).otherwise(F.col(f"oli_{c}")).alias(c) for c in payor_columns])
    if status_columns:
        out = out.join(oli.select("oli_id", *status_columns), "oli_id", "left")
    return out
