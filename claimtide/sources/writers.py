"""Report tables as Parquet or delimited text, and the refresh log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Control:
    """What a written report holds: number of rows, and the sum of every decimal column (None without values)."""

    report: str
    rows: int
    sums: dict[str, Decimal | None] = field(default_factory=dict)


def write_ordered(df: DataFrame, path: str, name: str, order: Sequence = (), delimited: bool = False,
                  rows_per_file: int = ROWS_PER_FILE, sep: str = "|") -> Control:
    """Write a report in its order over all files, and count it while it is written.

    ``order`` deals the rows out by ranges, so file after file they are in order, and no task holds more than its range.
    No file has more than ``rows_per_file`` rows.
    """
    out = df.orderBy(*order) if order else df
    money = [c for c, t in df.dtypes if t.startswith("decimal")]
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"),
                      *[F.sum(F.col(f"`{c}`").cast("decimal(38,8)")).alias(f"s{i}") for i, c in enumerate(money)])
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if delimited:
        writer.option("sep", sep).option("header", True).csv(path)
    else:
        writer.parquet(path)
    found = seen.get
    return Control(name, found["rows"], {c: found[f"s{i}"] for i, c in enumerate(money)})


def log_controls(spark: SparkSession, path: str, controls: Sequence[Control]) -> None:
    """Append the control totals: a row per report with its row count, and one per summed column."""
    rows = [(c.report, None, c.rows, None) for c in controls]
    rows += [(c.report, column, None, total) for c in controls for column, total in c.sums.items()]
    log = spark.createDataFrame(rows, "report string, column_name string, row_cnt long, total decimal(38,8)")
    log.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def write_table(df: DataFrame, path: str, sort: Sequence = (), partition_by: Sequence[str] = ()) -> None:
    """Parquet output.  ``sort`` orders rows within the files, not across them."""
    out = df.sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|", sort: Sequence = ()) -> None:
    """Delimited text with a header; with ``sort`` in that order over all files."""
    out = df.orderBy(*sort) if sort else df
    out.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def refresh_log(spark: SparkSession, path: str, datasets: Sequence[tuple[str, str, str]]) -> None:
    """Append (dashboard, dataset, workbook) rows with the time of the refresh."""
    log = spark.createDataFrame(list(datasets), "dashboard string, dataset string, workbook string")
    log.withColumn("refreshed_at", F.current_timestamp()).write.mode("append").parquet(path)
