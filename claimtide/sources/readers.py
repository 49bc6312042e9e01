"""Extracts: database queries, snapshots, pipe-delimited files, reference tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

BOM = "﻿"
# Not a character in any text.
NO_CHARACTER = "\uffff"


def jdbc_options(url: str, query: str, partition_column: str | None = None, bounds: tuple | None = None,
                 partitions: int = 0, single_task: bool = False, fetch_size: int = 10_000, **options: str) -> dict[str, str]:
    """Options of a database read: ranges of ``partition_column``, or one task where that is asked for."""
    found = {"url": url, "fetchsize": str(fetch_size), **options}
    if single_task:
        return found | {"query": query}
    if partition_column is None or bounds is None or partitions < 1:
        raise ValueError("name a partition column with bounds and a number of partitions, or ask for a single task")
    # Range reads need a table expression in place of a query.
    return found | {"dbtable": f"({query}) q", "partitionColumn": partition_column, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}


def read_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A database query as a DataFrame; see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()


def load_snapshot(spark: SparkSession, path: str, pull: Callable[[], DataFrame] | None = None,
                  refresh: bool = False, schema: StructType | None = None) -> DataFrame:
    """Refresh the saved copy first when asked to; always read the copy.

    A refresh writes a new version beside the old ones and then names it in the folder's list of versions, which is the
    last thing that happens: if the pull or the write fails half-way, the version before holds, and a reader never sees
    a part of one.  Versions stay until they are deleted by hand.  A folder without a list is a plain copy.  Both ways give
    the same types: those of ``schema`` where given.
    """
    if refresh:
        df = pull()
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        last = snapshot_versions(spark, path)
        version = f"v{uuid.uuid4().hex}"
        df.write.parquet(f"{path}/{version}")
        _versions(spark, [(last[-1][0] + 1 if last else 1, version)]).write.mode("append").parquet(f"{path}/{VERSIONS}")
    versions = snapshot_versions(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/{versions[-1][1]}" if versions else path)


VERSIONS = "versions"


def _versions(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "number long, version string").coalesce(1)


def snapshot_versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and folders of the complete versions of a snapshot, oldest first; one row per refresh."""
    try:
        listed = spark.read.schema("number long, version string").parquet(f"{path}/{VERSIONS}").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r.number, r.version) for r in listed)


class Delimited(NamedTuple):
    """Rows of a delimited extract, and the lines that don't fit it."""

    kept: DataFrame
    rejected: DataFrame


def split_delimited(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = "|",
                    encoding: str = "ISO-8859-1", quoted: bool = True) -> Delimited:
    """Delimited text with a header: its rows, and the lines that have too many fields.

    Lines are read as text and their fields counted, a separator inside quote marks being part of its field.  A line
    has too many fields if any one behind the last column holds a value; separators at its end do no harm.  Lines with
    too few fields are padded with NULL, empty fields are NULL, and so is a value that its type in ``schema`` can't
    hold.  Without a schema every column is text.  ``quoted=False`` reads quote marks as data.  A byte order mark before
    the first header is removed.  What is kept does not depend on the columns that are asked for.

    ``rejected`` has the columns as text, ``more`` (what stands behind the last one), ``file``, ``record`` (number of
    the line in its file, from 1, without the header and blank lines), ``reason`` and the ``line``.
    """
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", True)
    if not quoted:
        reader = reader.option("quote", "")
    if schema is None:
        names = [c.strip() for c in reader.csv(path).columns]
        for mark in (BOM, BOM.encode("utf-8").decode("ISO-8859-1")):
            names[0] = names[0].removeprefix(mark)
    else:
        names = schema.names
    # One column and a separator that no text holds: whole lines, without each file's header and blank lines.
    lines = (spark.read.option("sep", NO_CHARACTER).option("quote", "").option("header", True)
             .option("enforceSchema", True).option("encoding", encoding).schema("line string").csv(path)
             .select("line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at")))
    apart = f"\\Q{sep}\\E"
    field = r'("(?:[^"\\]|\\.|"")*"[^%s]*|[^%s]*)' % (2 * (f"\\Q{sep}\\E",)) if quoted else f"([^{apart}]*)"
    fields = F.regexp_extract_all(F.concat(F.lit(sep), "line"), F.lit(apart + field), F.lit(1))
    beyond = F.slice(fields, len(names) + 1, F.greatest(F.size(fields) - len(names), F.lit(0)))
    options = {"sep": sep, "mode": "PERMISSIVE", **({} if quoted else {"quote": ""})}
    parsed = lines.select("*", F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(names))), options).alias("v"),
                          beyond.alias("beyond"))
    more = F.exists("beyond", lambda x: ~x.isin("", '""'))
    value = [F.when(F.col(f"v.c{i}") != "", F.col(f"v.c{i}")) for i in range(len(names))]
    kinds = [f.dataType for f in schema] if schema is not None else [StringType()] * len(names)
    kept = parsed.filter(~more).select(*[v.try_cast(kind).alias(n) for v, kind, n in zip(value, kinds, names)])
    # Lines are numbered by the blocks that a file is read in; only their counts meet.
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("start"))
    reason = F.concat(F.lit("more fields than columns: "), F.size("beyond") + len(names), F.lit(f" for {len(names)}"))
    rejected = parsed.filter(more).join(starts, ["file", "block"]).select(
        *[v.alias(n) for v, n in zip(value, names)], F.array_join("beyond", sep).alias("more"), "file",
        (F.col("at") + F.col("start")).alias("record"), reason.alias("reason"), "line")
    return Delimited(kept, rejected)


def read_delimited(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = "|",
                   encoding: str = "ISO-8859-1", quoted: bool = True) -> DataFrame:
    """The rows of ``split_delimited``."""
    return split_delimited(spark, path, schema, sep, encoding, quoted).kept


def read_reference(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A reference sheet exported as CSV or Parquet: trimmed headers, some columns."""
    df = (spark.read.parquet(path) if path.rstrip("/").endswith(".parquet")
          else spark.read.option("header", True).csv(path))
    df = df.toDF(*[c.removeprefix(BOM).strip() for c in df.columns])
    return df.select(*columns) if columns else df


def read_since(df: DataFrame, date_column: str, since: str) -> DataFrame:
    """Rows from a date on; the filter reaches the scan."""
    return df.filter(F.col(date_column) >= F.lit(since).cast("date"))


def order_case_extract(items: DataFrame, orders: DataFrame, accounts: DataFrame, cases: DataFrame,
                       groups: DataFrame, start: str, end: str,
                       case_types: tuple[str, ...] = ("Pre-Billing", "Missing Data")) -> DataFrame:
    """Order items of a date range with account, case and case owner.

    Orders without a case, and cases of the wanted types, are kept.  Key columns:
    items.order_id, orders.(order_id, account_id, start_dt), accounts.account_id,
    cases.(order_id, owner_id, case_type), groups.owner_id.
    """
    wanted = orders.filter(F.col("start_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    out = (items.join(wanted, "order_id", "inner")
           .join(accounts, "account_id", "left")
           .join(cases, "order_id", "left"))
    return (out.filter(F.col("case_type").isin(*case_types) | F.col("case_type").isNull())
            .join(groups, "owner_id", "left"))
