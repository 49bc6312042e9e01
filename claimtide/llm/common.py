"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Upper-case A-Z to lower case; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text in UTF-8; ``bytes.split`` parts at exactly the six bytes above."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def word_count(text: Column | str) -> Column:
    """Words of a text; NULL has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("long")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a NULL id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts


def row_key(*columns: str) -> Column:
    """md5 of the columns' texts; NULL counts as empty, and only the last column's text may hold a stroke."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def framed(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value as text: no two rows of values are alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a written table: computed once, and lost executors cannot take it with them."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that is no column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def replace_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; input columns whose names clash (without case) give way to them."""
    clash = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in clash]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def running_total(df: DataFrame, groups: list[str], order: str, weight: str, name: str,
                  ties: tuple[str, ...] = ()) -> DataFrame:
    """Sum of ``weight`` over the rows that stand before a row in its group, as column ``name``.

    ``order`` holds lower-case hex digits of a hash.  Rows are dealt out by group and the first four digits, so
    that one group holding a third of all rows is still 65,536 small windows; their totals, at most that many rows
    a group, give each cell its offset.  The result depends on the rows alone, not on partitions.  Rows alike in
    ``order`` and ``ties`` must be alike in ``weight`` for a unique result.
    """
    cell, start = free_name(df, "_cell"), free_name(df, "_start")
    celled = df.withColumn(cell, F.substring(order, 1, 4))
    keys = [*groups, cell]
    inside = Window.partitionBy(*keys).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*groups).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    sums = celled.groupBy(*keys).agg(F.sum(weight).alias(start))
    offsets = sums.select(*keys, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    right = offsets.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], start)
    same = None
    for i, k in enumerate(keys):
        term = F.col(k).eqNullSafe(F.col(f"_r{i}"))
        same = term if same is None else same & term
    numbered = celled.withColumn(name, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return (numbered.join(right, same).withColumn(name, F.col(name) + F.col(start))
            .drop(cell, start, *[f"_r{i}" for i in range(len(keys))]))


def repeat_rows(df: DataFrame, copies: str, number: str, chunk: int = 4096) -> DataFrame:
    """Each row ``copies`` times, numbered from 0; expanded in two steps, so that no array grows with the count."""
    part = free_name(df, "_part")
    parts = df.filter(F.col(copies) > 0).withColumn(
        part, F.explode(F.sequence(F.lit(0).cast("long"), (F.col(copies) - 1).cast("long"), F.lit(chunk).cast("long"))))
    last = F.least(F.col(part) + chunk - 1, F.col(copies) - 1)
    return parts.withColumn(number, F.explode(F.sequence(F.col(part), last.cast("long")))).drop(part)
