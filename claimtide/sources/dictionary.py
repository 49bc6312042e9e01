"""Column dictionaries: rename, type and project a raw extract by metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Type words of the dictionaries -> Spark types.
TYPE_WORDS = {
    "str": "string", "object": "string", "string": "string",
    "float": "decimal(18,2)", "float64": "decimal(18,2)", "money": "decimal(18,2)",
    "int": "int", "int64": "bigint", "date": "date", "datetime": "timestamp",
}


def apply_dictionary(df: DataFrame, entries: Iterable[Mapping], usage: str | None = None) -> DataFrame:
    """Select, cast and rename columns as a dictionary says.

    Entries: ``source``, ``name``, optional ``type`` and ``usages``.  Entries
    without a name are skipped; with ``usage`` only flagged ones are selected.
    The dictionary is schema metadata: one entry per column of the extract.
    """
    columns = []
    for e in entries:
        name = e.get("name")
        if not name or (usage is not None and usage not in (e.get("usages") or ())):
            continue
        c = F.col(f"`{e['source']}`")
        kind = e.get("type")
        if kind:
            c = c.try_cast(TYPE_WORDS.get(kind, kind))
        columns.append(c.alias(name))
    return df.select(*columns)
