"""Schema contracts: what an extract's columns become, and what in it doesn't fit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import float_id, money, parse_date, translate

# What a value becomes, by the word in the contract.
KINDS: dict[str, Callable[[Column], Column]] = {
    "text": lambda c: c.cast("string"),
    "date": parse_date,
    "money": money,
    "whole": lambda c: c.try_cast("double").try_cast("bigint").cast("string"),
    "id": float_id,
    "code": lambda c: F.regexp_replace(c.cast("string"), "^0+", ""),
    "test": lambda c: translate(c, rules.TEST_LABELS),
}


@dataclass(frozen=True)
class Field:
    """A column of an extract: its name there, its name here, and what its values become."""

    source: str
    name: str
    kind: str = "text"


class Contract(NamedTuple):
    """Typed rows, the columns that the extract lacks or has beyond the contract, and what the rows' pass counts."""

    rows: DataFrame
    missing: list[str]
    extra: list[str]
    seen: Observation

    def misfits(self) -> dict[str, int]:
        """Values by column that their kind can't hold; waits for the pass that writes or collects the rows."""
        return {name.removeprefix("bad_"): n for name, n in self.seen.get.items() if name != "rows" and n}


def apply_contract(df: DataFrame, fields: Sequence[Field]) -> Contract:
    """The contract's columns in its order.  A missing one is NULL throughout; values that don't fit are NULL.

    Values that don't fit are counted by the pass that writes the rows, so a load reads the extract once; an order by
    ranges above them would read, and count, them twice.  Names compare exactly.  Blank text counts as missing, not as a misfit.
    """
    have = set(df.columns)
    typed, bad = [], []
    for f in fields:
        source = F.col(f"`{f.source}`") if f.source in have else F.lit(None).cast("string")
        value = KINDS[f.kind](source)
        typed.append(value.alias(f.name))
        if f.source in have:
            filled = source.isNotNull() & (F.trim(source.cast("string")) != "")
            zero = F.coalesce(source.try_cast("double") == 0, F.lit(False)) if f.kind == "id" else F.lit(False)
            bad.append(F.sum((filled & ~zero & value.isNull()).cast("long")).alias(f"bad_{f.source}"))
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *bad).select(*typed)
    return Contract(rows, [f.source for f in fields if f.source not in have],
                    [c for c in df.columns if c not in {f.source for f in fields}], seen)
