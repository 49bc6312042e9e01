"""Column helpers shared by the operators.  All are plain Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# dates ---------------------------------------------------------------------

def parse_date(c, fmt: str = "yyyyMMdd", strict: bool = False) -> Column:
    """Text to date.  Bad text gives NULL, or an error when ``strict``."""
    c = as_col(c).cast("string")
    return F.to_date(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def parse_float_date(c) -> Column:
    """Dates that were rendered as floats, such as ``20170101.0``."""
    return parse_date(c, "yyyyMMdd.0")


def parse_month(c, fmt: str = "MMM yyyy") -> Column:
    """``Feb 2016`` / ``FEB 2016`` (or ``yyyyMM`` text) to the first of the month."""
    c = as_col(c).cast("string")
    return parse_date(F.initcap(F.trim(c)) if "MMM" in fmt else c, fmt)


def parse_datetime(date, time) -> Column:
    text = F.concat(as_col(date).cast("string"), F.lit(" "), as_col(time).cast("string"))
    return F.try_to_timestamp(text, F.lit("yyyyMMdd HH:mm:ss"))


def period_label(d, upper: bool = False) -> Column:
    text = F.date_format(as_col(d), "MMM yyyy")
    return F.upper(text) if upper else text


def days_between(start, end) -> Column:
    """Days from start to end, NULL when either is missing."""
    return F.datediff(as_col(end), as_col(start))


def month_begin_before(d) -> Column:
    """Roll back to a month begin: the 1st goes a full month back."""
    d = as_col(d)
    return F.when(F.dayofmonth(d) == 1, F.add_months(d, -1)).otherwise(F.trunc(d, "month"))


# numbers and ids -----------------------------------------------------------

def money(c) -> Column:
    return as_col(c).try_cast(MONEY)


def float_id(c) -> Column:
    """An id that was read as a float: ``123.0`` -> ``'123'``; 0 and NULL -> NULL."""
    text = as_col(c).try_cast("double").try_cast("bigint").cast("string")
    return F.nullif(text, F.lit("0"))


def zero_to_null(c) -> Column:
    c = as_col(c)
    return F.when(c != 0, c)


def null_to_zero(c) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def zero_to_blank(c) -> Column:
    """Display form: 0 becomes an empty string.  For writers only."""
    c = as_col(c)
    return F.when(c == 0, F.lit("")).otherwise(c.cast("string"))


def flip_sign(c) -> Column:
    """Negate; zero stays an unsigned zero also for floating point columns."""
    c = as_col(c)
    return F.when(c != 0, -c).otherwise(c)


def row_sum(cols: Sequence) -> Column:
    """Sum across columns with NULL counted as 0."""
    return reduce(lambda a, b: a + b, [null_to_zero(c) for c in cols])


def half_even(c, scale: int = 2) -> Column:
    return F.bround(as_col(c), scale)


# text ----------------------------------------------------------------------

def label(name, id_) -> Column:
    """``Name (ID)``; NULL when either part is missing."""
    return F.concat(as_col(name).cast("string"), F.lit(" ("), as_col(id_).cast("string"), F.lit(")"))


def label_name(c) -> Column:
    return F.trim(F.split_part(as_col(c), F.lit("("), F.lit(1)))


def label_id(c) -> Column:
    """The id inside ``Name (ID)``; NULL when the label has no bracket."""
    c = as_col(c)
    inner = F.split_part(F.split_part(c, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))
    return F.when(c.contains("("), inner)


def strip_leading_zeros(c) -> Column:
    return F.regexp_replace(as_col(c), "^0+", "")


def blank_to_null(c) -> Column:
    c = as_col(c)
    return F.when(c != "", c)


def split_multi(c, sep: str = ";") -> Column:
    """Multi-select text to an array; NULL or blank text to a NULL array."""
    return F.split(blank_to_null(c), re.escape(sep))


def snake(text: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", text.lower()).strip("_")


# lookups and conditions ----------------------------------------------------

def translate(c, mapping: Mapping[str, str], keep_unknown: bool = True) -> Column:
    """Look values up in a dictionary; unknown values pass through or become NULL."""
    c = as_col(c)
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return F.coalesce(found, c) if keep_unknown else found


def true_only(cond: Column) -> Column:
    """A condition with NULL read as false."""
    return F.coalesce(cond, F.lit(False))


def differs(a, b) -> Column:
    return ~as_col(a).eqNullSafe(as_col(b))


def first_match(branches: Iterable[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Ordered case expression: the first true branch wins."""
    branches = list(branches)
    case = F.when(*branches[0])
    for cond, value in branches[1:]:
        case = case.when(cond, value)
    return case if default is None else case.otherwise(default)
