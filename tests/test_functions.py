import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimtide import functions as C, rules
from helpers import values

D = dt.date


def one(df, **columns):
    row = df.limit(1).select(*[c.alias(n) for n, c in columns.items()]).collect()[0]
    return row.asDict()


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def test_dates(unit):
    lit = F.lit
    got = one(unit,
              ok=C.parse_date(lit("20170101")), bad=C.parse_date(lit("2017-13-99")), null=C.parse_date(lit(None)),
              floated=C.parse_float_date(lit("20170101.0")), month=C.parse_month(lit("201701"), "yyyyMM"),
              upper=C.parse_month(lit("FEB 2016")), mixed=C.parse_month(lit("Feb 2016")),
              text=C.parse_month(lit("soon")), stamp=C.parse_datetime(lit("20170102"), lit("03:04:05")),
              days=C.days_between(lit(D(2017, 1, 1)), lit(D(2017, 1, 11))),
              nodays=C.days_between(lit(D(2017, 1, 1)), lit(None).cast("date")),
              label=C.period_label(lit(D(2016, 2, 1)), upper=True))
    assert got == {
        "ok": D(2017, 1, 1), "bad": None, "null": None, "floated": D(2017, 1, 1), "month": D(2017, 1, 1),
        "upper": D(2016, 2, 1), "mixed": D(2016, 2, 1), "text": None, "stamp": dt.datetime(2017, 1, 2, 3, 4, 5),
        "days": 10, "nodays": None, "label": "FEB 2016"}


def test_strict_date_raises(unit):
    with pytest.raises(Exception):
        one(unit, x=C.parse_date(F.lit("nonsense"), strict=True))


def test_month_begin_rolls_back(unit):
    got = one(unit, first=C.month_begin_before(F.lit(D(2017, 3, 1))), mid=C.month_begin_before(F.lit(D(2017, 3, 15))))
    assert got == {"first": D(2017, 2, 1), "mid": D(2017, 3, 1)}


def test_ids_and_numbers(unit):
    got = one(unit, a=C.float_id(F.lit(123.0)), text=C.float_id(F.lit("12.0")), zero=C.float_id(F.lit(0.0)),
              null=C.float_id(F.lit(None).cast("double")), even=C.half_even(F.lit(Decimal("0.125"))),
              z=C.zero_to_null(F.lit(0)), nz=C.zero_to_null(F.lit(3)), flip=C.flip_sign(F.lit(0.0)),
              flipped=C.flip_sign(F.lit(-2.5)), blank=C.zero_to_blank(F.lit(0)), money=C.money(F.lit("1.255")),
              bad=C.money(F.lit("x")), total=C.row_sum([F.lit(1), F.lit(None).cast("int"), F.lit(2)]))
    assert got == {"a": "123", "text": "12", "zero": None, "null": None, "even": Decimal("0.12"), "z": None, "nz": 3,
                   "flip": 0.0, "flipped": 2.5, "blank": "", "money": Decimal("1.26"), "bad": None, "total": 3}
    assert str(got["flip"]) == "0.0"


def test_text(unit):
    got = one(unit, label=C.label(F.lit("Plan"), F.lit(7)), half=C.label(F.lit("Plan"), F.lit(None)),
              name=C.label_name(F.lit("Plan A (P7)")), id=C.label_id(F.lit("Plan A (P7)")),
              noid=C.label_id(F.lit("Plan A")), stripped=C.strip_leading_zeros(F.lit("0070")),
              many=C.split_multi(F.lit("A;B")), none=C.split_multi(F.lit("")), null=C.split_multi(F.lit(None)),
              test=C.translate(F.lit("GLP"), rules.TEST_LABELS), other=C.translate(F.lit("ZZ"), rules.TEST_LABELS),
              unknown=C.translate(F.lit("ZZ"), rules.TEST_LABELS, keep_unknown=False))
    assert got == {"label": "Plan (7)", "half": None, "name": "Plan A", "id": "P7", "noid": None, "stripped": "70",
                   "many": ["A", "B"], "none": None, "null": None, "test": "Prostate", "other": "ZZ", "unknown": None}


def test_every_test_label(frame):
    from claimtide.operators.standardise import translate_test_code
    df = frame("test string", *[(c,) for c in [*rules.TEST_LABELS, "X"]], (None,))
    assert values(translate_test_code(df)) == sorted([*[(v,) for v in rules.TEST_LABELS.values()], ("X",), (None,)], key=repr)
