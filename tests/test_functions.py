"""Scalar functions on hand-written values."""

import datetime as dt
import math

import pytest
from pyspark.sql import types as T

from portmart.functions import (
    calendar_columns,
    contains_ci,
    iso_date_text,
    lenient_float,
    lenient_long,
    percentage,
    round2,
    sas_day_to_date,
)


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_sas_day_to_date_edge_cases(spark):
    values = [None, 0.0, 0.4, -0.5, float("nan"), 20573.0, 1e12, 1e20, -1e20, 20573.99]
    got = [r[0] for r in _one_col(spark, values, T.DoubleType()).select(sas_day_to_date("x")).collect()]
    epoch = dt.date(1960, 1, 1)
    assert got == [
        None,  # null
        None,  # zero means no date
        epoch,  # fraction floors into the epoch day
        epoch - dt.timedelta(days=1),  # -0.5 floors to the day before
        None,  # NaN
        dt.date(2016, 4, 29),
        None,  # beyond the calendar
        None,
        None,
        dt.date(2016, 4, 29),
    ]


def test_sas_day_matches_python_timedelta(spark):
    days = [1.0, 365.25, 20000.7, -3650.2, 2.5]
    got = [r[0] for r in _one_col(spark, days, T.DoubleType()).select(sas_day_to_date("x")).collect()]
    want = [dt.date(1960, 1, 1) + dt.timedelta(d) for d in days]
    assert got == want


def test_iso_text_and_calendar(spark):
    df = _one_col(spark, [dt.date(2016, 4, 3), None], T.DateType())
    cal = calendar_columns("x")
    rows = df.select(iso_date_text("x").alias("t"), *[c.alias(n) for n, c in cal.items()]).collect()
    # 2016-04-03 is a Sunday (weekday 1) in ISO week 13.
    assert rows[0].asDict() == {"t": "2016-04-03", "day": 3, "month": 4, "year": 2016, "weekday": 1, "week": 13}
    assert all(v is None for v in rows[1])


def test_lenient_long(spark):
    values = ["12.7", "-12.7", "", "abc", "12345678901234567890", " 5 ", None, "42"]
    got = [r[0] for r in _one_col(spark, values, T.StringType()).select(lenient_long("x")).collect()]
    assert got == [12, -12, None, None, None, 5, None, 42]


def test_lenient_float(spark):
    values = ["1.5", "NaN", "", "x", None, " 2 "]
    got = [r[0] for r in _one_col(spark, values, T.StringType()).select(lenient_float("x")).collect()]
    assert got[0] == 1.5 and math.isnan(got[1]) and got[2:5] == [None, None, None] and got[5] == 2.0


def test_round2_half_up_and_float_stays_float(spark):
    df = _one_col(spark, [2.675, 1.005, 2.5], T.FloatType())
    out = df.select(round2("x").alias("r"))
    assert out.schema["r"].dataType == T.FloatType()
    got = [round(r[0], 4) for r in out.collect()]
    # 2.675f is 2.67499995..., so it rounds down.
    assert got == [2.67, 1.0, 2.5]
    d = _one_col(spark, [0.125, 2.675], T.DoubleType()).select(round2("x")).collect()
    assert [r[0] for r in d] == [0.13, 2.68]


def test_percentage_by_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (1, 4), (None, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(percentage("a", "b")).collect()]
    assert got == [None, 25.0, None]


@pytest.mark.parametrize(
    "hay,needle,want",
    [("Portland, ME", "portland", True), ("OTAY MESA", "Mesa", True), ("abc", "", True), ("abc", "x", False), (None, "a", None)],
)
def test_contains_ci(spark, hay, needle, want):
    df = spark.createDataFrame([(hay, needle)], "h string, n string")
    assert df.select(contains_ci("h", "n")).first()[0] == want


def test_lenient_long_cuts_any_fraction(spark):
    texts = ["12.9999999", "-12.9999999", "12.7", "-.9", "+7", " 5 ", "1e3", "", ".", "-", "abc", "1.2.3", "9" * 20, "7.", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", lenient_long("t").alias("v")).orderBy("i").collect()]
    assert got == [12, -12, 12, 0, 7, 5, None, None, None, None, None, None, None, 7, None]
