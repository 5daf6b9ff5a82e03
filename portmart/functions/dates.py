"""SAS day numbers and calendar parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from portmart.functions._col import as_col

# Fixed value: SAS counts days from this date.
SAS_EPOCH = _dt.date(1960, 1, 1)

# Day offsets that still land inside the representable calendar
# (0001-01-01 .. 9999-12-31); anything outside becomes null.
_MIN_DAYS = (_dt.date.min - SAS_EPOCH).days
_MAX_DAYS = (_dt.date.max - SAS_EPOCH).days


def sas_day_to_date(c: Column | str) -> Column:
    """SAS day number -> DATE.

    Null, 0 and NaN give null (they are "false-y" or not a number); a
    fractional day keeps the calendar day it falls in (floor, so -0.5 is the
    day before the epoch); days outside the calendar give null.
    """
    x = as_col(c).cast("double")
    days = F.floor(x)
    usable = (x != 0) & ~F.isnan(x) & days.between(_MIN_DAYS, _MAX_DAYS)
    return F.when(usable, F.date_add(F.lit(SAS_EPOCH), days.cast("int")))


def iso_date_text(c: Column | str) -> Column:
    """DATE -> 'yyyy-MM-dd' text."""
    return F.date_format(as_col(c), "yyyy-MM-dd")


def calendar_columns(c: Column | str) -> dict[str, Column]:
    """The calendar parts of the time dimension, keyed by output name.

    weekday counts Sunday as 1; week is the ISO week of the year.
    """
    d = as_col(c)
    return {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "year": F.year(d),
        "weekday": F.dayofweek(d),
        "week": F.weekofyear(d),
    }
