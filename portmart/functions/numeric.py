from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from portmart.functions._col import as_col


def round2(c: Column | str) -> Column:
    """Round half up to two decimals; a FLOAT stays FLOAT."""
    return F.round(as_col(c), 2)


def percentage(part: Column | str, whole: Column | str) -> Column:
    """part / whole * 100 as DOUBLE; null where whole is 0 or null."""
    return F.try_divide(as_col(part), as_col(whole)) * F.lit(100)
