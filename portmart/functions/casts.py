"""Lenient text -> number casts.

The sources are text files whose numbers were cast with the non-ANSI rules:
unparsable text became null and decimals were truncated into integers.
Spark's ANSI mode raises instead, so these use ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from portmart.functions._col import as_col


def lenient_float(c: Column | str) -> Column:
    """Text -> FLOAT; null when the text is not a number."""
    return as_col(c).try_cast("float")


# A plain number: sign, digits and at most one point, digits on either side.
PLAIN_NUMBER = r"^\s*([+-]?)([0-9]*)(?:\.([0-9]*))?\s*$"


def lenient_long(c: Column | str) -> Column:
    """Text -> BIGINT, the fraction cut off whatever its length ('12.7' and
    '12.9999999' -> 12, '-12.7' -> -12, '.5' -> 0); blanks, words, exponents
    ('1e3') and out-of-range values give null."""
    text = as_col(c).cast("string")
    whole, fraction = (F.regexp_extract(text, PLAIN_NUMBER, i) for i in (2, 3))
    number = F.when(F.length(whole) > 0, whole).when(F.length(fraction) > 0, F.lit("0"))
    return F.concat(F.regexp_extract(text, PLAIN_NUMBER, 1), number).try_cast("bigint")
