"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from portmart.functions.casts import lenient_float, lenient_long
from portmart.functions.dates import (
    calendar_columns,
    iso_date_text,
    sas_day_to_date,
)
from portmart.functions.numeric import percentage, round2
from portmart.functions.text import contains_ci

__all__ = [
    "calendar_columns",
    "contains_ci",
    "iso_date_text",
    "lenient_float",
    "lenient_long",
    "percentage",
    "round2",
    "sas_day_to_date",
]
