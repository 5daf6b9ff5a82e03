"""Readers and writers."""

from portmart.sources.labels import label_table, read_label_lines, read_label_table
from portmart.sources.readers import (
    ARRIVALS_SCHEMA,
    DEMOGRAPHICS_SCHEMA,
    TEMPERATURE_SCHEMA,
    read_arrivals,
    read_delimited,
    read_demographics,
    read_temperature,
    register_view,
)
from portmart.sources.sinks import read_partitioned, write_partitioned, write_table

__all__ = [
    "ARRIVALS_SCHEMA",
    "DEMOGRAPHICS_SCHEMA",
    "TEMPERATURE_SCHEMA",
    "label_table",
    "read_arrivals",
    "read_delimited",
    "read_demographics",
    "read_label_lines",
    "read_label_table",
    "read_partitioned",
    "read_temperature",
    "register_view",
    "write_partitioned",
    "write_table",
]
