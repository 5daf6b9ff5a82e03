"""Dimension and fact tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

from portmart.functions.dates import calendar_columns
from portmart.operators.cleaning import RACE_COLUMNS
from portmart.operators.joins import join_using_distinct

# The published column names of the star schema, in their order.
FACT_COLUMNS = ["id", "state_code", "city_code", "date", "count"]
PERSON_COLUMNS = ["id", "age", "gender", "visa_type"]
TIME_COLUMNS = ["date", "day", "month", "year", "weekday", "week"]
CITY_METRIC_COLUMNS = [
    "date",
    "city_code",
    "year",
    "month",
    "avg_temperature",
    "avg_temperature_uncertainty",
]
CITY_COLUMNS = [
    "city_code",
    "state_code",
    "city_name",
    "state_name",
    "median_age",
    "male_pop",
    "female_pop",
    "total_pop",
    "veterans_count",
    "foreign_born_count",
    "avg_household_size",
    *RACE_COLUMNS.values(),
    "lat",
    "long",
]


def fact_table(staging_arrivals: DataFrame, *also: str) -> DataFrame:
    """``also``: columns to keep that follow from the others."""
    return staging_arrivals.select(*FACT_COLUMNS, *also).distinct()


def dim_person(staging_arrivals: DataFrame) -> DataFrame:
    """One row per distinct staging row: an id seen with two different
    dates or ports appears twice (no dedup of its own)."""
    return staging_arrivals.select(*PERSON_COLUMNS)


def calendar_dim(staging_arrivals: DataFrame) -> DataFrame:
    """Distinct arrival dates with their calendar parts; a null date gives
    one all-null row."""
    return (
        staging_arrivals.select("date")
        .distinct()
        .select("date", *[c.alias(n) for n, c in calendar_columns("date").items()])
        .select(*TIME_COLUMNS)
    )


def dim_city_metric(staging_temperature: DataFrame) -> DataFrame:
    return staging_temperature.select(*CITY_METRIC_COLUMNS).distinct()


def dim_city(staging_demographics: DataFrame, staging_temperature: DataFrame) -> DataFrame:
    """Demographics joined to temperature coordinates on the port code.

    Every demographics row meets every distinct (lat, long) of its code;
    the temperature side is reduced to those distinct triples first.
    """
    demo_cols = [c for c in CITY_COLUMNS if c not in ("lat", "long")]
    return join_using_distinct(
        staging_demographics,
        staging_temperature,
        on=["city_code"],
        right_columns=["lat", "long"],
        left_columns=demo_cols,
    ).select(*CITY_COLUMNS)
