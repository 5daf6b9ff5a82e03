"""Staging tables: renamed, rounded, distinct projections of the clean
sources.  The column names are fixed values, as published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.functions.numeric import round2
from portmart.operators.cleaning import RACE_COLUMNS


def arrival_columns() -> list[Column]:
    """The staging columns of clean arrivals."""
    return [
        F.col("cicid").alias("id"),
        F.col("arrdate").alias("date"),
        F.col("i94port").alias("city_code"),
        F.col("i94addr").alias("state_code"),
        F.col("i94bir").alias("age"),
        F.col("gender"),
        F.col("i94visa").alias("visa_type"),
        F.col("count"),
    ]


def stage_arrivals(df: DataFrame, *also: str) -> DataFrame:
    """``also``: columns to keep that follow from the others."""
    return df.select(*arrival_columns(), *also).distinct()


def stage_temperature(df: DataFrame) -> DataFrame:
    return df.select(
        F.try_to_date("dt").alias("date"),
        F.col("year"),
        F.col("month"),
        F.col("city_code"),
        F.col("City").alias("city_name"),
        round2("AverageTemperature").alias("avg_temperature"),
        round2("AverageTemperatureUncertainty").alias("avg_temperature_uncertainty"),
        F.col("Latitude").alias("lat"),
        F.col("Longitude").alias("long"),
    ).distinct()


def stage_demographics(
    df: DataFrame, races: Mapping[str, str] = RACE_COLUMNS
) -> DataFrame:
    return df.select(
        F.col("City").alias("city_name"),
        F.col("city_code"),
        F.col("State").alias("state_name"),
        F.col("State Code").alias("state_code"),
        round2("Median Age").alias("median_age"),
        F.col("Male Population").alias("male_pop"),
        F.col("Female Population").alias("female_pop"),
        F.col("Total Population").alias("total_pop"),
        F.col("Number of Veterans").alias("veterans_count"),
        F.col("Foreign-born").alias("foreign_born_count"),
        round2("Average Household Size").alias("avg_household_size"),
        *[F.col(f"`{race}`").alias(out) for race, out in races.items()],
    ).distinct()
