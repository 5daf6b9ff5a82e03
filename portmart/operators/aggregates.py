"""Distinct, counting and grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def count_distinct(df: DataFrame, column: str, alias: str = "n_distinct") -> DataFrame:
    """Exact number of distinct non-null values, as a one-row frame."""
    return df.agg(F.count_distinct(F.col(column)).alias(alias))


def count_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def group_count(df: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    """Rows per group; null keys form their own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
