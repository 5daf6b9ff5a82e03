"""Ordering and top-k.  Group keys are added as tie-breakers so that a
limit after the sort picks the same rows on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_desc(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    """Descending by ``metric``, nulls last, then ascending by ``ties``."""
    return df.orderBy(F.desc_nulls_last(metric), *[F.asc_nulls_last(t) for t in ties])


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``metric``.  Planned as
    TakeOrderedAndProject: each task keeps its own k best rows, so only
    k x tasks rows reach the final merge."""
    return order_by_desc(df, metric, ties).limit(k)
