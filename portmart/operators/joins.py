"""Joins of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_using_distinct(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    right_columns: Sequence[str],
    left_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct rows of ``left[left_columns] + right[right_columns]`` over the
    inner equi-join on ``on``.

    The right side is reduced to its distinct ``on + right_columns`` before
    joining: the result is the same as joining and then deduplicating, but
    a key repeated many times on the right meets the left side once per
    distinct value instead of once per row.
    """
    on = list(on)
    slim = right.select(*on, *[c for c in right_columns if c not in on]).distinct()
    out = left.join(slim, on, "inner")
    cols = list(left_columns) if left_columns is not None else list(left.columns)
    cols += [c for c in right_columns if c not in cols]
    return out.select(*cols).distinct()


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_alias: str = "l",
    right_alias: str = "r",
) -> DataFrame:
    """Inner join on several equal columns keeping both copies of the keys;
    refer to them as ``F.col('<alias>.<name>')``."""
    a, b = left.alias(left_alias), right.alias(right_alias)
    cond = [F.col(f"{left_alias}.{k}") == F.col(f"{right_alias}.{k}") for k in keys]
    return a.join(b, cond, "inner")

