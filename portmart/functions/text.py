from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.functions._col import as_col


def contains_ci(haystack: Column | str, needle: Column | str) -> Column:
    """Case-insensitive substring test; an empty needle is contained in
    every non-null text."""
    return F.contains(F.lower(as_col(haystack)), F.lower(as_col(needle)))


def substring_count(text: Column | str) -> Column:
    """Rows that ``explode_substrings`` makes of a text."""
    n = F.length(as_col(text)).cast("long")
    return F.floor(n * (n + 1) / 2).cast("long") + 1


def explode_substrings(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """One row per start and length of a substring of ``text_col`` (and one
    for the empty one), the text itself replaced by it.

    A text of n characters gives n (n + 1) / 2 + 1 rows, streamed and never
    held in one array: meant for short labels, quadratic for long texts.
    """
    others = [c for c in df.columns if c != text_col]
    n = F.length(text_col)
    lengths = df.select(*others, text_col, F.explode(F.sequence(F.lit(0), n)).alias("_k"))
    starts = F.when(F.col("_k") == 0, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), n - F.col("_k") + 1))
    at = lengths.select(*others, text_col, "_k", F.explode(starts).alias("_at"))
    return at.select(*others, F.substring(F.col(text_col), F.col("_at"), F.col("_k")).alias(out_col))
