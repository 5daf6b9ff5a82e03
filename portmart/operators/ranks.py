"""Ranks with ties over a whole table, and the rank correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portmart.session import materialize


def mid_ranks(df: DataFrame, column: str, into: str) -> DataFrame:
    """``df`` with ``into``, the rank of ``column`` from 1, ties sharing the mean
    of their places; a null has no rank, NaN ranks above every number.

    The distinct values are counted first (partial sums, so a value that a third
    of the rows hold is one row) and range-partitioned; a partition starts at the
    sum of the partitions before it.  The only window without a key runs over one
    row for each partition.
    """
    own = "_"
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    v, n, part, start = (f"{own}{x}" for x in ("value", "n", "part", "start"))
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(v)).agg(F.count(F.lit(1)).alias(n))
    counts = materialize(counts.orderBy(v).withColumn(part, F.spark_partition_id()), "rank-values")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy(part).agg(F.sum(n).alias(n)).select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(start))
    inside = Window.partitionBy(part).orderBy(v).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col(start) + F.coalesce(F.sum(n).over(inside), F.lit(0))
    ranks = counts.join(starts, part).select(v, (before + (F.col(n) + 1) / F.lit(2.0)).alias(into))
    ranks = materialize(ranks, "ranks")
    return df.join(ranks, F.col(column) == F.col(v), "left").drop(v)


def rank_correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    """Spearman's correlation: Pearson's over the mid-ranks of the rows in which
    both columns have a value.  One row; null where a column is constant or
    fewer than two rows have both.

    Twice a mid-rank is a whole number, so the sums are exact (decimals) and do
    not depend on the order in which partitions arrive (up to 10**12 rows).
    """
    pairs = df.select(F.col(left).alias("x"), F.col(right).alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    ranked = mid_ranks(mid_ranks(materialize(pairs, "rank-pairs"), "x", "rx"), "y", "ry")
    whole = ranked.select(*[(F.col(c) * 2).cast("decimal(19,0)").alias(c) for c in ("rx", "ry")])
    total = lambda c: F.sum(c).cast("double")
    sums = whole.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        total(F.col("rx")).alias("x"),
        total(F.col("ry")).alias("y"),
        total(F.col("rx") * F.col("rx")).alias("xx"),
        total(F.col("ry") * F.col("ry")).alias("yy"),
        total(F.col("rx") * F.col("ry")).alias("xy"),
    )
    cov = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    spread = F.sqrt(F.col("xx") - F.col("x") * F.col("x") / F.col("n")) * F.sqrt(F.col("yy") - F.col("y") * F.col("y") / F.col("n"))
    return sums.select(F.when((F.col("n") > 1) & (spread > 0), cov / spread).alias("rank_corr"))
