"""Parquet writers and the matching readers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portmart.operators.quality import observed
from portmart.operators.ranks import mid_ranks
from portmart.session import materialize

_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain parquet dataset; one file per task."""
    df.write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Parquet dataset in ``key=value`` folders.

    Rows are first rebalanced on the partition keys: each folder is
    written by few tasks (few files), and AQE splits a key that holds a
    large share of the rows over several tasks instead of one.  Without
    ``rebalance`` rows are written where they are: for those that lie together
    by the keys already.
    """
    rows = df.hint("rebalance", *keys) if rebalance else df
    rows.write.mode(mode).partitionBy(*keys).parquet(path)


def write_counted(df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "overwrite") -> int:
    """Write a plain or (with ``keys``) partitioned dataset and return the
    number of rows written, counted in the write: nothing is read again."""
    rows, seen = observed(df.hint("rebalance", *keys) if keys else df, "written")
    writer = rows.write.mode(mode)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return seen.get["records"]


def interleaved(parts: Sequence[Column], bits: int) -> Column:
    """One number from the lowest ``bits`` bits of each part, the parts taking
    turns from their highest bit down (a Z-order key)."""
    k = len(parts)
    if k * bits > 63:
        raise ValueError(f"{k} columns of {bits} bits do not fit a 64-bit key")
    taken = [
        F.shiftleft(F.shiftright(p.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), b * k + (k - 1 - i))
        for i, p in enumerate(parts)
        for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], n_files: int, bits: int = 10, mode: str = "overwrite"
) -> None:
    """Parquet dataset of about ``n_files`` files of equal numbers of rows,
    each a block in all of ``columns`` at once, so that the files' minimum and
    maximum exclude most of them for a filter on any of the columns.

    A value's place is its rank in the column (ties share one, nulls stand
    first), cut into ``2**bits`` steps: skewed values do not crowd into a few steps.
    The steps' bits are interleaved, and rows are range-partitioned by that key
    and then by a seeded draw, so that a key that a third of the rows share is
    spread over files.  An empty table is written with its schema.
    """
    if n_files < 1:
        raise ValueError("n_files must be 1 or more")
    names = df.columns
    own = "_"
    while any(c.startswith(own) for c in names):
        own += "_"
    rows = materialize(df, "cluster-rows")
    total = max(rows.count(), 1)
    ranked = rows
    for i, c in enumerate(columns):
        ranked = mid_ranks(ranked, c, f"{own}rank{i}")
    top = (1 << bits) - 1
    steps = [F.coalesce(F.least(F.floor(F.col(f"{own}rank{i}") * F.lit((top + 1) / total)), F.lit(top)), F.lit(0)) for i in range(len(columns))]
    keyed = ranked.withColumn(f"{own}key", interleaved(steps, bits)).withColumn(f"{own}draw", F.rand(7))
    placed = keyed.repartitionByRange(n_files, f"{own}key", f"{own}draw").sortWithinPartitions(f"{own}key")
    placed.select(*names).write.mode(mode).parquet(path)


def read_partitioned(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Read a partitioned dataset without guessing folder-value types.

    With ``schema`` (data and partition columns) every column gets its
    declared type.  Without it, folder values stay text: inference would
    turn codes such as ``060`` into the integer 60.  Inference is switched
    off for the duration of the listing (the partition schema is fixed
    when the relation is created).
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    before = spark.conf.get(_INFER, "true")
    spark.conf.set(_INFER, "false")
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(_INFER, before)
    return df
