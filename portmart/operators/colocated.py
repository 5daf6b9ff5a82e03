"""Tables bucketed on one key, so that joins on it shuffle neither side.

The rows are first reduced to distinct combinations of the wanted columns
with their number, summed on the map side before anything is shuffled.  A
key that holds a large share of the rows is thus spread over its different
combinations and reaches its bucket as that many rows, however often each
occurs; joining multiplies the numbers instead of pairing the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "join_key"
NUMBER = "n_rows"


def _key(df: DataFrame, name: str) -> Column:
    """The key as a join compares it.  Spark normalises floating-point join
    keys, which hides that they are bucketed; their text compares alike
    (adding 0.0 makes -0.0 the same as 0.0, every NaN reads ``NaN``)."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return (column + F.lit(0.0)).cast("string")
    return column


def write_bucketed(df: DataFrame, path: str, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """Write the distinct combinations of ``key`` (as ``join_key``) and
    ``columns`` of ``df``, with their number of rows ``n_rows``, bucketed on
    the key, and return the written table.

    Two shuffles are paid once, here: the first is combined on the map side
    and deals a hot key over its combinations, the second deals the distinct
    rows to their buckets (one file each).  A null key is kept in the table.
    """
    clash = {KEY, NUMBER} & {c.lower() for c in columns}
    if clash:
        raise ValueError(f"columns may not be named {sorted(clash)}")
    counted = df.select(_key(df, key).alias(KEY), *[F.col(f"`{c}`") for c in columns]).groupBy(
        KEY, *[f"`{c}`" for c in columns]
    ).agg(F.count(F.lit(1)).alias(NUMBER))
    name = _table_name()
    (
        counted.repartition(buckets, KEY)
        .write.option("path", path)
        .bucketBy(buckets, KEY)
        .format("parquet")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    """A table that an earlier application wrote with ``write_bucketed``
    (``schema`` as written, the same number of buckets)."""
    name = _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def _table_name() -> str:
    return f"portmart_{uuid.uuid4().hex}"


def joined_counts(left: DataFrame, right: DataFrame, by: Sequence[Column], out: str = "count") -> DataFrame:
    """Number of row pairs with equal keys per ``by`` (columns of the aliases
    ``l`` and ``r``): every left row meets every right row of its key, a null
    key meets nothing.  With both tables bucketed alike neither is shuffled
    for the join; what is left to shuffle are partial sums per group."""
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{KEY}") == F.col(f"r.{KEY}"))
    return j.groupBy(*by).agg(F.sum(F.col(f"l.{NUMBER}") * F.col(f"r.{NUMBER}")).alias(out))
