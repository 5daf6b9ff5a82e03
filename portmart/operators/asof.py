"""As-of join: each row with the latest reading of its key on or before its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portmart.session import materialize


def latest_readings(readings: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """One row per key and time; of several readings at one time the
    greatest, values compared in their order, nulls least."""
    best = F.max(F.struct(*values)).alias("_best")
    return readings.where(F.col(at).isNotNull()).groupBy(*keys, at).agg(best).select(*keys, at, *[F.col(f"_best.{v}") for v in values])


def asof_join(
    rows: DataFrame,
    readings: DataFrame,
    keys: list[str],
    at: str,
    values: list[str],
    slice_width: Column,
) -> DataFrame:
    """``rows`` with ``values`` and ``reading_at`` of the latest reading of the
    same key at or before the row's ``at``.

    ``slice_width`` is an expression of ``at`` that grows with it and cuts the
    time into slices (a year, say); ``at`` is a date or a timestamp in both.
    A slice of a key is one window group, so a hot key is spread over its
    slices.  The last reading of a slice is carried to the key's later slices:
    this table has one row for each key and slice, and within it the window
    over the slices of a key is short.  Rows meet readings in one shuffle on key and
    slice, and repeated rows are counted, not paired.

    Defined results: a row without a reading before it, with a null time or
    with a null in its key has null values; readings with a null time or key
    are ignored; of several readings at one time the greatest counts; repeated
    rows stay repeated.
    """
    own = "_"
    while any(c.startswith(own) for c in (*rows.columns, *readings.columns)):
        own += "_"
    time, cut, best, n, carried = (f"{own}{x}" for x in ("at", "slice", "reading", "n", "carried"))
    known = F.col(at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    latest = latest_readings(readings.where(known), keys, at, values)
    latest = latest.select(
        *keys, F.col(at).alias(time), slice_width.alias(cut), F.struct(F.col(at).alias("reading_at"), *values).alias(best)
    )

    # What the slices before a slice leave behind, for every slice in use.
    used = rows.where(known).select(*keys, slice_width.alias(cut)).distinct()
    ends = latest.groupBy(*keys, cut).agg(F.max_by(best, time).alias(best))
    slices = used.join(ends, [*keys, cut], "full_outer")
    before = Window.partitionBy(*keys).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*keys, cut, F.last(best, ignorenulls=True).over(before).alias(carried))
    slices = materialize(slices, "asof-slices").where(F.col(carried).isNotNull())

    # Rows that agree on key and time get the same reading: they pass as one.
    times = rows.where(known).groupBy(*keys, at).agg(F.count(F.lit(1)).alias(n))
    times = times.select(*keys, F.col(at).alias(time), slice_width.alias(cut), F.lit(None).cast(latest.schema[best].dataType).alias(best), n)
    both = times.unionByName(latest.withColumn(n, F.lit(0).cast("long")))
    upto = Window.partitionBy(*keys, cut).orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(best, F.last(best, ignorenulls=True).over(upto)).where(F.col(n) > 0)
    found = found.join(slices, [*keys, cut], "left").select(*keys, time, F.coalesce(best, carried).alias(best))
    found = materialize(found.where(F.col(best).isNotNull()), "asof-found")

    side = found.select(*[F.col(k).alias(f"{own}{i}") for i, k in enumerate(keys)], time, best)
    on = F.col(at) == F.col(time)
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"{own}{i}"))
    return rows.join(side, on, "left").select(
        *[F.col(c) for c in rows.columns], F.col(f"{best}.reading_at").alias("reading_at"), *[F.col(f"{best}.{v}").alias(v) for v in values]
    )
