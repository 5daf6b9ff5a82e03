"""Arrivals made distinct while they stream in.

The batch refresh compares a month with what the mart holds.  Here each table
is a stream of its own that remembers, in Spark's state store, the rows it has
passed on: a row seen again adds nothing, and a micro-batch reads its own files
and the state, no table and no earlier file.  Event time is when a row's file
landed, so rows without a date are remembered like the others; a row is
forgotten ``horizon`` after the latest landing that was seen, and only then
could a repeat pass.  State is dealt by all columns of the row, so no key is
hot.

The fact and the person table remember every row: their state lies on disk, in
RocksDB, with memory of one size for each executor (``STATE_ON_DISK``; what the
session has set itself counts).  The dates are few and stay in memory.

The tables are written by Spark's file sink, whose log makes every micro-batch
count exactly once; read them with ``spark.read.parquet``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.functions.dates import calendar_columns, sas_day_to_date
from portmart.operators.mart import FACT_COLUMNS, PERSON_COLUMNS, TIME_COLUMNS
from portmart.operators.staging import arrival_columns
from portmart.sources.readers import ARRIVALS_SCHEMA
from portmart.streaming.refresh import checkpoint_path

HORIZON = "400 days"
LANDED = "landed_at"
# Tables whose state grows with their rows, and how it is kept.
GROWING = ("immigration", "immigrant")
_STORE = "spark.sql.streaming.stateStore"
STATE_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "1000",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def landed_arrivals(
    spark: SparkSession, landing_dir: str, fmt: str = "parquet", max_files_per_batch: int | None = None
) -> DataFrame:
    """The arrival files as a stream of staging columns and the landing time."""
    reader = spark.readStream.format(fmt).schema(ARRIVALS_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    rows = reader.load(landing_dir).select("*", F.col("_metadata.file_modification_time").alias(LANDED))
    rows = rows.withColumn("arrdate", sas_day_to_date("arrdate"))
    return rows.select(*arrival_columns(), LANDED)


def seen_once(rows: DataFrame, columns: list[str], horizon: str = HORIZON) -> DataFrame:
    """Each row of ``columns`` once, as long as it is remembered."""
    held = rows.select(*columns, LANDED).withWatermark(LANDED, horizon)
    return held.dropDuplicatesWithinWatermark(columns).select(*columns)


def distinct_tables(landed: DataFrame, horizon: str = HORIZON) -> dict[str, DataFrame]:
    """The streams of the tables that the arrivals feed."""
    staging = [c for c in landed.columns if c != LANDED]
    time = seen_once(landed, ["date"], horizon)
    time = time.select("date", *[c.alias(n) for n, c in calendar_columns("date").items()]).select(*TIME_COLUMNS)
    return {
        "immigration": seen_once(landed, FACT_COLUMNS, horizon),
        "immigrant": seen_once(landed, staging, horizon).select(*PERSON_COLUMNS),
        "time": time,
    }


@contextmanager
def unless_set(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` for what starts inside, where the session has none."""
    ours = [k for k in settings if spark.conf.get(k, None) is None]
    for k in ours:
        spark.conf.set(k, settings[k])
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def stream_arrivals(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    horizon: str = HORIZON,
    fmt: str = "parquet",
    max_files_per_batch: int | None = None,
) -> int:
    """Add the rows of every file not processed before to the fact, person
    and time tables under ``output_dir``; returns the number of micro-batches
    of the fact table."""
    landed = landed_arrivals(spark, landing_dir, fmt, max_files_per_batch)
    queries = {}
    for name, table in distinct_tables(landed, horizon).items():
        writer = (
            table.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint_path(output_dir, landing_dir, f"distinct-{name}"))
            .option("path", os.path.join(output_dir, name))
            .trigger(availableNow=True)
        )
        # A query takes the session's settings as they are when it starts.
        with unless_set(spark, STATE_ON_DISK if name in GROWING else {}):
            queries[name] = writer.start()
    for query in queries.values():
        query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in queries["immigration"].recentProgress)
