"""Monthly refresh: each landed source file is processed exactly once.

The sources are published monthly; instead of re-running the whole batch, a
file-source stream with ``trigger(availableNow=True)`` picks up the files not
yet seen (its offsets live beside the mart), runs the batch operators on them
and appends what is new to every table the source feeds, in the layout the
batch wrote it in.  A schedule starts it; it stops by itself once the landing
folder is drained.

Each micro-batch is a plain DataFrame job, so the operators are the batch
ones.  Its new staging rows are found by a null-safe anti-join against the
staging table, of which only the dates of the batch are read.  They are
appended to the staging table last: a batch interrupted before that finds the
same new rows when it is replayed, and each table takes only the rows it does
not hold, so nothing is lost or appended twice.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portmart.operators.cleaning import clean_arrivals, clean_temperature
from portmart.operators.lookup import substring_codes
from portmart.operators.mart import calendar_dim, dim_city, dim_city_metric, dim_person, fact_table
from portmart.operators.staging import stage_arrivals, stage_temperature
from portmart.plans.pipeline import TABLE_FOLDERS, folder_keys, write_star_table
from portmart.session import materialize
from portmart.sources.labels import read_label_table
from portmart.sources.readers import ARRIVALS_SCHEMA, TEMPERATURE_SCHEMA
from portmart.sources.sinks import read_partitioned


def existing_table(
    spark: SparkSession, path: str, schema: StructType | None = None, keys: list[str] | None = None
) -> DataFrame | None:
    """The table written so far, or None if there is no such folder.  A
    folder whose layout has other keys than ``keys`` is refused: Spark would
    read either its files or its folders, never both."""
    try:
        df = read_partitioned(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if keys is not None and (one := df.select("_metadata.file_path").first()) is not None:
        found = re.findall(r"/([^/=]+)=", one.file_path[one.file_path.rindex(os.path.basename(path)) :])
        if found != list(keys):
            raise ValueError(f"{path} is laid out by {found}, the refresh writes by {list(keys)}")
    return df


def rows_not_in(new: DataFrame, old: DataFrame | None, date_col: str | None = None) -> DataFrame:
    """The rows of ``new`` that ``old`` does not hold.  With ``date_col`` only
    the range of the new rows' dates (and no date) is read from ``old``."""
    if old is None:
        return new
    if date_col is not None:
        low, high = new.agg(F.min(date_col), F.max(date_col)).first()
        dated = F.col(date_col).between(low, high) if low is not None else F.lit(False)
        old = old.where(dated | F.col(date_col).isNull())
    same = [new[c].eqNullSafe(old[c]) for c in new.columns]
    return new.join(old, reduce(lambda a, b: a & b, same), "left_anti")


def append_rows(df: DataFrame, path: str, keys: list[str]) -> None:
    write_star_table(df, path, keys, mode="append")


def append_new_rows(
    spark: SparkSession, new: DataFrame, path: str, keys: list[str] | None = None, date_col: str | None = None
) -> None:
    """Append the rows of ``new`` that the table at ``path`` does not hold."""
    keys = keys or []
    append_rows(rows_not_in(new, existing_table(spark, path, new.schema, keys), date_col), path, keys)


def missing_persons(spark: SparkSession, staged: DataFrame | None, new: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Person rows to append so that the table has one row per staging row,
    repeats included: of the batch's ids, what staging and batch ask for less
    what the table holds."""
    wanted = dim_person(new)
    held = existing_table(spark, path, wanted.schema, keys)
    if held is None:
        return wanted
    ids = new.select(F.col("id").alias("_id")).distinct()

    def of_batch(df: DataFrame) -> DataFrame:
        return df.join(ids, df["id"].eqNullSafe(ids["_id"]), "left_semi")

    if staged is not None:
        wanted = wanted.unionAll(dim_person(of_batch(staged)))
    return wanted.exceptAll(of_batch(held))


def drain(
    stream: DataFrame,
    to_mart: Callable[[DataFrame], None],
    checkpoint_dir: str,
) -> int:
    batches = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        to_mart(batch)
        batches.append(epoch_id)

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(batches)


def checkpoint_path(output_dir: str, landing_dir: str, name: str) -> str:
    """Offsets stay inside the mart they belong to, one folder for each
    landing folder."""
    landing = hashlib.md5(os.path.normpath(landing_dir).encode()).hexdigest()
    return os.path.join(output_dir, "_refresh", name, landing)


def refresh_arrivals(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    checkpoint_dir: str | None = None,
    fmt: str = "parquet",
    max_files_per_batch: int | None = None,
    layout: str = "flat",
) -> int:
    """Process every arrival file in ``landing_dir`` not processed before;
    returns the number of micro-batches run.

    Adds to the fact, person, time and arrivals staging tables of the mart in
    ``output_dir``, in the ``layout`` the pipeline wrote them in (or starts
    them).
    """
    reader = spark.readStream.format(fmt).schema(ARRIVALS_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def place(name: str) -> tuple[str, list[str]]:
        return os.path.join(output_dir, TABLE_FOLDERS[name]), folder_keys(name, layout)

    def to_mart(batch: DataFrame) -> None:
        stage_path = os.path.join(output_dir, "staging/immigration")
        rows = stage_arrivals(clean_arrivals(batch))
        staged = existing_table(spark, stage_path, rows.schema, [])
        new = materialize(rows_not_in(materialize(rows, "batch"), staged, "date"), "new-arrivals")
        append_new_rows(spark, fact_table(new), *place("fact_immigration"), date_col="date")
        path, keys = place("dim_immigrant")
        append_rows(missing_persons(spark, staged, new, path, keys), path, keys)
        append_new_rows(spark, calendar_dim(new), *place("dim_time"), date_col="date")
        append_rows(new, stage_path, [])

    return drain(
        reader.load(landing_dir), to_mart, checkpoint_dir or checkpoint_path(output_dir, landing_dir, "immigration")
    )


def refresh_city_temperature(
    spark: SparkSession,
    landing_dir: str,
    labels_path: str,
    output_dir: str,
    checkpoint_dir: str | None = None,
    country: str = "United States",
    max_files_per_batch: int | None = None,
    layout: str = "flat",
) -> int:
    """Process every temperature file (comma text with a header) in
    ``landing_dir`` not processed before; returns the number of micro-batches
    run.

    Adds to the city temperature and temperature staging tables, and to the
    city table where a demographics staging table is there to join.
    """
    codes = substring_codes(read_label_table(spark, labels_path))
    reader = spark.readStream.schema(TEMPERATURE_SCHEMA).option("header", True).option("enforceSchema", False)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def place(name: str) -> tuple[str, list[str]]:
        return os.path.join(output_dir, TABLE_FOLDERS[name]), folder_keys(name, layout)

    def to_mart(batch: DataFrame) -> None:
        stage_path = os.path.join(output_dir, "staging/temperature")
        rows = stage_temperature(clean_temperature(batch, country=country, codes=codes))
        staged = existing_table(spark, stage_path, rows.schema, [])
        new = materialize(rows_not_in(materialize(rows, "batch"), staged, "date"), "new-temperatures")
        append_new_rows(spark, dim_city_metric(new), *place("dim_city_temp"), date_col="date")
        demographics = existing_table(spark, os.path.join(output_dir, "staging/demographics"))
        if demographics is not None:
            append_new_rows(spark, dim_city(demographics, new), *place("dim_city"))
        append_rows(new, stage_path, [])

    return drain(
        reader.csv(landing_dir), to_mart, checkpoint_dir or checkpoint_path(output_dir, landing_dir, "city_temperature")
    )
