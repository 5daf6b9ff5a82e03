"""Data-quality checks: existence and non-emptiness of each table, and a
key-uniqueness report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.IntegerType()),
        T.StructField("records", T.LongType()),
    ]
)

# Wording of the summary line.
MSG_ALL_PASSED = "Checks complete. {passed}/{total} checks passed. All checks passed!"
MSG_SOME_FAILED = "Checks complete. {passed}/{total} checks passed. {failed} checks failed!"


def quality_report(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Two rows per table: ``exists`` (the frame is not None) and
    ``has_records`` (it has at least one row).  All counts run in one job;
    a missing table fails both checks with ``records`` null."""
    parts = []
    for name, df in tables.items():
        if df is None:
            parts.append(
                spark.createDataFrame(
                    [(name, "exists", 0, None), (name, "has_records", 0, None)],
                    REPORT_SCHEMA,
                )
            )
            continue
        n = df.agg(F.count(F.lit(1)).alias("records"))
        parts.append(
            n.select(
                F.lit(name).alias("table_name"),
                F.explode(F.array(F.lit("exists"), F.lit("has_records"))).alias("check_name"),
                "records",
            ).select(
                "table_name",
                "check_name",
                F.when(F.col("check_name") == "exists", F.lit(1))
                .otherwise((F.col("records") > 0).cast("int"))
                .alias("passed"),
                "records",
            )
        )
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` whose rows are counted by the action that consumes it, and the
    observation that holds the count afterwards.

    Observe what is written itself, after any shuffle: the count is then
    taken by the tasks that write, which Spark counts once for each part even
    if a part is written again after a failure.  An observation in front of a
    shuffle would count twice the rows that a lost executor makes it redo.
    """
    seen = Observation(f"{name}-records")
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def observed_report(records: Mapping[str, int | None]) -> list[tuple]:
    """The rows of ``quality_report`` from the records observed while each
    table was written (``None``: the table was not written)."""
    rows: list[tuple] = []
    for name, n in records.items():
        rows.append((name, "exists", int(n is not None), n))
        rows.append((name, "has_records", int(bool(n)), n))
    return rows


def summarise(rows: list[tuple], raise_on_failure: bool = False) -> str:
    """The one-line summary of report rows; an error if one failed and that
    is asked for."""
    passed = sum(r[2] for r in rows)
    msg = summary_message(passed, len(rows))
    if raise_on_failure and passed != len(rows):
        raise AssertionError(msg)
    return msg


def summary_message(passed: int, total: int) -> str:
    if passed == total:
        return MSG_ALL_PASSED.format(passed=passed, total=total)
    return MSG_SOME_FAILED.format(passed=passed, total=total, failed=total - passed)


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    raise_on_failure: bool = False,
) -> tuple[list[tuple], str]:
    """Evaluate the checks; an error while counting a table fails its record
    check instead of stopping the run.  All tables are counted in one job;
    only if that job fails are they counted one by one to find the culprit.
    Returns the report rows and the one-line summary."""
    try:
        rows = [tuple(r) for r in quality_report(spark, tables).collect()]
        order = {name: i for i, name in enumerate(tables)}
        rows.sort(key=lambda r: (order[r[0]], r[1] != "exists"))
    except Exception:  # noqa: BLE001 - fall back to isolating the failure
        rows = _checks_one_by_one(tables)
    return rows, summarise(rows, raise_on_failure)


def _checks_one_by_one(tables: Mapping[str, DataFrame | None]) -> list[tuple]:
    rows: list[tuple] = []
    for name, df in tables.items():
        exists = 1 if df is not None else 0
        records = None
        if df is not None:
            try:
                records = df.agg(F.count(F.lit(1))).first()[0]
            except Exception:  # noqa: BLE001 - any failure fails the check
                records = None
        has = 1 if records else 0
        rows.append((name, "exists", exists, records))
        rows.append((name, "has_records", has, records))
    return rows


def primary_key_check(df: DataFrame, key: str, table_name: str | None = None) -> DataFrame:
    """``rows``, ``distinct_keys`` and ``is_unique`` (every row has its own
    non-null key) in one pass."""
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(key)).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), F.lit(key).alias("key_column"), "*")
    return out
