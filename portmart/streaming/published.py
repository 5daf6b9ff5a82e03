"""A mart whose tables switch together, month by month.

The sources are issued again when they were wrong.  A delivery is a folder
``issue=<number>`` of the landing folder, whole for every part (month) it
holds: the rows of a part are those of the latest issue that has it, in the
staging table and in every table derived from it.

Data is written once and never changed: ``data/<table>/version=<n>/part=<p>``.
What counts is the manifest, one small table per version that names for each
table and part the version and issue to read.  A refresh writes the data of
the parts it replaces, for all tables, then the next manifest, and only moving
that into place (one rename) makes it current: readers see all tables before
or all tables after, and a refresh that dies anywhere leaves the old version as
it was.  Replayed, it writes the same parts again.

Rows are shuffled once for the distincts and the write of a table together
(``dealt``), not once for each.

A micro-batch reads its own files and the manifest; of the published data only
the parts of an issue whose files came in several micro-batches.  One refresh
at a time may run on a mart.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from portmart.functions.dates import sas_day_to_date
from portmart.operators.cleaning import clean_arrivals, clean_demographics
from portmart.operators.mart import FACT_COLUMNS, PERSON_COLUMNS, calendar_dim, dim_city, fact_table
from portmart.operators.staging import stage_arrivals, stage_demographics
from portmart.sources.readers import ARRIVALS_SCHEMA, DEMOGRAPHICS_SCHEMA
from portmart.sources.sinks import write_partitioned
from portmart.streaming.refresh import checkpoint_path, drain

MANIFEST_SCHEMA = StructType(
    [
        StructField("table", StringType()),
        StructField("part", StringType()),
        StructField("version", LongType()),
        StructField("issue", LongType()),
    ]
)
NO_DATE = "none"
WHOLE = "all"

# Marks rows that lie together by part; not written.
DEAL = "_deal"
# Rows of a part that make a piece, and rows a task gets on average.
PIECE_ROWS = 200_000
# The arrivals' columns that the staging table takes over as they are.
ARRIVAL_SAME = ["cicid", "i94port", "i94addr", "i94bir", "gender", "i94visa", "count"]

Tables = Mapping[str, DataFrame]


def month_of(date: Column) -> Column:
    """The part of an arrival: its month, or one part for rows without date."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_DATE))


def part_rows(df: DataFrame) -> dict[str, int]:
    """The number of rows of each part: months, not records."""
    return {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}


def dealt(df: DataFrame, columns: list[str], rows: Mapping[str, int], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``df``, whose parts have ``rows`` rows, shuffled so that a piece of a
    part, with all that is equal in ``columns``, lies in one task: as many
    pieces as the part's rows ask for, and tasks as all rows do.  With ``part`` and ``DEAL`` among the
    columns a distinct needs no shuffle after it, nor does the write."""
    pieces = [(part, -(-n // piece_rows)) for part, n in rows.items()]
    known = df.sparkSession.createDataFrame(pieces, "part string, _pieces long")
    deal = F.pmod(F.xxhash64(*columns), F.col("_pieces"))
    tasks = max(1, -(-sum(rows.values()) // piece_rows))
    return df.join(F.broadcast(known), "part").withColumn(DEAL, deal).drop("_pieces").repartition(tasks, "part", DEAL)


def _folder(spark: SparkSession, path: str):
    """A folder of the mart as Hadoop's file system sees it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, oldest first."""
    fs, at = _folder(spark, os.path.join(root, "_versions"))
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n) for n in names if re.fullmatch(r"\d+", n))


def _manifest_path(root: str, version: int) -> str:
    return os.path.join(root, "_versions", f"{version:010d}")


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``table, part, version, issue`` of a version (the current one)."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest_path(root, known[-1] if version is None else version))


def read_published(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    version: int | None = None,
    parts: Iterable[str] | None = None,
) -> DataFrame:
    """A table as of a version (the current one), of ``schema`` and a column
    ``part``; with ``parts`` only their folders are read."""
    rows = read_manifest(spark, root, version).where(F.col("table") == table)
    if parts is not None:
        rows = rows.where(F.col("part").isin(list(parts)))
    base = os.path.join(root, "data", table)
    folders = [f"{base}/version={r.version}/part={r.part}" for r in rows.collect()]
    fs, _ = _folder(spark, base)
    # A part without rows in this table has no folder.
    folders = [f for f in folders if fs.exists(_folder(spark, f)[1])]
    full = StructType([*schema.fields, StructField("part", StringType())])
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*folders).select(*full.names)


def publish(
    spark: SparkSession, root: str, issues: Mapping[str, int], staged: tuple[str, DataFrame], derive: Callable[[DataFrame], Tables]
) -> int:
    """Replace the parts of ``issues`` (part -> issue) in the staging table
    (name and rows, with their ``part``) and the tables derived from it, and
    make that the next version.  Returns its number."""
    version = max(versions(spark, root), default=0) + 1

    def write(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(root, "data", name, f"version={version}")
        lies_together = DEAL in df.columns
        df = df.drop(DEAL)
        write_partitioned(df, path, ["part"], rebalance=not lies_together)
        return spark.read.schema(df.schema).parquet(path)

    name, rows = staged
    tables = derive(write(name, rows))
    for table, df in tables.items():
        write(table, df)
    switch(spark, root, version, [name, *tables], issues)
    return version


def switch(spark: SparkSession, root: str, version: int, tables: Iterable[str], issues: Mapping[str, int]) -> None:
    """Write the manifest in which these parts of the tables are of
    ``version``, and move it into place."""
    new = [(t, part, version, issue) for t in tables for part, issue in sorted(issues.items())]
    rows = spark.createDataFrame(new, MANIFEST_SCHEMA)
    kept = read_manifest(spark, root).join(rows.select("table", "part"), ["table", "part"], "left_anti")
    draft = os.path.join(root, "_versions", f"draft-{uuid.uuid4().hex}")
    kept.unionByName(rows).coalesce(1).write.parquet(draft)
    fs, source = _folder(spark, draft)
    if not fs.rename(source, _folder(spark, _manifest_path(root, version))[1]):
        raise RuntimeError(f"version {version} of {root} could not be moved into place")


def refresh_issues(
    spark: SparkSession,
    landed: DataFrame,
    root: str,
    name: str,
    part_of: Column,
    stage: Callable[[DataFrame], DataFrame],
    derive: Callable[[DataFrame], Tables],
    merge: Callable[[DataFrame, DataFrame], DataFrame] = lambda new, old: new.unionByName(old).distinct(),
) -> int | None:
    """Publish the rows of a micro-batch (with their ``issue``), or nothing if
    later issues of all its parts are published.  Returns the version."""
    landed = landed.withColumn("part", part_of)
    held = read_manifest(spark, root).where(F.col("table") == name)
    before = {r.part: r.issue for r in held.collect()}
    # One row for each part: months, not records.
    latest = {r.part: r.issue for r in landed.groupBy("part").agg(F.max("issue").alias("issue")).collect()}
    issues = {p: i for p, i in latest.items() if i >= before.get(p, i)}
    if not issues:
        return None
    wanted = spark.createDataFrame(list(issues.items()), "part string, issue long")
    # Spark does not know its size, and would shuffle the records for it.
    rows = stage(landed.join(F.broadcast(wanted), ["part", "issue"], "left_semi"))
    more = [p for p, i in issues.items() if before.get(p) == i]
    if more:
        schema = StructType([f for f in rows.schema.fields if f.name not in ("part", DEAL)])
        rows = merge(rows, read_published(spark, root, name, schema, parts=more))
    return publish(spark, root, issues, (name, rows), derive)


def arrival_tables(staged: DataFrame) -> Tables:
    """The tables fed by the arrivals, each row with its part: parts are months
    of the arrival date, so what is distinct in each part is distinct."""
    fact = fact_table(dealt(staged.select(*FACT_COLUMNS, "part"), FACT_COLUMNS, part_rows(staged)), "part", DEAL)
    time = calendar_dim(staged)
    return {
        "immigration": fact,
        # Read by files of one part each.
        "immigrant": staged.select(*PERSON_COLUMNS, "part", F.lit(0).alias(DEAL)),
        "time": time.withColumn("part", month_of(F.col("date"))),
    }


def replace_arrivals(
    spark: SparkSession, landing_dir: str, root: str, fmt: str = "parquet", max_files_per_batch: int | None = None
) -> int:
    """Publish every delivery of arrivals (``issue=<n>`` folders) not seen
    before; a month issued again replaces its rows in the staging, fact, person
    and time tables.  Returns the number of micro-batches run."""
    reader = spark.readStream.format(fmt).schema(StructType([*ARRIVALS_SCHEMA.fields, StructField("issue", LongType())]))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def to_mart(batch: DataFrame) -> None:
        part = month_of(sas_day_to_date("arrdate"))
        landed: dict[str, int] = {}

        def stage(rows: DataFrame) -> DataFrame:
            landed.update(part_rows(rows))
            return stage_arrivals(clean_arrivals(dealt(rows.drop("issue"), ARRIVAL_SAME, landed)), "part", DEAL)

        def merge(new: DataFrame, old: DataFrame) -> DataFrame:
            held = part_rows(old)
            rows = {p: landed.get(p, 0) + held.get(p, 0) for p in landed.keys() | held.keys()}
            both = new.drop(DEAL).unionByName(old)
            return dealt(both, [c for c in both.columns if c != "part"], rows).distinct()

        refresh_issues(spark, batch, root, "staging_immigration", part, stage, arrival_tables, merge)

    return drain(reader.load(landing_dir), to_mart, checkpoint_path(root, landing_dir, "replace_arrivals"))


def replace_demographics(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    codes: DataFrame,
    temperature: DataFrame,
    max_files_per_batch: int | None = None,
) -> int:
    """Publish the latest delivery of demographics (';' text with a header in
    ``issue=<n>`` folders), which replaces the whole staging table and the city
    table made from it and the temperature staging rows.  ``codes`` is the
    labels' ``substring_codes``.  Returns the number of micro-batches run."""
    schema = StructType([*DEMOGRAPHICS_SCHEMA.fields, StructField("issue", LongType())])
    reader = spark.readStream.schema(schema).option("header", True).option("sep", ";")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def stage(rows: DataFrame) -> DataFrame:
        # Counts of one city and race add up, so the delivery is kept as it came.
        return rows.drop("part", "issue").withColumn("part", F.lit(WHOLE))

    def derive(raw: DataFrame) -> Tables:
        staged = stage_demographics(clean_demographics(raw.drop("part"), codes=codes))
        return {
            "staging_demographics": staged.withColumn("part", F.lit(WHOLE)),
            "city": dim_city(staged, temperature).withColumn("part", F.lit(WHOLE)),
        }

    def to_mart(batch: DataFrame) -> None:
        refresh_issues(
            spark, batch, root, "demographics", F.lit(WHOLE), stage, derive, merge=lambda new, old: new.unionByName(old)
        )

    return drain(reader.csv(landing_dir), to_mart, checkpoint_path(root, landing_dir, "replace_demographics"))


def drop_unused(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions and the data only they need;
    returns how many data folders went.  Not while a refresh runs."""
    known = versions(spark, root)
    used = {(r.table, r.part, r.version) for v in known[-keep:] for r in read_manifest(spark, root, v).collect()}
    gone = 0
    for v in known[:-keep]:
        for r in read_manifest(spark, root, v).collect():
            folder = os.path.join(root, "data", r.table, f"version={r.version}", f"part={r.part}")
            fs, at = _folder(spark, folder)
            if (r.table, r.part, r.version) not in used and fs.exists(at):
                fs.delete(at, True)
                gone += 1
    for v in known[:-keep]:
        fs, at = _folder(spark, _manifest_path(root, v))
        fs.delete(at, True)
    return gone
