"""Source readers with explicit schemas (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Arrival records: the numeric SAS fields are doubles, codes are text.
# Column names of the three sources, in file order.
ARRIVALS_SCHEMA = T.StructType(
    [
        T.StructField("cicid", T.DoubleType()),
        T.StructField("arrdate", T.DoubleType()),
        T.StructField("depdate", T.DoubleType()),
        T.StructField("i94port", T.StringType()),
        T.StructField("i94addr", T.StringType()),
        T.StructField("i94bir", T.DoubleType()),
        T.StructField("gender", T.StringType()),
        T.StructField("i94visa", T.DoubleType()),
        T.StructField("count", T.DoubleType()),
    ]
)


def _all_text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Monthly city temperatures (comma separated, header line); every column
# is read as text and typed later by the cleaner.
TEMPERATURE_SCHEMA = _all_text(
    [
        "dt",
        "AverageTemperature",
        "AverageTemperatureUncertainty",
        "City",
        "Country",
        "Latitude",
        "Longitude",
    ]
)

# City demographics (semicolon separated, header line), one row per
# (city, race); all text.
DEMOGRAPHICS_SCHEMA = _all_text(
    [
        "City",
        "State",
        "Median Age",
        "Male Population",
        "Female Population",
        "Total Population",
        "Number of Veterans",
        "Foreign-born",
        "Average Household Size",
        "State Code",
        "Race",
        "Count",
    ]
)


_SCHEMA_FORMATS = {"parquet", "orc", "csv", "json", "avro"}


def read_arrivals(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = ARRIVALS_SCHEMA,
    options: dict[str, str | bool] | None = None,
) -> DataFrame:
    """Arrival records in any installed format (parquet by default).

    For the built-in formats only the columns the schema names are read, so
    a wide landing copy is pruned at the scan; other readers (such as a
    SAS reader) bring their own schema.  ``options`` go to the reader
    (``{"header": True}`` for a CSV copy).
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None and fmt in _SCHEMA_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Delimited text with a header line; empty fields read as null.

    Columns are taken by position and the header names are checked against
    the schema (``enforceSchema=false``), so a file with its columns in
    another order fails instead of being silently mislabelled.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("enforceSchema", not header)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def quarantine_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str,
    sep: str = ",",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Delimited text split into the rows that fit ``schema`` and the lines
    that do not: returns (rows, rejects), rejects as ``file``, ``line``.

    A line is rejected whole when it has too few or too many fields, a quote
    that does not close, or a field that its column's type cannot hold, so
    nothing is cut off or turned into null on the way.  A NaN or an empty
    field is no fault.  Empty lines count as no line, and the first line of
    each file, with ``header``, as none either; kept plus rejected rows are
    all the others.  Repeated lines stay repeated on either side.

    The text is parsed once, whole (a parse of some columns would not see
    lines of a wrong width), into ``out`` in one write, in folders for either
    kind; all that reads the rows afterwards prunes columns and filters on
    the written copy.  The rejects are a table, however many they are.
    """
    fault = _free("_fault", schema.names)
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(fault, T.StringType())]))
        .option("header", header)
        .option("sep", sep)
        .option("enforceSchema", not header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", fault)
        .csv(path)
    )
    file, kind = _free("_file", schema.names), _free("_rejected", schema.names)
    bad = F.col(fault).isNotNull()
    # The place is kept of rejected lines only; their fields are in the line.
    fields = [F.when(~bad, F.col(f"`{n}`")).alias(f"c{i}") for i, n in enumerate(schema.names)]
    place = F.when(bad, F.col("_metadata.file_path"))
    parsed.select(*fields, F.col(fault), place.alias(file), bad.alias(kind)).write.partitionBy(kind).parquet(out)
    stored = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)]
    stored += [T.StructField(fault, T.StringType()), T.StructField(file, T.StringType())]
    stored += [T.StructField(kind, T.BooleanType())]
    both = spark.read.schema(T.StructType(stored)).parquet(out)
    rows = both.where(~F.col(kind)).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(schema.names)])
    return rows, both.where(F.col(kind)).select(F.col(file).alias("file"), F.col(fault).alias("line"))


def _free(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column has it, case ignored."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def read_temperature(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, TEMPERATURE_SCHEMA, sep=",")


def read_demographics(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, DEMOGRAPHICS_SCHEMA, sep=";")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
