"""Cleaning of the three sources (filters, null drops, typing, lookup,
pivot)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.functions.casts import lenient_float, lenient_long
from portmart.functions.dates import sas_day_to_date
from portmart.operators.lookup import first_match_code
from portmart.session import materialize

# The race categories of the demographics file, each with
# the staging column that holds its count.
RACE_COLUMNS: dict[str, str] = {
    "American Indian and Alaska Native": "american_indian_alaska_native_count",
    "Asian": "asian_count",
    "Black or African-American": "black_or_african_american_count",
    "Hispanic or Latino": "hispanic_or_latino_count",
    "White": "white_count",
}

# Demographic columns that describe the city (the pivot groups on them).
# Source column names.
DEMOGRAPHIC_KEYS = [
    "City",
    "city_code",
    "State",
    "State Code",
    "Median Age",
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-born",
    "Average Household Size",
]
_DEMOGRAPHIC_LONGS = [
    "Male Population",
    "Female Population",
    "Total Population",
    "Number of Veterans",
    "Foreign-born",
]
_DEMOGRAPHIC_FLOATS = ["Median Age", "Average Household Size"]


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` exactly (nulls dropped)."""
    return df.where(F.col(column) == F.lit(value))


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with no null in ``columns``."""
    return df.dropna(how="any", subset=list(columns))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicates removed."""
    return df.dropDuplicates()


def clean_arrivals(df: DataFrame, date_columns: Sequence[str] = ("arrdate", "depdate")) -> DataFrame:
    """Exact duplicates removed, SAS day numbers turned into dates."""
    out = dedup_rows(df)
    return out.withColumns({c: sas_day_to_date(c) for c in date_columns if c in out.columns})


def clean_temperature(
    df: DataFrame,
    labels: DataFrame | None = None,
    country: str = "United States",
    *,
    codes: DataFrame | None = None,
) -> DataFrame:
    """One country's rows with a temperature and a known port code.

    The null check on the temperature runs on the text, before typing, so a
    literal 'NaN' survives as a NaN float.
    """
    out = keep_equal(df, "Country", country)
    out = drop_null(out, "AverageTemperature")
    out = drop_null(first_match_code(out, "City", labels, codes=codes), "city_code")
    return out.withColumns(
        {
            "AverageTemperature": lenient_float("AverageTemperature"),
            "AverageTemperatureUncertainty": lenient_float("AverageTemperatureUncertainty"),
            "year": F.year(F.try_to_date("dt")),
            "month": F.month(F.try_to_date("dt")),
        }
    )


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    pivot_col: str,
    values: Sequence,
    value_col: str,
    names: Mapping | None = None,
) -> DataFrame:
    """``groupBy(keys).pivot(pivot_col, values).sum(value_col)``.

    The value list is explicit (no discovery job, no column named 'null'):
    rows with other or null pivot values still form their group but add to
    no column; a value with no rows gives a null cell.  Written as one
    conditional sum per value, so it is a single partial/final aggregation.
    """
    names = names or {}
    sums = [
        F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(
            str(names.get(v, v))
        )
        for v in values
    ]
    return df.groupBy(*keys).agg(*sums)


def pivot_sum_found(
    df: DataFrame,
    keys: Sequence[str],
    pivot_col: str,
    value_col: str,
    first: Sequence[str] = (),
    null_name: str = "unknown",
    max_values: int = 10_000,
) -> DataFrame:
    """``groupBy(keys).pivot(pivot_col).sum(value_col)`` with the pivot values
    taken from the data, so no row is left out of the columns.

    Each group becomes a map from pivot value (as text) to its sum, written
    once; the values are then found in one pass over the written groups, not
    over the rows, and each becomes a column: those of ``first`` in front, in
    the data or not, then the others by code point, then ``null_name`` for
    rows without a value.  A name that equals a key or an earlier column,
    case ignored, gets ``_2``, ``_3`` ... appended, so no two values share a
    column.  A group without rows of a value, or with null values only, has a
    null cell.  More than ``max_values`` values are an error, as in Spark's
    own pivot: they are columns, and they alone reach the driver.
    """
    value = F.col(f"`{pivot_col}`").cast("string")
    # A map has no null key: the first character tells null from text.
    tagged = F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), value))
    quoted = [f"`{k}`" for k in keys]
    cells = df.withColumn("_pivot", tagged).groupBy(*quoted, "_pivot").agg(F.sum(f"`{value_col}`").alias("_sum"))
    entries = F.map_from_entries(F.collect_list(F.struct("_pivot", "_sum")))
    groups = materialize(cells.groupBy(*quoted).agg(entries.alias("_cells")), "pivot-groups")
    present = groups.select(F.explode(F.map_keys("_cells")).alias("tag")).distinct()
    found = [r["tag"] for r in present.limit(max_values + 1).collect()]
    if len(found) > max_values:
        raise ValueError(f"{pivot_col} has more than {max_values} different values")
    named = [("+" + v, v) for v in first]
    named += [(t, t[1:]) for t in sorted(found) if t != "-" and t[1:] not in first]
    named += [("-", null_name)] if "-" in found else []
    taken = {k.lower() for k in keys}
    columns = []
    for tag, name in named:
        free, n = name, 1
        while free.lower() in taken:
            n += 1
            free = f"{name}_{n}"
        taken.add(free.lower())
        columns.append(F.try_element_at("_cells", F.lit(tag)).alias(free))
    return groups.select(*quoted, *columns)


def clean_demographics(
    df: DataFrame,
    labels: DataFrame | None = None,
    races: Mapping[str, str] = RACE_COLUMNS,
    *,
    codes: DataFrame | None = None,
    found: bool = False,
) -> DataFrame:
    """Port-coded cities, typed, with one count column per race; with
    ``found`` also one per race of the data that ``races`` does not list.

    Rows are not deduplicated before the sum, so a repeated row counts
    twice.  Group keys are the typed, unrounded values.
    """
    out = drop_null(first_match_code(df, "City", labels, codes=codes), "city_code")
    typed = {c: lenient_long(c) for c in _DEMOGRAPHIC_LONGS}
    typed.update({c: lenient_float(c) for c in _DEMOGRAPHIC_FLOATS})
    typed["Count"] = lenient_long("Count")
    out = out.withColumns(typed)
    if found:
        return pivot_sum_found(out, DEMOGRAPHIC_KEYS, "Race", "Count", first=list(races))
    return pivot_sum(out, DEMOGRAPHIC_KEYS, "Race", list(races), "Count")
