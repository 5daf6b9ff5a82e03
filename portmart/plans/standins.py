"""The driver's test tables dressed as the pipeline's sources.

The real inputs (arrival records, city temperatures, city demographics and
the label list) are not shipped; these functions derive frames of the same
shape from the TPC-H-like tables so every operator runs on data that grows
with the scale factor.  Each mapping is plain column arithmetic, mirrored
one to one by the DuckDB oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.session import scratch_path
from portmart.sources.labels import PORT_SECTION
from portmart.sources.readers import DEMOGRAPHICS_SCHEMA, TEMPERATURE_SCHEMA

# Country value that plays 'United States' in the temperature stand-in.
STANDIN_COUNTRY = "purchase"

# The delivery that is issued again: from this SAS day (1998-01-01) on, without a state.
REISSUED_FROM = 13880.0
WITHDRAWN_STATE = "MACHINERY"

# Part types standing in for races; STANDARD maps to no race column.
STANDIN_RACES = {
    "ECONOMY": "American Indian and Alaska Native",
    "LARGE": "Asian",
    "MEDIUM": "Black or African-American",
    "PROMO": "Hispanic or Latino",
    "SMALL": "White",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sas_day(ts_col: str) -> F.Column:
    """Days since 1960-01-01 of a timestamp, as a SAS-style double."""
    return F.datediff(F.to_date(F.col(ts_col)), F.lit("1960-01-01").cast("date")).cast("double")


def orders_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders plus an exact second copy of every tenth order."""
    o = table(spark, sf_dir, "orders")
    return o.unionByName(o.where(F.col("o_orderkey") % 10 == 0))


def arrivals(
    spark: SparkSession, sf_dir: str, mart_codes: bool = False, join: str | None = None
) -> DataFrame:
    """Arrival records: one per order (with repeats), coded by the
    customer's nation (port) and segment (state); with ``mart_codes`` by the
    port codes and states that the other two sources' cities get.  ``join``:
    the kind of join, else Spark's choice."""
    o = orders_with_repeats(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    j = o.join(c.hint(join) if join else c, o["o_custkey"] == c["c_custkey"])
    day = sas_day("o_orderdate")
    port, state = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    if mart_codes:
        port = F.format_string("N%02d", F.col("c_nationkey"))
        state = F.concat(F.lit("S"), (F.col("o_custkey") % 3).cast("string"))
    return j.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        day.alias("arrdate"),
        (day + (F.col("o_orderkey") % 30).cast("double")).alias("depdate"),
        port.alias("i94port"),
        state.alias("i94addr"),
        (F.col("o_custkey") % 80 + 16).cast("double").alias("i94bir"),
        F.col("o_orderstatus").alias("gender"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("double").alias("i94visa"),
        F.lit(1.0).alias("count"),
    )


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature rows (all text) from events: the city is a nation name
    picked by user (two of 27 names are unknown ports), the country is the
    event type; some readings are missing or the text 'NaN'."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    reading = (
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 13 == 0, F.lit("NaN"))
        .otherwise(F.col("value").cast("string"))
    )
    out = e.select(
        F.to_date("ts").cast("string").alias("dt"),
        reading.alias("AverageTemperature"),
        F.round(F.col("value") / 7, 3).cast("string").alias("AverageTemperatureUncertainty"),
        F.concat(F.lit("NATION_"), (uid % 27).cast("string")).alias("City"),
        F.col("event_type").alias("Country"),
        F.concat((uid % 25).cast("string"), F.lit("."), (uid % 2).cast("string"), F.lit("N")).alias("Latitude"),
        F.concat((uid % 25).cast("string"), F.lit("."), (uid % 3).cast("string"), F.lit("W")).alias("Longitude"),
    )
    return out.select(*[F.col(f.name) for f in TEMPERATURE_SCHEMA.fields])


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics rows (all text) from part: city and state from the
    size, race from the type, counts that are sometimes blank or
    fractional."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    race = F.coalesce(
        F.create_map(*[F.lit(x) for kv in STANDIN_RACES.items() for x in kv])[F.col("p_type")],
        F.col("p_type"),
    )
    cols = {
        "City": F.concat(F.lit("NATION_"), (size % 27).cast("string")),
        "State": F.concat(F.lit("STATE_"), (size % 3).cast("string")),
        "Median Age": (size / 2 + 20).cast("string"),
        "Male Population": (size * 100).cast("string"),
        "Female Population": (size * 110).cast("string"),
        "Total Population": (size * 210).cast("string"),
        "Number of Veterans": (size * 3 / 2).cast("string"),
        "Foreign-born": F.when(F.col("p_partkey") % 17 == 0, F.lit("")).otherwise((size * 30).cast("string")),
        "Average Household Size": (size / 8).cast("string"),
        "State Code": F.concat(F.lit("S"), (size % 3).cast("string")),
        "Race": race,
        "Count": F.when(
            F.col("p_partkey") % 7 == 0, F.concat(size.cast("string"), F.lit(".7"))
        ).otherwise(size.cast("string")),
    }
    return p.select(*[cols[f.name].alias(f.name) for f in DEMOGRAPHICS_SCHEMA.fields])


def _quote(c: F.Column) -> F.Column:
    return F.regexp_replace(c, "'", "''")


def write_label_file(
    spark: SparkSession,
    entries: DataFrame,
    countries: DataFrame | None = None,
    path: str | None = None,
    states: DataFrame | None = None,
    modes: DataFrame | None = None,
    visas: DataFrame | None = None,
) -> str:
    """Render ``entries`` (``sort, code, label``) as the port section of a
    label file, after an optional numeric country section and before optional
    mode, state and visa lists (all ``sort, code, label``), and write it as
    text; returns the folder.

    The file is written in sort order (range-partitioned, so it may be
    several files whose names follow that order).
    """
    path = path or scratch_path(spark, "labels")
    body = entries.select(
        F.lit(3).alias("_s"),
        F.col("sort").cast("double").alias("_k"),
        F.format_string("   '%s'\t=\t'%s   '", F.col("code"), _quote(F.col("label"))).alias("value"),
    )
    fixed = [
        (0, 0.0, "/* stand-in label list */"),
        (2, 0.0, f"  value {PORT_SECTION}"),
        (4, 0.0, ";"),
    ]
    parts = [body]
    if countries is not None:
        fixed += [
            (1, 0.0, "  value i94cntyl"),
            (1, float("inf"), "   99 =  'All Other Codes' ;"),
        ]
        parts.append(
            countries.select(
                F.lit(1).alias("_s"),
                (F.col("sort").cast("double") + 1).alias("_k"),
                F.format_string("   %s =  '%s'", F.col("code"), _quote(F.col("label"))).alias("value"),
            )
        )
    others = [
        (modes, 6, "  value i94model", "   %s = '%s'", (float("inf"), "   9 = 'Not reported' ;")),
        (states, 8, "  value i94addrl", "   '%s'='%s'", (float("inf"), "   '99'='All Other Codes' ;")),
        (visas, 10, "/* I94VISA - stand-in categories:", "   %s = %s", (float("inf"), "*/")),
    ]
    for rows, place, header, line, closing in others:
        if rows is None:
            continue
        fixed += [(place - 1, 0.0, header), (place, *closing)]
        label = F.col("label") if place == 10 else _quote(F.col("label"))
        parts.append(
            rows.select(
                F.lit(place).alias("_s"),
                F.col("sort").cast("double").alias("_k"),
                F.format_string(line, F.col("code"), label).alias("value"),
            )
        )
    schema = T.StructType(
        [
            T.StructField("_s", T.IntegerType()),
            T.StructField("_k", T.DoubleType()),
            T.StructField("value", T.StringType()),
        ]
    )
    lines = spark.createDataFrame(fixed, schema)
    for p in parts:
        lines = lines.unionByName(p)
    lines.orderBy("_s", "_k").select("value").write.mode("overwrite").text(path)
    return path


def nation_port_labels(spark: SparkSession, sf_dir: str) -> str:
    """Label file whose ports are the nations, listed from the highest key
    down, so a short name such as NATION_1 is first found inside NATION_19
    (the first-match rule, not the best match).  Regions form a country
    section before it, closed by the catch-all code 99."""
    n = table(spark, sf_dir, "nation")
    entries = n.select(
        (-F.col("n_nationkey")).alias("sort"),
        F.format_string("N%02d", F.col("n_nationkey")).alias("code"),
        F.format_string("%s'S PORT, R%d", F.col("n_name"), F.col("n_regionkey")).alias("label"),
    )
    r = table(spark, sf_dir, "region")
    countries = r.select(
        F.col("r_regionkey").alias("sort"),
        F.col("r_regionkey").cast("string").alias("code"),
        F.col("r_name").alias("label"),
    )
    c = table(spark, sf_dir, "customer")
    segment = c.groupBy(F.col("c_mktsegment").alias("code")).agg(F.min("c_custkey").alias("sort"))
    # One segment stays unlisted and so decodes to the catch-all.
    states = segment.where(F.col("code") != "BUILDING").select(
        "sort", "code", F.concat(F.lit("State of "), F.col("code")).alias("label")
    )
    o = table(spark, sf_dir, "orders")
    number, name = (F.split_part("o_orderpriority", F.lit("-"), F.lit(i)) for i in (1, 2))
    visas = o.groupBy(number.alias("code"), name.alias("label")).agg(F.min("o_orderkey").alias("sort"))
    modes = r.select(
        F.col("r_regionkey").alias("sort"),
        F.col("r_regionkey").cast("string").alias("code"),
        F.concat(F.lit("By "), F.col("r_name")).alias("label"),
    )
    return write_label_file(spark, entries, countries, states=states, modes=modes, visas=visas)


def part_port_labels(spark: SparkSession, sf_dir: str) -> str:
    """Label file with one port per part, in part-key order."""
    p = table(spark, sf_dir, "part")
    entries = p.select(
        F.col("p_partkey").alias("sort"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"),
        F.concat(F.col("p_name"), F.lit("'s "), F.col("p_brand")).alias("label"),
    )
    return write_label_file(spark, entries)


def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension keyed like the arrivals: one row per (nation,
    segment) with its customer count as population and the customers with
    a balance above 5000 as the foreign-born count."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    g = c.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("total_pop"),
        F.count_if(F.col("c_acctbal") > 5000).alias("foreign_born_count"),
    )
    g = g.join(n, g["c_nationkey"] == n["n_nationkey"])
    return g.select(
        F.col("c_nationkey").cast("string").alias("city_code"),
        F.col("c_mktsegment").alias("state_code"),
        F.col("n_name").alias("city_name"),
        "total_pop",
        "foreign_born_count",
    )
