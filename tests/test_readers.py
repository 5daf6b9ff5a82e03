"""Readers: the arrivals format parameter, views and SQL text."""

import os

from fixtures import ARRIVALS

from portmart.sources.readers import ARRIVALS_SCHEMA, read_arrivals, register_view


def test_arrivals_in_another_format_are_typed_by_the_schema(spark, tmp_out):
    path = os.path.join(tmp_out, "arrivals_csv")
    df = spark.createDataFrame(ARRIVALS, ARRIVALS_SCHEMA)
    df.write.option("header", True).csv(path)
    back = spark.read.format("csv").option("header", True).schema(ARRIVALS_SCHEMA).load(path)
    got = read_arrivals(spark, path, fmt="csv", schema=ARRIVALS_SCHEMA, options={"header": True})
    assert got.schema == ARRIVALS_SCHEMA
    assert sorted(map(repr, got.collect())) == sorted(map(repr, back.collect()))


def test_wide_landing_copy_is_pruned_to_the_schema(spark, tmp_out):
    path = os.path.join(tmp_out, "wide")
    df = spark.createDataFrame(ARRIVALS, ARRIVALS_SCHEMA)
    df.selectExpr("*", "'x' AS visapost", "'y' AS occup").write.parquet(path)
    got = read_arrivals(spark, path)
    assert got.columns == ARRIVALS_SCHEMA.names
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "visapost" not in plan and "occup" not in plan


def test_view_and_sql_text(spark):
    register_view(spark.createDataFrame(ARRIVALS, ARRIVALS_SCHEMA), "arrivals_view")
    n = spark.sql("SELECT COUNT (DISTINCT cicid) AS n FROM arrivals_view").first().n
    assert n == len({r[0] for r in ARRIVALS})
