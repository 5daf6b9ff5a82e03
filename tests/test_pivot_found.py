"""Pivot over the values in the data."""

import pytest
from pyspark.sql import functions as F

from portmart.operators.cleaning import RACE_COLUMNS, clean_demographics, pivot_sum_found
from portmart.operators.lookup import substring_codes
from portmart.plans.catalog import QUERIES

ROWS = [
    ("a", "x", 1), ("a", "x", 2), ("a", "X", 4), ("a", None, 8), ("b", "unknown", 16),
    ("b", "y", None), ("b", "K", 32), (None, "x", 64), ("c", "-", 128), ("c", "", 256),
]


def _df(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k string, v string, n int")


def test_every_value_has_its_own_column(spark):
    out = pivot_sum_found(_df(spark), ["k"], "v", "n", first=["y", "absent"])
    assert out.columns == ["k", "y", "absent", "", "-", "K_2", "X", "unknown", "x_2", "unknown_2"]
    rows = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert rows == {
        "a": (None, None, None, None, None, 4, None, 3, 8),
        "b": (None, None, None, None, 32, None, 16, None, None),
        "c": (None, None, 256, 128, None, None, None, None, None),
        None: (None, None, None, None, None, None, None, 64, None),
    }


def test_sums_add_up_to_the_ungrouped_sum(spark):
    out = pivot_sum_found(_df(spark), ["k"], "v", "n")
    cells = sum(v for r in out.collect() for v in tuple(r)[1:] if v is not None)
    assert cells == sum(n for *_, n in ROWS if n is not None)


def test_empty_table_has_the_listed_columns(spark):
    out = pivot_sum_found(_df(spark, []), ["k"], "v", "n", first=["y"])
    assert out.columns == ["k", "y"] and out.count() == 0


def test_too_many_values_are_an_error_not_a_loss(spark):
    df = spark.range(20).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.lit(1).alias("n"))
    assert len(pivot_sum_found(df, ["k"], "v", "n", max_values=20).columns) == 21
    with pytest.raises(ValueError):
        pivot_sum_found(df, ["k"], "v", "n", max_values=19)


def test_an_unknown_race_gets_its_column(spark):
    labels = spark.createDataFrame([(1, "OAK", "OAKLAND, CA")], "ord long, code string, label string")
    keys = dict.fromkeys(
        ["State", "Median Age", "Male Population", "Female Population", "Total Population", "Number of Veterans",
         "Foreign-born", "Average Household Size", "State Code"], "1",
    )
    rows = [{"City": "Oakland", "Race": r, "Count": n, **keys} for r, n in (("White", "5"), ("Martian", "7"), (None, "9"))]
    schema = ", ".join(f"`{c}` string" for c in rows[0])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    out = clean_demographics(df, codes=substring_codes(labels), found=True)
    assert out.columns[-7:] == [*RACE_COLUMNS, "Martian", "unknown"]
    assert tuple(out.first())[-7:] == (None, None, None, None, 5, 7, 9)


def test_values_are_found_in_the_written_groups(spark):
    from conftest import SF_SMALL

    plan = QUERIES["pivot_found"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "orders.parquet" not in plan
