"""Order of grouping and rounding in the demographics path (SURVEY note
11), and the pivot's handling of race values (note 3)."""

from pyspark.sql import functions as F

from portmart.operators.cleaning import DEMOGRAPHIC_KEYS, pivot_sum
from portmart.operators.staging import stage_demographics


def _typed(spark, rows):
    cols = ", ".join(f"`{k}` string" for k in DEMOGRAPHIC_KEYS if k != "Median Age")
    df = spark.createDataFrame(rows, f"{cols}, `Median Age` float, Race string, Count bigint")
    return df


def _row(age, race, count):
    base = ["Oakland", "OAK", "California", "CA", "1", "2", "3", "4", "5", "2.5"]
    return (*base, age, race, count)


def test_groups_on_unrounded_age_then_rounds_then_distinct(spark):
    df = _typed(spark, [_row(36.501, "White", 10), _row(36.499, "White", 10)])
    pivoted = pivot_sum(df, DEMOGRAPHIC_KEYS, "Race", ["White", "Asian"], "Count")
    assert pivoted.count() == 2  # two unrounded ages, two groups
    staged = stage_demographics(
        pivoted.withColumns({c: F.col(f"`{c}`").cast("long") for c in
                             ["Male Population", "Female Population", "Total Population",
                              "Number of Veterans", "Foreign-born"]})
        .withColumn("Average Household Size", F.col("Average Household Size").cast("float")),
        races={"White": "white_count", "Asian": "asian_count"},
    )
    rows = staged.collect()
    # both round to 36.5 and are equal after rounding: one row, not summed
    assert len(rows) == 1 and rows[0].white_count == 10 and rows[0].asian_count is None
    assert round(rows[0].median_age, 2) == 36.5


def test_pivot_ignores_unknown_and_null_values(spark):
    df = _typed(spark, [_row(30.0, "White", 1), _row(30.0, None, 5), _row(30.0, "Martian", 7), _row(30.0, "White", 2)])
    out = pivot_sum(df, DEMOGRAPHIC_KEYS, "Race", ["White", "Asian"], "Count")
    assert out.columns[-2:] == ["White", "Asian"]
    r = out.first()
    assert (out.count(), r["White"], r["Asian"]) == (1, 3, None)
