"""Checks never stop the run; key uniqueness."""

import pytest
from pyspark.sql import functions as F

from portmart.operators.quality import primary_key_check, quality_report, run_checks


def _tables(spark):
    return {
        "ok": spark.range(3),
        "missing": None,
        "empty": spark.range(0),
        "broken": spark.range(1).where(F.raise_error(F.lit("boom")).isNull()),
    }


def test_run_checks_counts_failures_without_raising(spark):
    rows, msg = run_checks(spark, _tables(spark))
    assert msg == "Checks complete. 4/8 checks passed. 4 checks failed!"
    passed = {(t, c): p for t, c, p, _ in rows}
    assert passed == {
        ("ok", "exists"): 1, ("ok", "has_records"): 1,
        ("missing", "exists"): 0, ("missing", "has_records"): 0,
        ("empty", "exists"): 1, ("empty", "has_records"): 0,
        ("broken", "exists"): 1, ("broken", "has_records"): 0,
    }
    with pytest.raises(AssertionError):
        run_checks(spark, _tables(spark), raise_on_failure=True)


def test_all_passed_message(spark):
    _, msg = run_checks(spark, {"a": spark.range(1), "b": spark.range(2)})
    assert msg == "Checks complete. 4/4 checks passed. All checks passed!"


def test_quality_report_frame(spark):
    t = {k: v for k, v in _tables(spark).items() if k != "broken"}
    got = sorted(tuple(r) for r in quality_report(spark, t).collect())
    assert got == [
        ("empty", "exists", 1, 0), ("empty", "has_records", 0, 0),
        ("missing", "exists", 0, None), ("missing", "has_records", 0, None),
        ("ok", "exists", 1, 3), ("ok", "has_records", 1, 3),
    ]


def test_primary_key_check(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    r = primary_key_check(df, "k").first()
    assert (r.rows, r.distinct_keys, r.is_unique) == (4, 2, False)
    assert primary_key_check(spark.range(5), "id").first().is_unique is True
