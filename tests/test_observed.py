"""Checks counted in the tasks that write, none read back."""

import pytest
from pyspark.sql import functions as F

from portmart.operators import quality
from portmart.plans import pipeline
from portmart.sources.sinks import write_counted


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_rows_written_are_counted(spark, tmp_out, keys):
    df = spark.range(0, 1000, 1, 7).withColumn("g", F.col("id") % 3)
    assert write_counted(df, f"{tmp_out}/t", keys) == 1000 == spark.read.parquet(f"{tmp_out}/t").count()
    assert write_counted(df.where("id < 0"), f"{tmp_out}/t", keys) == 0
    # an aggregate, whose count lies after its shuffle
    assert write_counted(df.groupBy("g").count(), f"{tmp_out}/u", keys) == 3


def test_report_equals_the_one_that_reads(spark):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": None}
    read, message = quality.run_checks(spark, tables)
    seen = quality.observed_report({"a": 3, "b": 0, "c": None})
    assert seen == read and quality.summarise(seen) == message
    with pytest.raises(AssertionError):
        quality.summarise(seen, raise_on_failure=True)


def test_the_batch_reads_no_written_table(spark, tmp_out, monkeypatch):
    from test_pipeline import _cfg

    def refuse(*a, **k):
        raise AssertionError("a written table is read")

    cfg = _cfg(spark, tmp_out, "partitioned")
    monkeypatch.setattr(pipeline, "read_partitioned", refuse)
    monkeypatch.setattr(quality, "run_checks", refuse)
    result = pipeline.run_pipeline(spark, cfg)
    monkeypatch.undo()
    star = pipeline.load_star(spark, cfg)
    assert {(t, n) for t, _, _, n in result.report} == {(t, df.count()) for t, df in star.items()}
