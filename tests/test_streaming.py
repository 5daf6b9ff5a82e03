"""Monthly refresh: files processed once, facts stay distinct."""

import os

import pytest
from fixtures import ARRIVALS
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from portmart.sources.readers import ARRIVALS_SCHEMA
from portmart.sources.sinks import read_partitioned
from portmart.streaming import refresh as refresh_mod
from portmart.streaming import refresh_arrivals


def _land(spark, folder, rows):
    spark.createDataFrame(rows, ARRIVALS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_refresh_is_incremental_and_distinct(spark, tmp_out):
    landing, out, ckpt = (os.path.join(tmp_out, d) for d in ("landing", "out", "ckpt"))
    april = [r for r in ARRIVALS if r[0] in (1.0, 2.0, 7.0)]
    _land(spark, landing, april)
    assert refresh_arrivals(spark, landing, out, ckpt) == 1
    fact = lambda: read_partitioned(spark, os.path.join(out, "immigration"))
    first = fact().count()
    # 1 (duplicate collapsed) + 2 (no date) + 7 on two dates
    assert first == 4

    # Nothing new: no batch runs, nothing changes.
    assert refresh_arrivals(spark, landing, out, ckpt) == 0
    assert fact().count() == first

    # A second file for the same month repeating known rows plus one new.
    _land(spark, landing, [april[0], (8.0, 20575.0, None, "OAK", "CA", 30.0, "F", 2.0, 1.0)])
    assert refresh_arrivals(spark, landing, out, ckpt) == 1
    df = fact()
    assert df.count() == first + 1
    assert df.groupBy("id", "date").count().where(F.col("count") > 1).count() == 0
    months = {(r.y, r.m) for r in df.select(F.year("date").alias("y"), F.month("date").alias("m")).collect()}
    assert months == {(2016, 4), (2016, 5), (None, None)}


TABLES = ["immigration", "immigrant", "time", "staging/immigration"]


def _mart(spark, out):
    return {t: sorted(map(str, read_partitioned(spark, os.path.join(out, t)).collect())) for t in TABLES}


@pytest.mark.parametrize("lost_after", [1, 2, 3, 4])
def test_batch_lost_after_a_write_is_replayed_whole(spark, tmp_out, monkeypatch, lost_after):
    """The second batch is lost after each of its four writes in turn."""
    landing, out, clean = (os.path.join(tmp_out, d) for d in ("landing", "out", "clean"))
    _land(spark, landing, ARRIVALS[:3])
    for mart in (out, clean):
        assert refresh_arrivals(spark, landing, mart) == 1
    _land(spark, landing, ARRIVALS[2:])
    real, calls = refresh_mod.append_rows, []

    def write_then_crash(*args):
        real(*args)
        calls.append(args)
        if len(calls) == lost_after:
            raise RuntimeError("lost after the write, before the offsets were committed")

    monkeypatch.setattr(refresh_mod, "append_rows", write_then_crash)
    with pytest.raises(Exception, match="lost after the write"):
        refresh_arrivals(spark, landing, out)
    monkeypatch.setattr(refresh_mod, "append_rows", real)
    assert refresh_arrivals(spark, landing, out) == 1
    assert refresh_arrivals(spark, landing, clean) == 1
    assert _mart(spark, out) == _mart(spark, clean)
    assert len(_mart(spark, out)["immigrant"]) == 8


@pytest.mark.parametrize("layout", ["flat", "partitioned"])
def test_refresh_adds_to_the_mart_of_the_batch(spark, tmp_out, layout):
    from test_pipeline import _cfg

    from portmart.plans.pipeline import load_star, run_pipeline

    cfg = _cfg(spark, tmp_out, layout)
    run_pipeline(spark, cfg)
    before = {k: v.count() for k, v in load_star(spark, cfg).items()}
    landing = os.path.join(tmp_out, "landing")
    _land(spark, landing, [ARRIVALS[0], (8.0, 20606.0, None, "OAK", "CA", 30.0, "F", 2.0, 1.0)])
    assert refresh_arrivals(spark, landing, cfg.output_dir, layout=layout) == 1
    after = {k: v.count() for k, v in load_star(spark, cfg).items()}
    more = {k for k in after if after[k] == before[k] + 1}
    assert more == {"fact_immigration", "dim_immigrant", "dim_time"}
    assert all(after[k] == before[k] for k in after if k not in more)


def test_refresh_refuses_another_layout(spark, tmp_out):
    landing, out = os.path.join(tmp_out, "landing"), os.path.join(tmp_out, "out")
    _land(spark, landing, ARRIVALS[:3])
    assert refresh_arrivals(spark, landing, out, layout="partitioned") == 1
    _land(spark, landing, ARRIVALS[3:])
    with pytest.raises(Exception, match="laid out by"):
        refresh_arrivals(spark, landing, out, layout="flat")


def test_two_marts_with_one_folder_name(spark, tmp_out):
    landing = os.path.join(tmp_out, "landing")
    _land(spark, landing, ARRIVALS)
    for parent in ("a", "b"):
        out = os.path.join(tmp_out, parent, "mart")
        assert refresh_arrivals(spark, landing, out) == 1
        assert read_partitioned(spark, os.path.join(out, "immigration")).count() == 8


def test_only_a_missing_folder_counts_as_no_table(spark, tmp_out):
    assert refresh_mod.existing_table(spark, os.path.join(tmp_out, "none")) is None
    empty = os.path.join(tmp_out, "empty")
    os.makedirs(empty)
    with pytest.raises(AnalysisException):
        refresh_mod.existing_table(spark, empty)


def test_temperature_refresh_equals_batch(spark, tmp_out):
    from fixtures import LABEL_FILE, TEMPERATURE_CSV

    from portmart.operators.cleaning import clean_temperature
    from portmart.operators.mart import dim_city_metric
    from portmart.operators.staging import stage_temperature
    from portmart.sources.labels import read_label_table
    from portmart.sources.readers import read_temperature
    from portmart.streaming import refresh_city_temperature

    labels_path = os.path.join(tmp_out, "labels.SAS")
    with open(labels_path, "w") as f:
        f.write(LABEL_FILE)
    header, *rows = TEMPERATURE_CSV.strip().splitlines()
    landing, out = os.path.join(tmp_out, "landing"), os.path.join(tmp_out, "out")
    os.makedirs(landing)
    first = [r for r in rows if r.startswith("2013-08")]
    with open(os.path.join(landing, "2013-08.csv"), "w") as f:
        f.write("\n".join([header, *first]) + "\n")
    assert refresh_city_temperature(spark, landing, labels_path, out, os.path.join(tmp_out, "ckpt")) == 1
    rest = [r for r in rows if not r.startswith("2013-08")] + first[:1]  # a repeated row
    with open(os.path.join(landing, "2013-09.csv"), "w") as f:
        f.write("\n".join([header, *rest]) + "\n")
    assert refresh_city_temperature(spark, landing, labels_path, out, os.path.join(tmp_out, "ckpt")) == 1

    whole = os.path.join(tmp_out, "whole.csv")
    with open(whole, "w") as f:
        f.write(TEMPERATURE_CSV)
    want = dim_city_metric(stage_temperature(clean_temperature(
        read_temperature(spark, whole), read_label_table(spark, labels_path))))
    got = read_partitioned(spark, os.path.join(out, "city_temperature"), want.schema).select(*want.columns)
    assert got.count() == want.count() == 5
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
