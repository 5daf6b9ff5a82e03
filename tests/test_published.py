"""A mart whose tables switch together: replaced months, crashes, late issues."""

import os

import pytest
from fixtures import ARRIVALS
from pyspark.sql import functions as F

from portmart.operators.mart import calendar_dim, dim_person, fact_table
from portmart.operators.staging import stage_arrivals
from portmart.operators.cleaning import clean_arrivals
from portmart.sources.readers import ARRIVALS_SCHEMA
from portmart.streaming import published

APRIL = (1.0, 20550.0, None, "OAK", "CA", 30.0, "F", 2.0, 1.0)
OTHER = (2.0, 20551.0, None, "SFR", "CA", 40.0, "M", 2.0, 1.0)
MAY = (3.0, 20580.0, None, "SFR", "CA", 50.0, "M", 2.0, 1.0)
UNDATED = (4.0, None, None, "SFR", None, 60.0, None, 1.0, 1.0)


def _land(spark, root, issue, rows):
    df = spark.createDataFrame(rows, ARRIVALS_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{root}/landing/issue={issue}")
    return published.replace_arrivals(spark, f"{root}/landing", f"{root}/mart")


def _schemas(spark):
    staged = stage_arrivals(clean_arrivals(spark.createDataFrame(ARRIVALS, ARRIVALS_SCHEMA)))
    return {
        "staging_immigration": staged.schema,
        "immigration": fact_table(staged).schema,
        "immigrant": dim_person(staged).schema,
        "time": calendar_dim(staged).schema,
    }


def _tables(spark, root, version=None):
    return {
        name: sorted(map(str, published.read_published(spark, f"{root}/mart", name, schema, version).drop("part").collect()))
        for name, schema in _schemas(spark).items()
    }


def _ids(spark, root, table="immigration"):
    df = published.read_published(spark, f"{root}/mart", table, _schemas(spark)[table])
    return sorted(r.id for r in df.select("id").collect())


def test_a_corrected_month_replaces_its_rows(spark, tmp_out):
    _land(spark, tmp_out, 1, [APRIL, APRIL, OTHER, MAY, UNDATED])
    assert _ids(spark, tmp_out) == [1.0, 2.0, 3.0, 4.0]
    corrected = (1.0, 20552.0, None, "OAK", "CA", 31.0, "F", 2.0, 1.0)
    assert _land(spark, tmp_out, 2, [corrected]) == 1
    # April is as issued last: one record, its new date and age; May and the undated rows stay.
    for table in ("immigration", "immigrant", "staging_immigration"):
        assert _ids(spark, tmp_out, table) == [1.0, 3.0, 4.0]
    person = published.read_published(spark, f"{tmp_out}/mart", "immigrant", _schemas(spark)["immigrant"])
    assert [r.age for r in person.where("id = 1").collect()] == [31.0]
    time = published.read_published(spark, f"{tmp_out}/mart", "time", _schemas(spark)["time"])
    assert sorted(str(r.date) for r in time.collect()) == ["2016-04-08", "2016-05-06", "None"]
    # The older version can still be read, and goes when nothing keeps it.
    assert len(_tables(spark, tmp_out, version=1)["immigration"]) == 4
    assert published.drop_unused(spark, f"{tmp_out}/mart", keep=1) == 4
    assert _ids(spark, tmp_out) == [1.0, 3.0, 4.0]


def test_an_old_issue_that_comes_late_changes_nothing(spark, tmp_out):
    _land(spark, tmp_out, 5, [APRIL, MAY])
    before = _tables(spark, tmp_out)
    assert _land(spark, tmp_out, 4, [OTHER]) == 1
    assert _tables(spark, tmp_out) == before
    # Of a delivery with an old and a new month only the new one counts.
    june = (9.0, 20610.0, None, "OAK", "CA", 30.0, "F", 2.0, 1.0)
    _land(spark, tmp_out, 4, [OTHER, june])
    assert _ids(spark, tmp_out) == [1.0, 3.0, 9.0]


def test_files_of_one_issue_belong_together(spark, tmp_out):
    _land(spark, tmp_out, 1, [APRIL, MAY])
    _land(spark, tmp_out, 1, [APRIL, OTHER])
    assert _ids(spark, tmp_out) == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("lost_after", [1, 2, 3, 4, 5])
def test_a_crash_leaves_the_old_version(spark, tmp_out, monkeypatch, lost_after):
    """Lost after each of the four tables, and before the rename."""
    _land(spark, tmp_out, 1, [APRIL, OTHER, MAY])
    before, writes = _tables(spark, tmp_out), []
    real_write, real_switch = published.write_partitioned, published.switch

    def write(*args, **kwargs):
        real_write(*args, **kwargs)
        writes.append(args)
        if len(writes) == lost_after:
            raise RuntimeError("lost")

    def switch(*args):
        if lost_after == 5:
            raise RuntimeError("lost")
        real_switch(*args)

    monkeypatch.setattr(published, "write_partitioned", write)
    monkeypatch.setattr(published, "switch", switch)
    with pytest.raises(Exception, match="lost"):
        _land(spark, tmp_out, 2, [MAY, UNDATED, (8.0, *APRIL[1:])])
    assert _tables(spark, tmp_out) == before
    monkeypatch.setattr(published, "write_partitioned", real_write)
    monkeypatch.setattr(published, "switch", real_switch)
    assert published.replace_arrivals(spark, f"{tmp_out}/landing", f"{tmp_out}/mart") == 1
    assert _ids(spark, tmp_out) == [3.0, 4.0, 8.0]


def test_a_new_month_reads_no_published_rows(spark, tmp_out, monkeypatch):
    _land(spark, tmp_out, 1, [APRIL])

    def read(*args, **kwargs):
        raise AssertionError("published rows were read")

    monkeypatch.setattr(published, "read_published", read)
    assert _land(spark, tmp_out, 2, [MAY]) == 1
    monkeypatch.undo()
    assert _ids(spark, tmp_out) == [1.0, 3.0]


def test_no_version_and_empty_deliveries(spark, tmp_out):
    root = os.path.join(tmp_out, "mart")
    assert published.versions(spark, root) == []
    assert published.read_published(spark, root, "time", _schemas(spark)["time"]).count() == 0
    empty = spark.createDataFrame([], ARRIVALS_SCHEMA).withColumn("issue", F.lit(1).cast("long"))
    part = published.month_of(F.lit(None).cast("date"))
    assert published.refresh_issues(spark, empty, root, "t", part, lambda d: d, lambda d: {}) is None
    assert published.versions(spark, root) == []


def test_records_are_shuffled_once_for_a_table(spark, tmp_out, monkeypatch):
    plans, real_write = {}, published.write_partitioned

    def write(df, path, *args, **kwargs):
        if "version=2" in path:
            plan = df._jdf.queryExecution().executedPlan().toString()
            plans[path.split("/")[-2]] = plan.split("Initial Plan")[0]
        real_write(df, path, *args, **kwargs)

    monkeypatch.setattr(published, "write_partitioned", write)
    _land(spark, tmp_out, 1, [APRIL, MAY])
    _land(spark, tmp_out, 2, [APRIL, APRIL, OTHER, MAY, UNDATED])
    shuffles = {t: plans[t].count("Exchange hashpartitioning") + plans[t].count("Exchange SinglePartition") for t in plans}
    assert (shuffles["staging_immigration"], shuffles["immigration"], shuffles["immigrant"]) == (1, 1, 0)
    assert not any("SortMergeJoin" in p for p in plans.values())
    assert _ids(spark, tmp_out) == [1.0, 2.0, 3.0, 4.0]


def test_pieces_hold_equal_rows_and_follow_the_size_of_a_part(spark):
    rows = spark.range(400).selectExpr("id % 50 as k", "if(id < 300, 'a', 'b') as part")
    sizes = published.part_rows(rows)
    assert sizes == {"a": 300, "b": 100}
    out = published.dealt(rows, ["k"], sizes, piece_rows=50)
    assert out.rdd.getNumPartitions() == 8 and out.count() == 400
    deals = {r.part: r.n for r in out.groupBy("part").agg(F.count_distinct(published.DEAL).alias("n")).collect()}
    assert deals["a"] > deals["b"] and deals["a"] <= 6 and deals["b"] <= 2
    assert out.select("part", "k", published.DEAL).distinct().count() == rows.distinct().count()
