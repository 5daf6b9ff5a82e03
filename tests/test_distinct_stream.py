"""Arrivals made distinct by the stream's own state."""

import os

from fixtures import ARRIVALS
from pyspark.sql import functions as F

from portmart.operators.cleaning import clean_arrivals
from portmart.operators.mart import calendar_dim, dim_person, fact_table
from portmart.operators.staging import stage_arrivals
from portmart.sources.readers import ARRIVALS_SCHEMA
from portmart.streaming.distinct import STATE_ON_DISK, distinct_tables, landed_arrivals, stream_arrivals, unless_set


def _land(spark, folder, rows):
    spark.createDataFrame(rows, ARRIVALS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_month_repeated_across_batches_adds_nothing(spark, tmp_out):
    landing, out = os.path.join(tmp_out, "landing"), os.path.join(tmp_out, "out")
    _land(spark, landing, ARRIVALS[:4])
    assert stream_arrivals(spark, landing, out) == 1
    _land(spark, landing, ARRIVALS[:4])
    _land(spark, landing, ARRIVALS)
    assert stream_arrivals(spark, landing, out, max_files_per_batch=1) == 2
    assert stream_arrivals(spark, landing, out) == 0
    staged = stage_arrivals(clean_arrivals(spark.createDataFrame(ARRIVALS, ARRIVALS_SCHEMA)))
    want = {"immigration": fact_table(staged), "immigrant": dim_person(staged), "time": calendar_dim(staged)}
    for name, df in want.items():
        assert _rows(spark.read.parquet(os.path.join(out, name))) == _rows(df)


def test_a_batch_reads_its_files_and_the_state_only(spark, tmp_out):
    landing, out, ckpt = (os.path.join(tmp_out, d) for d in ("landing", "out", "ckpt"))
    _land(spark, landing, ARRIVALS)
    for _ in range(2):
        fact = distinct_tables(landed_arrivals(spark, landing))["immigration"]
        query = fact.writeStream.option("checkpointLocation", ckpt).option("path", out)
        query = query.format("parquet").trigger(availableNow=True).start()
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        assert "DeduplicateWithinWatermark" in plan or "dropDuplicatesWithinWatermark" in plan
        assert "Join" not in plan and plan.count("FileScan") <= 1
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        assert progress[0]["numInputRows"] == len(ARRIVALS)
        _land(spark, landing, ARRIVALS)
    assert spark.read.parquet(out).groupBy(F.col("id"), F.col("date")).count().where("count > 1").count() == 0


def test_customers_of_streamed_arrivals_are_not_broadcast(spark, monkeypatch):
    from conftest import SF_SMALL

    from portmart.plans import catalog

    plans, real = [], catalog.si.arrivals

    def arrivals(*args, **kwargs):
        df = real(*args, **kwargs)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(catalog.si, "arrivals", arrivals)
    monkeypatch.setattr(catalog, "_MARTS", {})
    monkeypatch.setattr(catalog, "stream_arrivals", lambda *args, **kwargs: 0)
    catalog._streamed_twice(spark, SF_SMALL)
    assert plans and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)


def _state_files(out, table):
    folder = os.path.join(out, "_refresh", f"distinct-{table}")
    return {os.path.splitext(f)[1] for at, _, names in os.walk(folder) if "/state/" in at for f in names}


def test_state_that_grows_with_the_rows_lies_on_disk(spark, tmp_out):
    landing, out = os.path.join(tmp_out, "landing"), os.path.join(tmp_out, "out")
    _land(spark, landing, ARRIVALS)
    assert stream_arrivals(spark, landing, out) == 1
    # RocksDB leaves archives; the store that holds all state in memory leaves deltas.
    for table in ("immigration", "immigrant"):
        assert ".zip" in _state_files(out, table) and ".delta" not in _state_files(out, table)
    assert ".delta" in _state_files(out, "time")


def test_settings_of_the_state_do_not_outlive_the_start_nor_replace_others(spark):
    provider, memory = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
    before = spark.conf.get(provider)
    spark.conf.set(memory, "321")
    try:
        with unless_set(spark, STATE_ON_DISK):
            assert spark.conf.get(provider) == STATE_ON_DISK[provider] != before
            assert spark.conf.get(memory) == "321"
        assert spark.conf.get(provider) == before and spark.conf.get(memory) == "321"
    finally:
        spark.conf.unset(memory)


def test_streamed_arrivals_are_joined_once(spark, monkeypatch):
    from conftest import SF_SMALL

    from portmart.plans import catalog

    calls, real = [], catalog.si.arrivals
    monkeypatch.setattr(catalog.si, "arrivals", lambda *a, **k: calls.append(real(*a, **k)) or calls[-1])
    monkeypatch.setattr(catalog, "_MARTS", {})
    landed = []
    monkeypatch.setattr(catalog, "stream_arrivals", lambda s, landing, *a, **k: landed.append(s.read.parquet(landing).count()))
    catalog._streamed_twice(spark, SF_SMALL)
    n = calls[0].count()
    assert len(calls) == 1 and landed == [n, 2 * n]
