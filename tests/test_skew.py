"""The shuffle-join paths taken when a side is too big to broadcast, on
input where one city holds a third of all rows."""

import pytest
from fixtures import PORTS
from pyspark.sql import functions as F
from test_lookup import brute

from portmart.operators import lookup
from portmart.operators.decode import decode
from portmart.operators.joins import join_on_keys
from portmart.session import materialize
from portmart.plans import analysis


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def no_broadcast(spark):
    """Shuffle joins only, and partitions of a few KB already count as hot."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed_cities(spark, n=3000):
    names = ["Portland", "Oakland", "Mesa", "Alton", "Nowhere", None, "san francisco"]
    rows = [("Portland" if i % 3 == 0 else names[i % len(names)], i) for i in range(n)]
    return spark.createDataFrame(rows, "City string, i int")


def test_lookup_shuffle_path_matches_brute_force(spark, no_broadcast):
    labels = [(i, c, l) for i, (c, l) in enumerate(PORTS)]
    df = _skewed_cities(spark)
    out = lookup.first_match_code(df, "City", spark.createDataFrame(labels, "ord long, code string, label string"))
    plan = final_plan(out)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    got = {r.i: r.city_code for r in out.collect()}
    want = {r.i: brute(r.City, labels) for r in df.collect()}
    assert got == want
    assert sum(1 for v in got.values() if v == "POM") >= 1000


def test_city_join_shuffle_path(spark, no_broadcast):
    fact = spark.createDataFrame(
        [(float(i), "CA" if i % 3 else "ME", "SFR" if i % 3 else "POM") for i in range(900)],
        "id double, state_code string, city_code string",
    )
    city = spark.createDataFrame(
        [("SFR", "CA", "San Francisco", 864000), ("POM", "ME", "Portland", 66000)],
        "city_code string, state_code string, city_name string, total_pop bigint",
    )
    out = analysis.size_vs_volume(fact, city)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [("San Francisco", "CA", 864000, 600), ("Portland", "ME", 66000, 300)]


def _hot(spark, rows=60_000, shift=0):
    """Two thirds of all rows on one key, spread over many map tasks."""
    key = F.when(F.col("id") % 3 < 2, F.lit("Portland")).otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    return spark.range(0, rows, 1, 24).select(key.alias("City"), (F.col("id") * 7919 + shift).alias("i"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_a_hot_city_is_split_in_the_lookup(spark, no_broadcast):
    labels = spark.createDataFrame([(i, c, l) for i, (c, l) in enumerate(PORTS)], "ord long, code string, label string")
    out = lookup.first_match_code(_hot(spark), "City", labels)
    assert "skew=true" in final_plan(out)
    assert out.where("city_code = 'POM'").count() == 40_000


def test_a_hot_pair_is_split(spark, no_broadcast):
    rows = _hot(spark).withColumn("k2", F.length("City"))
    summary = materialize(rows.groupBy("City", "k2").agg(F.count(F.lit(1)).alias("n")), "summary")
    out = join_on_keys(rows, summary, ["City", "k2"], "f", "d").select("f.i", "d.n")
    assert "skew=true" in final_plan(out)
    assert out.where("n = 40000").count() == 40_000


def test_a_hot_code_is_split_when_decoded(spark, no_broadcast):
    labels = spark.createDataFrame([(1, "Portland", "Maine"), (2, "99", "Other")], "ord long, code string, label string")
    out = decode(_hot(spark), "City", labels, "state", default_code="99")
    assert "skew=true" in final_plan(out)
    assert {r.state: r["count"] for r in out.groupBy("state").count().collect()} == {"Maine": 40_000, "Other": 20_000}
