"""Joins on a bucketed key: no shuffle of either side, repeats and nulls."""

import collections
import os
import re

import pytest
from pyspark.sql import functions as F

from portmart.operators.colocated import joined_counts, open_bucketed, write_bucketed
from portmart.plans.analysis import gender_by_city

FACT = [(1.0, "A"), (1.0, "A"), (1.0, "B"), (2.0, "A"), (0.0, "B"), (None, "A"), (float("nan"), "C"), (9.0, None)]
PERSON = [(1.0, "F"), (1.0, "F"), (1.0, None), (2.0, "M"), (-0.0, "M"), (None, "F"), (float("nan"), "F"), (9.0, "M"), (5.0, "M")]


def _pair(spark, root, fact=FACT, person=PERSON, buckets=4):
    f = write_bucketed(spark.createDataFrame(fact, "id double, city_code string"), f"{root}/f", "id", ["city_code"], buckets)
    p = write_bucketed(spark.createDataFrame(person, "id double, gender string"), f"{root}/p", "id", ["gender"], buckets)
    return f, p


def test_every_pair_of_an_id_counts_once(spark, tmp_out):
    got = {(r.city_code, r.gender): r["count"] for r in gender_by_city(*_pair(spark, tmp_out)).collect()}
    want = collections.Counter(
        (c, g) for i, c in FACT for j, g in PERSON if i is not None and j is not None and (i == j or (i != i and j != j))
    )
    assert got == dict(want)


def test_shares_of_a_city_add_up(spark, tmp_out):
    rows = gender_by_city(*_pair(spark, tmp_out)).groupBy("city_code").agg(F.sum("share_pct").alias("s")).collect()
    assert all(r.s == pytest.approx(100.0) for r in rows)


def test_neither_side_is_shuffled_for_the_join(spark, tmp_out):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f, p = _pair(spark, tmp_out)
        j = f.alias("l").join(p.alias("r"), F.col("l.join_key") == F.col("r.join_key"))
        assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
        plan = gender_by_city(f, p)._jdf.queryExecution().executedPlan().toString()
        # what is shuffled is partial sums by city and gender, after the join
        assert not re.search(r"Exchange hashpartitioning\(join_key", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_id_is_reduced_before_its_bucket(spark, tmp_out):
    fact = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("id"),
        F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("city_code"),
    )
    t = write_bucketed(fact, f"{tmp_out}/f", "id", ["city_code"], 4)
    assert t.where(F.col("join_key") == "0.0").count() == 5
    assert t.agg(F.sum("n_rows")).first()[0] == 30_000


def test_a_later_application_opens_the_tables(spark, tmp_out):
    f, p = _pair(spark, tmp_out)
    by = [F.col("l.city_code"), F.col("r.gender")]
    again = [open_bucketed(spark, f"{tmp_out}/{n}", t.schema, 4) for n, t in (("f", f), ("p", p))]
    assert sorted(map(repr, joined_counts(*again, by).collect())) == sorted(map(repr, joined_counts(f, p, by).collect()))
    assert len([n for n in os.listdir(f"{tmp_out}/f") if n.endswith(".parquet")]) <= 4


def test_empty_tables_and_clashing_columns(spark, tmp_out):
    assert gender_by_city(*_pair(spark, tmp_out, [], [])).collect() == []
    with pytest.raises(ValueError):
        write_bucketed(spark.createDataFrame([(1, 2)], "id int, N_ROWS int"), f"{tmp_out}/x", "id", ["N_ROWS"], 2)
