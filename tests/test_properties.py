"""Property tests."""

from conftest import SF_SMALL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portmart.operators import mart
from portmart.operators.joins import join_using_distinct
from portmart.plans import catalog

keys = st.sampled_from(["a", "b", "c", None])
small = st.integers(min_value=0, max_value=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(keys, small), min_size=0, max_size=12),
    right=st.lists(st.tuples(keys, small, small), min_size=0, max_size=20),
)
def test_pre_distinct_join_equals_join_then_distinct(spark, left, right):
    l_df = spark.createDataFrame(left, "k string, x int")
    r_df = spark.createDataFrame(right, "k string, lat int, lon int")
    ours = join_using_distinct(l_df, r_df, ["k"], ["lat", "lon"])
    plain = l_df.join(r_df, "k").select("k", "x", "lat", "lon").distinct()
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_star_schema_against_staging(spark):
    stg = catalog.stage_arrivals(spark, SF_SMALL)
    n_stg = stg.count()
    fact = mart.fact_table(stg)
    person = mart.dim_person(stg)
    time = mart.calendar_dim(stg)
    assert fact.count() == fact.distinct().count() <= n_stg
    assert person.count() == n_stg  # no dedup of its own
    assert time.count() == stg.select("date").distinct().count()
    # every fact row has its date in the time dimension
    assert fact.join(time, fact["date"].eqNullSafe(time["date"]), "left_anti").count() == 0
    # the dedup removed exactly the repeated orders
    raw = catalog.si.arrivals(spark, SF_SMALL)
    assert n_stg == raw.distinct().count() < raw.count()


def test_dims_are_distinct(spark):
    for name in ("dim_city", "dim_city_metric", "calendar_dim"):
        df = catalog.QUERIES[name](spark, SF_SMALL)
        assert df.count() == df.distinct().count(), name
    city = catalog.QUERIES["dim_city"](spark, SF_SMALL)
    assert city.where(F.col("city_code").isNull()).count() == 0
