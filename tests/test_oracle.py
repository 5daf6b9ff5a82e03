"""Every query of the catalog against its DuckDB SQL (the driver's gate),
on the smallest tables; tests/compare.py is the comparison."""

import pytest
from compare import compare, duck, type_diff
from conftest import SF_SMALL

import __spark_entry__ as entry
import oracle
from portmart.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    sql = entry.oracle_sql()[name]
    assert type_diff(df, con, sql) == {}
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["city_name", "state_code", "total_pop", "count"]
    assert df.count() > 0


ALT_CONF = {
    "spark.sql.session.timeZone": "America/Los_Angeles",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "200",
}


@pytest.mark.parametrize(
    "name", ["sas_day_to_date", "calendar_dim", "stage_temperature", "cast_string_long", "q_share_vs_volume", "src_parquet"]
)
def test_results_do_not_depend_on_session_settings(spark, con, name):
    before = {k: spark.conf.get(k) for k in ALT_CONF}
    try:
        for k, v in ALT_CONF.items():
            spark.conf.set(k, v)
        ok, msg = compare(entry.queries()[name](spark, SF_SMALL), con, entry.oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ok, msg
