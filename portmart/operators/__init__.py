"""DataFrame -> DataFrame operators."""

from portmart.operators.aggregates import (
    count_distinct,
    count_rows,
    distinct_projection,
    group_count,
)
from portmart.operators.cleaning import (
    RACE_COLUMNS,
    clean_arrivals,
    clean_demographics,
    clean_temperature,
    dedup_rows,
    drop_null,
    keep_equal,
    pivot_sum,
)
from portmart.operators.decode import decode
from portmart.operators.joins import join_on_keys, join_using_distinct
from portmart.operators.lookup import first_match_code, substring_codes
from portmart.operators.mart import (
    calendar_dim,
    dim_city,
    dim_city_metric,
    dim_person,
    fact_table,
)
from portmart.operators.ordering import order_by_desc, top_k
from portmart.operators.quality import primary_key_check, quality_report, run_checks
from portmart.operators.staging import (
    stage_arrivals,
    stage_demographics,
    stage_temperature,
)

__all__ = [
    "RACE_COLUMNS",
    "calendar_dim",
    "clean_arrivals",
    "clean_demographics",
    "clean_temperature",
    "count_distinct",
    "count_rows",
    "decode",
    "dedup_rows",
    "dim_city",
    "dim_city_metric",
    "dim_person",
    "distinct_projection",
    "drop_null",
    "fact_table",
    "first_match_code",
    "group_count",
    "join_on_keys",
    "join_using_distinct",
    "keep_equal",
    "order_by_desc",
    "pivot_sum",
    "primary_key_check",
    "quality_report",
    "run_checks",
    "stage_arrivals",
    "stage_demographics",
    "stage_temperature",
    "substring_codes",
    "top_k",
]
