"""DuckDB oracle: for every query of the catalog, the same result written
as plain SQL over the driver's tables (views region, nation, customer,
supplier, part, orders, lineitem, events).

DuckDB differences handled here: dayofweek counts Sunday as 0; calendar
parts are BIGINT; SUM(BIGINT) is HUGEINT; '/ 0' is not an error (NULLIF);
casting a decimal to BIGINT rounds (trunc first); min_by is arg_min.
"""

from __future__ import annotations

import datetime as _dt

_EPOCH = _dt.date(1960, 1, 1)
_MIN_DAYS = (_dt.date.min - _EPOCH).days
_MAX_DAYS = (_dt.date.max - _EPOCH).days


def _sas(x: str) -> str:
    return (
        f"CASE WHEN {x} <> 0 AND NOT isnan({x}) AND floor({x}) BETWEEN {_MIN_DAYS} AND {_MAX_DAYS} "
        f"THEN DATE '1960-01-01' + CAST(floor({x}) AS INTEGER) END"
    )


def _long(x: str) -> str:
    """A plain decimal number without its fraction, else NULL: everything
    from the point on is dropped as text, before any number is made."""
    plain = f"regexp_full_match({x}, '[ ]*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)[ ]*')"
    whole = f"trim(split_part({x}, '.', 1))"
    return (
        f"CASE WHEN {plain} THEN TRY_CAST(CASE WHEN {whole} IN ('', '+', '-') THEN '0' ELSE {whole} END AS BIGINT) END"
    )


def _flt(x: str) -> str:
    return f"TRY_CAST({x} AS FLOAT)"


_DAY = "date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE))"

ARRIVALS = f"""
arrivals AS (
  SELECT CAST(o.o_orderkey AS DOUBLE) AS cicid,
         CAST({_DAY} AS DOUBLE) AS arrdate,
         CAST({_DAY} AS DOUBLE) + CAST(o.o_orderkey % 30 AS DOUBLE) AS depdate,
         CAST(c.c_nationkey AS VARCHAR) AS i94port,
         c.c_mktsegment AS i94addr,
         CAST(o.o_custkey % 80 + 16 AS DOUBLE) AS i94bir,
         o.o_orderstatus AS gender,
         CAST(split_part(o.o_orderpriority, '-', 1) AS DOUBLE) AS i94visa,
         CAST(1.0 AS DOUBLE) AS "count"
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0) o
  JOIN customer c ON o.o_custkey = c.c_custkey
),
clean_arrivals AS (
  SELECT cicid, {_sas('arrdate')} AS arrdate, {_sas('depdate')} AS depdate,
         i94port, i94addr, i94bir, gender, i94visa, "count"
  FROM (SELECT DISTINCT * FROM arrivals)
),
stage_arrivals AS (
  SELECT DISTINCT cicid AS id, arrdate AS date, i94port AS city_code, i94addr AS state_code,
         i94bir AS age, gender, i94visa AS visa_type, "count"
  FROM clean_arrivals
),
fact AS (SELECT DISTINCT id, state_code, city_code, date, "count" FROM stage_arrivals),
person AS (SELECT id, age, gender, visa_type FROM stage_arrivals)"""

PORT_LABELS = """
port_labels AS (
  SELECT -n_nationkey AS ord, printf('N%02d', n_nationkey) AS code,
         n_name || '''S PORT, R' || CAST(n_regionkey AS VARCHAR) AS label
  FROM nation
)"""

TEMPERATURE = PORT_LABELS + """,
temperature AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'NaN'
              ELSE CAST(value AS VARCHAR) END AS "AverageTemperature",
         CAST(round(value / 7, 3) AS VARCHAR) AS "AverageTemperatureUncertainty",
         'NATION_' || CAST(user_id % 27 AS VARCHAR) AS "City",
         event_type AS "Country",
         CAST(user_id % 25 AS VARCHAR) || '.' || CAST(user_id % 2 AS VARCHAR) || 'N' AS "Latitude",
         CAST(user_id % 25 AS VARCHAR) || '.' || CAST(user_id % 3 AS VARCHAR) || 'W' AS "Longitude"
  FROM events
),
temp_kept AS (
  SELECT * FROM temperature WHERE "Country" = 'purchase' AND "AverageTemperature" IS NOT NULL
),
temp_codes AS (
  SELECT k.key, arg_min(l.code, l.ord) AS city_code
  FROM (SELECT DISTINCT lower("City") AS key FROM temp_kept WHERE "City" IS NOT NULL) k
  JOIN port_labels l ON contains(lower(l.label), k.key)
  GROUP BY k.key
),
clean_temperature AS (
  SELECT t.dt, """ + _flt('t."AverageTemperature"') + """ AS "AverageTemperature",
         """ + _flt('t."AverageTemperatureUncertainty"') + """ AS "AverageTemperatureUncertainty",
         t."City", t."Country", t."Latitude", t."Longitude", m.city_code,
         CAST(year(TRY_CAST(t.dt AS DATE)) AS INTEGER) AS year,
         CAST(month(TRY_CAST(t.dt AS DATE)) AS INTEGER) AS month
  FROM temp_kept t JOIN temp_codes m ON lower(t."City") = m.key
),
stage_temperature AS (
  SELECT DISTINCT TRY_CAST(dt AS DATE) AS date, year, month, city_code, "City" AS city_name,
         round("AverageTemperature", 2) AS avg_temperature,
         round("AverageTemperatureUncertainty", 2) AS avg_temperature_uncertainty,
         "Latitude" AS lat, "Longitude" AS long
  FROM clean_temperature
)"""

_RACES = [
    ("American Indian and Alaska Native", "american_indian_alaska_native_count"),
    ("Asian", "asian_count"),
    ("Black or African-American", "black_or_african_american_count"),
    ("Hispanic or Latino", "hispanic_or_latino_count"),
    ("White", "white_count"),
]
_DEMO_KEYS = [
    '"City"', "city_code", '"State"', '"State Code"', '"Median Age"', '"Male Population"',
    '"Female Population"', '"Total Population"', '"Number of Veterans"', '"Foreign-born"',
    '"Average Household Size"',
]

DEMOGRAPHICS = """
demographics AS (
  SELECT 'NATION_' || CAST(p_size % 27 AS VARCHAR) AS "City",
         'STATE_' || CAST(p_size % 3 AS VARCHAR) AS "State",
         CAST(p_size / 2 + 20 AS VARCHAR) AS "Median Age",
         CAST(p_size * 100 AS VARCHAR) AS "Male Population",
         CAST(p_size * 110 AS VARCHAR) AS "Female Population",
         CAST(p_size * 210 AS VARCHAR) AS "Total Population",
         CAST(p_size * 3 / 2 AS VARCHAR) AS "Number of Veterans",
         CASE WHEN p_partkey % 17 = 0 THEN '' ELSE CAST(p_size * 30 AS VARCHAR) END AS "Foreign-born",
         CAST(p_size / 8 AS VARCHAR) AS "Average Household Size",
         'S' || CAST(p_size % 3 AS VARCHAR) AS "State Code",
         CASE p_type WHEN 'ECONOMY' THEN 'American Indian and Alaska Native'
                     WHEN 'LARGE' THEN 'Asian'
                     WHEN 'MEDIUM' THEN 'Black or African-American'
                     WHEN 'PROMO' THEN 'Hispanic or Latino'
                     WHEN 'SMALL' THEN 'White' ELSE p_type END AS "Race",
         CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size AS VARCHAR) || '.7'
              ELSE CAST(p_size AS VARCHAR) END AS "Count"
  FROM part
),
demo_codes AS (
  SELECT k.key, arg_min(l.code, l.ord) AS city_code
  FROM (SELECT DISTINCT lower("City") AS key FROM demographics WHERE "City" IS NOT NULL) k
  JOIN port_labels l ON contains(lower(l.label), k.key)
  GROUP BY k.key
),
demo_typed AS (
  SELECT d."City", m.city_code, d."State", d."State Code",
         """ + _flt('d."Median Age"') + """ AS "Median Age",
         """ + _long('d."Male Population"') + """ AS "Male Population",
         """ + _long('d."Female Population"') + """ AS "Female Population",
         """ + _long('d."Total Population"') + """ AS "Total Population",
         """ + _long('d."Number of Veterans"') + """ AS "Number of Veterans",
         """ + _long('d."Foreign-born"') + """ AS "Foreign-born",
         """ + _flt('d."Average Household Size"') + """ AS "Average Household Size",
         d."Race", """ + _long('d."Count"') + """ AS "Count"
  FROM demographics d JOIN demo_codes m ON lower(d."City") = m.key
),
clean_demographics AS (
  SELECT """ + ", ".join(_DEMO_KEYS) + ", " + ", ".join(
    f"""CAST(SUM("Count") FILTER (WHERE "Race" = '{r}') AS BIGINT) AS "{r}\""""
    for r, _ in _RACES
) + """
  FROM demo_typed GROUP BY """ + ", ".join(_DEMO_KEYS) + """
),
stage_demographics AS (
  SELECT DISTINCT "City" AS city_name, city_code, "State" AS state_name, "State Code" AS state_code,
         round("Median Age", 2) AS median_age, "Male Population" AS male_pop,
         "Female Population" AS female_pop, "Total Population" AS total_pop,
         "Number of Veterans" AS veterans_count, "Foreign-born" AS foreign_born_count,
         round("Average Household Size", 2) AS avg_household_size, """ + ", ".join(
    f'"{r}" AS {c}' for r, c in _RACES
) + """
  FROM clean_demographics
)"""

CITY_DIM = """
city AS (
  SELECT CAST(g.c_nationkey AS VARCHAR) AS city_code, g.c_mktsegment AS state_code,
         n.n_name AS city_name, g.total_pop, g.foreign_born_count
  FROM (SELECT c_nationkey, c_mktsegment, COUNT(*) AS total_pop,
               COUNT(*) FILTER (WHERE c_acctbal > 5000) AS foreign_born_count
        FROM customer GROUP BY c_nationkey, c_mktsegment) g
  JOIN nation n ON g.c_nationkey = n.n_nationkey
),
fact_city AS (
  SELECT f.id, d.city_name, f.state_code, d.foreign_born_count, d.total_pop
  FROM fact f JOIN city d ON f.city_code = d.city_code AND f.state_code = d.state_code
)"""


def _dbl(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


_SIZE_VS_VOLUME = (
    "WITH" + ARRIVALS + "," + CITY_DIM + """
SELECT city_name, state_code, total_pop, COUNT(*) AS "count"
FROM fact_city GROUP BY city_name, state_code, total_pop
ORDER BY "count" DESC, city_name, state_code, total_pop"""
)

_SHARE_VS_VOLUME = (
    "WITH" + ARRIVALS + "," + CITY_DIM + """
SELECT city_name, state_code, foreign_born_count,
       foreign_born_count / NULLIF(total_pop, 0) * 100 AS foreign_born_pct, COUNT(*) AS "count"
FROM fact_city GROUP BY ALL
ORDER BY "count" DESC, city_name, state_code, foreign_born_count, foreign_born_pct"""
)

_PIVOT = ", ".join(
    f"CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) FILTER (WHERE o_orderstatus = '{s}') AS BIGINT) AS \"{s}\""
    for s in ("F", "O", "P")
)

_CITY_COLS = [
    "city_code", "state_code", "city_name", "state_name", "median_age", "male_pop", "female_pop",
    "total_pop", "veterans_count", "foreign_born_count", "avg_household_size",
    *[c for _, c in _RACES],
]


def _rank_correlation(rows: str, metric: str) -> str:
    return f"""WITH q AS ({rows}),
ranked AS (
  SELECT rank() OVER (ORDER BY {metric}) + (COUNT(*) OVER (PARTITION BY {metric}) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER (ORDER BY "count") + (COUNT(*) OVER (PARTITION BY "count") - 1) / 2.0::DOUBLE AS ry
  FROM q WHERE {metric} IS NOT NULL AND "count" IS NOT NULL)
SELECT round(corr(rx, ry), 6) AS rank_corr FROM ranked"""


SQL: dict[str, str] = {
    "src_parquet": "SELECT * FROM orders",
    "src_csv_comma": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""",
    "src_csv_semicolon": """
SELECT CAST(s_suppkey AS VARCHAR) AS supplier_key, s_name AS supplier_name,
       CAST(s_nationkey AS VARCHAR) AS nation_key, CAST(s_acctbal AS VARCHAR) AS account_balance
FROM supplier""",
    "label_table": """
SELECT row_number() OVER (ORDER BY p_partkey) AS ord, 'P' || CAST(p_partkey AS VARCHAR) AS code,
       p_name || '''s ' || p_brand AS label
FROM part""",
    "sink_parquet_overwrite": "SELECT * FROM customer",
    "sink_partitioned_1": "SELECT * FROM orders",
    "sink_partitioned_2": "SELECT * FROM orders",
    "sink_clustered": "SELECT * FROM orders",
    "sink_clustered_filter": """
SELECT * FROM orders WHERE o_custkey BETWEEN 1 AND 40
  AND CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) < DATE '1996-04-01'""",
    "count_distinct_sql": "SELECT COUNT(DISTINCT o_custkey) AS n_distinct FROM orders",
    "limit_rows": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    "stage_arrivals": "WITH" + ARRIVALS + "\nSELECT * FROM stage_arrivals",
    "stage_temperature": "WITH" + TEMPERATURE + "\nSELECT * REPLACE ("
    + "CAST(avg_temperature AS DOUBLE) AS avg_temperature, "
    + "CAST(avg_temperature_uncertainty AS DOUBLE) AS avg_temperature_uncertainty) FROM stage_temperature",
    "stage_demographics": "WITH" + PORT_LABELS + "," + DEMOGRAPHICS
    + "\nSELECT * REPLACE (CAST(median_age AS DOUBLE) AS median_age, "
    + "CAST(avg_household_size AS DOUBLE) AS avg_household_size) FROM stage_demographics",
    "case_insensitive_select": "SELECT c_custkey AS custkey, c_name AS name FROM customer",
    "replace_column": """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 0) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",
    "add_column": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month
FROM orders""",
    "project_columns": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "qualified_columns": """
SELECT c.c_custkey AS id, c.c_name AS customer_name, n.n_name AS nation_name, c.c_nationkey AS nation_key
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "pct_expression": "SELECT c_custkey, c_acctbal / NULLIF(c_nationkey, 0) * 100 AS pct FROM customer",
    "cast_string_float": """
SELECT o_orderkey,
       CAST(TRY_CAST(CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS FLOAT)
            AS DOUBLE) AS price_float
FROM orders""",
    "cast_string_long": "SELECT p_partkey, " + _long(
        "CASE WHEN p_partkey % 5 = 0 THEN '' "
        "WHEN p_partkey % 35 = 3 THEN CAST(p_partkey AS VARCHAR) || '.9999999' "
        "WHEN p_partkey % 35 = 4 THEN '-' || CAST(p_partkey AS VARCHAR) || '.99999999' "
        "WHEN p_partkey % 35 = 7 THEN CAST(p_partkey AS VARCHAR) || 'e3' WHEN p_partkey % 5 = 1 THEN '-' || CAST(p_retailprice AS VARCHAR) "
        "ELSE CAST(p_retailprice AS VARCHAR) END"
    ) + " AS price_long FROM part",
    "filter_equals": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "drop_nulls": "SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'",
    "join_using_distinct": """
SELECT DISTINCT c.c_custkey AS custkey, c.c_name, c.c_mktsegment, o.o_orderstatus
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""",
    "join_two_keys": """
WITH ps AS (
  SELECT l_partkey AS partkey, l_suppkey AS suppkey, COUNT(*) AS n_lines, SUM(l_quantity) AS total_qty
  FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS partkey, l.l_suppkey AS suppkey, ps.n_lines, ps.total_qty
FROM lineitem l JOIN ps ON l.l_partkey = ps.partkey AND l.l_suppkey = ps.suppkey""",
    "first_match_lookup": """
WITH names AS (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part
  UNION ALL SELECT p_partkey, lower(p_type) AS name FROM part),
m AS (
  SELECT k.key, arg_min(p.p_brand, p.p_partkey) AS code
  FROM (SELECT DISTINCT lower(name) AS key FROM names WHERE name IS NOT NULL) k
  JOIN part p ON contains(lower(p.p_name), k.key)
  GROUP BY k.key)
SELECT n.p_partkey, n.name, m.code AS city_code
FROM names n LEFT JOIN m ON lower(n.name) = m.key""",
    "dedup_rows": "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)",
    "distinct_projection": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "distinct_values": "SELECT DISTINCT p_type FROM part",
    "count_distinct": "SELECT COUNT(DISTINCT o_custkey) AS n_distinct FROM orders",
    "count_rows": "SELECT COUNT(*) AS n_rows FROM lineitem",
    "pivot_sum": f"SELECT o_custkey, {_PIVOT} FROM orders GROUP BY o_custkey",
    "group_count": """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS "count" FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "order_by_count": """
SELECT o_orderpriority, COUNT(*) AS "count" FROM orders GROUP BY o_orderpriority
ORDER BY "count" DESC, o_orderpriority""",
    "top_k": """
SELECT o_custkey, COUNT(*) AS "count" FROM orders GROUP BY o_custkey
ORDER BY "count" DESC, o_custkey LIMIT 7""",
    "order_by_metric": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey",
    "sas_day_to_date": """
WITH o AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)
                   + CASE WHEN o_orderkey % 2 = 0 THEN 0.5 ELSE -0.5 END END AS sas_day
  FROM orders)
SELECT o_orderkey, sas_day, """ + _sas("sas_day") + " AS arrival_date FROM o",
    "calendar_dim": "WITH" + ARRIVALS + """
SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
       CAST(year(date) AS INTEGER) AS year, CAST(dayofweek(date) + 1 AS INTEGER) AS weekday,
       CAST(weekofyear(date) AS INTEGER) AS week
FROM (SELECT DISTINCT date FROM stage_arrivals)""",
    "round_two": """
SELECT o_orderkey, round(o_totalprice / 7, 2) AS price_7th,
       CAST(round(CAST(o_totalprice / 1000 AS FLOAT), 2) AS DOUBLE) AS price_k_float
FROM orders""",
    "contains_filter": "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')",
    "date_iso_text": "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_day FROM orders",
    "clean_arrivals": "WITH" + ARRIVALS + "\nSELECT * FROM clean_arrivals",
    "clean_temperature": "WITH" + TEMPERATURE + """
SELECT * REPLACE (CAST("AverageTemperature" AS DOUBLE) AS "AverageTemperature",
                  CAST("AverageTemperatureUncertainty" AS DOUBLE) AS "AverageTemperatureUncertainty")
FROM clean_temperature""",
    "clean_demographics": "WITH" + PORT_LABELS + "," + DEMOGRAPHICS + """
SELECT * REPLACE (CAST("Median Age" AS DOUBLE) AS "Median Age",
                  CAST("Average Household Size" AS DOUBLE) AS "Average Household Size")
FROM clean_demographics""",
    "dim_person": "WITH" + ARRIVALS + "\nSELECT * FROM person",
    "dim_city": "WITH" + TEMPERATURE + "," + DEMOGRAPHICS + """
SELECT DISTINCT """ + ", ".join(
        f"CAST(d.{c} AS DOUBLE) AS {c}" if c in ("median_age", "avg_household_size") else f"d.{c}"
        for c in _CITY_COLS
    ) + """, t.lat, t.long
FROM stage_demographics d
JOIN (SELECT DISTINCT city_code, lat, long FROM stage_temperature) t ON d.city_code = t.city_code""",
    "dim_city_metric": "WITH" + TEMPERATURE + """
SELECT DISTINCT date, city_code, year, month, CAST(avg_temperature AS DOUBLE) AS avg_temperature,
       CAST(avg_temperature_uncertainty AS DOUBLE) AS avg_temperature_uncertainty
FROM stage_temperature""",
    "fact_table": "WITH" + ARRIVALS + "\nSELECT * FROM fact",
    "quality_report": """
WITH counts AS (
  SELECT 'nation' AS table_name, (SELECT COUNT(*) FROM nation) AS records
  UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders)
  UNION ALL SELECT 'no_orders', (SELECT COUNT(*) FROM orders WHERE o_orderkey < 0))
SELECT table_name, check_name,
       CAST(CASE WHEN check_name = 'exists' THEN 1 WHEN records > 0 THEN 1 ELSE 0 END AS INTEGER) AS passed,
       records
FROM counts, (VALUES ('exists'), ('has_records')) c(check_name)
UNION ALL SELECT 'missing', 'exists', CAST(0 AS INTEGER), CAST(NULL AS BIGINT)
UNION ALL SELECT 'missing', 'has_records', CAST(0 AS INTEGER), CAST(NULL AS BIGINT)""",
    "pipeline_report": "WITH" + ARRIVALS + "," + TEMPERATURE + "," + DEMOGRAPHICS + """,
dim_city AS (
  SELECT DISTINCT d.*, t.lat, t.long FROM stage_demographics d
  JOIN (SELECT DISTINCT city_code, lat, long FROM stage_temperature) t ON d.city_code = t.city_code),
counts AS (
  SELECT 'dim_immigrant' AS table_name, (SELECT COUNT(*) FROM person) AS records
  UNION ALL SELECT 'dim_city', (SELECT COUNT(*) FROM dim_city)
  UNION ALL SELECT 'dim_city_temp', (SELECT COUNT(*) FROM (
    SELECT DISTINCT date, city_code, year, month, avg_temperature, avg_temperature_uncertainty
    FROM stage_temperature))
  UNION ALL SELECT 'dim_time', (SELECT COUNT(*) FROM (SELECT DISTINCT date FROM stage_arrivals))
  UNION ALL SELECT 'fact_immigration', (SELECT COUNT(*) FROM fact))
SELECT table_name, check_name,
       CAST(CASE WHEN check_name = 'exists' THEN 1 WHEN records > 0 THEN 1 ELSE 0 END AS INTEGER) AS passed,
       records
FROM counts, (VALUES ('exists'), ('has_records')) c(check_name)""",
    "primary_key_check": """
SELECT 'orders' AS table_name, 'o_orderkey' AS key_column, COUNT(*) AS "rows",
       COUNT(DISTINCT o_orderkey) AS distinct_keys, COUNT(*) = COUNT(DISTINCT o_orderkey) AS is_unique
FROM orders
UNION ALL
SELECT 'lineitem', 'l_orderkey', COUNT(*), COUNT(DISTINCT l_orderkey), COUNT(*) = COUNT(DISTINCT l_orderkey)
FROM lineitem""",
    "q_share_vs_volume": _SHARE_VS_VOLUME,
    "q_size_vs_volume": _SIZE_VS_VOLUME,
    "popular_cities": "WITH" + ARRIVALS + "," + CITY_DIM + """
SELECT city_name, state_code, COUNT(*) AS "count" FROM fact_city GROUP BY city_name, state_code
ORDER BY "count" DESC, city_name, state_code LIMIT 10""",
    "gender_distribution": "WITH" + ARRIVALS + """
SELECT gender, COUNT(*) AS "count", COUNT(*) / SUM(COUNT(*)) OVER () * 100 AS share_pct
FROM person GROUP BY gender""",
    "average_age": "WITH" + ARRIVALS + """
SELECT city_code, AVG(age) AS avg_age, COUNT(age) AS n_with_age
FROM stage_arrivals GROUP BY city_code""",
    "share_correlation": "WITH q AS (" + _SHARE_VS_VOLUME + """)
SELECT round(corr(foreign_born_pct, CAST("count" AS DOUBLE)), 6) AS corr FROM q""",
    "decode_codes": "WITH" + ARRIVALS + """
SELECT f.*, COALESCE(r.r_name, 'All Other Codes') AS region_label
FROM fact f LEFT JOIN region r ON f.city_code = CAST(r.r_regionkey AS VARCHAR)""",
    "monthly_refresh": "WITH" + ARRIVALS + """
SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM fact""",
    "temperature_refresh": "WITH" + TEMPERATURE + """
SELECT DISTINCT date, city_code, year, month, CAST(avg_temperature AS DOUBLE) AS avg_temperature,
       CAST(avg_temperature_uncertainty AS DOUBLE) AS avg_temperature_uncertainty
FROM stage_temperature""",
    "size_correlation": "WITH q AS (" + _SIZE_VS_VOLUME + """)
SELECT round(corr(CAST(total_pop AS DOUBLE), CAST("count" AS DOUBLE)), 6) AS corr FROM q""",
    "size_rank_correlation": _rank_correlation(_SIZE_VS_VOLUME, "total_pop"),
    "share_rank_correlation": _rank_correlation(_SHARE_VS_VOLUME, "foreign_born_pct"),
    "arrival_temperature": "WITH" + ARRIVALS + "," + TEMPERATURE + """,
coded AS (SELECT * REPLACE (printf('N%02d', CAST(city_code AS INTEGER)) AS city_code) FROM fact),
readings AS (
  SELECT DISTINCT DATE '1995-02-01' + CAST(date_diff('day', DATE '2024-01-01', date) * 75 AS INTEGER) AS reading_at, city_code,
         CAST(avg_temperature AS DOUBLE) AS avg_temperature,
         CAST(avg_temperature_uncertainty AS DOUBLE) AS avg_temperature_uncertainty
  FROM stage_temperature),
latest AS (
  SELECT * FROM readings QUALIFY row_number() OVER (
    PARTITION BY city_code, reading_at
    ORDER BY avg_temperature DESC NULLS LAST, avg_temperature_uncertainty DESC NULLS LAST) = 1)
SELECT f.*, l.reading_at, l.avg_temperature, l.avg_temperature_uncertainty
FROM coded f ASOF LEFT JOIN latest l ON f.city_code = l.city_code AND f.date >= l.reading_at""",
    "label_lists": "WITH" + PORT_LABELS + """
SELECT '$i94prtl' AS section, code, label FROM port_labels
UNION ALL SELECT 'i94cntyl', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'i94model', CAST(r_regionkey AS VARCHAR), 'By ' || r_name FROM region
UNION ALL SELECT DISTINCT 'i94addrl', c_mktsegment, 'State of ' || c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT DISTINCT 'i94visa', split_part(o_orderpriority, '-', 1), split_part(o_orderpriority, '-', 2) FROM orders
UNION ALL VALUES ('i94cntyl', '99', 'All Other Codes'), ('i94addrl', '99', 'All Other Codes'), ('i94model', '9', 'Not reported')""",
    "lookup_many_names": """
WITH names AS (SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', '') AS name FROM customer),
m AS (
  SELECT k.key, arg_min(s.s_name, s.s_suppkey) AS code
  FROM (SELECT DISTINCT lower(name) AS key FROM names) k JOIN supplier s ON contains(lower(s.s_name), k.key)
  GROUP BY k.key)
SELECT n.c_custkey, n.name, m.code AS supplier_name FROM names n LEFT JOIN m ON lower(n.name) = m.key""",
    "lookup_long_labels": """
WITH labels AS (
  SELECT p_partkey // 500 AS ord, lower(string_agg(p_name, ' ' ORDER BY p_partkey)) AS label FROM part GROUP BY ALL),
names AS (
  SELECT p.p_partkey, concat_ws(' ', p.p_name, n.p_name) AS name
  FROM part p LEFT JOIN part n ON n.p_partkey = p.p_partkey + 1),
m AS (
  SELECT key, min(ord) AS ord
  FROM (SELECT DISTINCT lower(name) AS key FROM names) JOIN labels ON contains(label, key) GROUP BY key)
SELECT p_partkey, name, 'B' || m.ord AS bundle FROM names LEFT JOIN m ON lower(name) = m.key""",
    "q_share_by_share": _SHARE_VS_VOLUME,
    "q_size_by_population": _SIZE_VS_VOLUME,
    "q_size_top_cities": _SIZE_VS_VOLUME + " LIMIT 7",
    "average_age_overall": "WITH" + ARRIVALS + """
SELECT AVG(age) AS avg_age, COUNT(age) AS n_with_age FROM stage_arrivals""",
    "count_correlation": "WITH q AS (" + _SHARE_VS_VOLUME + """)
SELECT round(corr(CAST(foreign_born_count AS DOUBLE), CAST("count" AS DOUBLE)), 6) AS corr FROM q""",
    "decode_states": "WITH" + ARRIVALS + """
SELECT *, CASE WHEN state_code = 'BUILDING' THEN 'All Other Codes' ELSE 'State of ' || state_code END AS state_label
FROM fact""",
    "decode_modes": "WITH" + ARRIVALS + """
SELECT f.*, CASE WHEN f.city_code = '9' THEN 'Not reported' ELSE 'By ' || r.r_name END AS mode_label
FROM fact f LEFT JOIN region r ON f.city_code = CAST(r.r_regionkey AS VARCHAR)""",
    "decode_visas": "WITH" + ARRIVALS + """
SELECT p.*, CAST(CAST(visa_type AS BIGINT) AS VARCHAR) AS visa_code, v.label AS visa_label
FROM person p LEFT JOIN (
  SELECT DISTINCT split_part(o_orderpriority, '-', 1) AS code, split_part(o_orderpriority, '-', 2) AS label FROM orders
) v ON CAST(CAST(visa_type AS BIGINT) AS VARCHAR) = v.code""",
}

# The same tables, read back from a mart that the batch wrote, in either
# layout, or that batch and refresh wrote together.  Its arrivals carry the
# port codes and states of the other sources.
_MART_ARRIVALS = ARRIVALS.replace("CAST(c.c_nationkey AS VARCHAR) AS i94port", "printf('N%02d', c.c_nationkey) AS i94port").replace(
    "c.c_mktsegment AS i94addr", "'S' || CAST(o.o_custkey % 3 AS VARCHAR) AS i94addr"
)
for _name, _same in {
    "mart_person": "dim_person",
    "mart_city": "dim_city",
    "mart_city_metric": "dim_city_metric",
    "mart_calendar": "calendar_dim",
    "mart_fact": "fact_table",
    "mart_person_partitioned": "dim_person",
    "mart_city_partitioned": "dim_city",
    "mart_fact_partitioned": "fact_table",
    "refresh_after_batch_fact": "fact_table",
    "refresh_after_batch_person": "dim_person",
    "refresh_after_batch_calendar": "calendar_dim",
    "refresh_after_batch_fact_partitioned": "fact_table",
    "refresh_after_batch_person_partitioned": "dim_person",
}.items():
    SQL[_name] = SQL[_same].replace(ARRIVALS, _MART_ARRIVALS)

# Arrivals of which the months from 1998 on were issued again.
_REISSUED = f"{_DAY} >= 13880"
_REISSUED_ARRIVALS = ARRIVALS.replace(
    "o.o_custkey % 80 + 16", f"o.o_custkey % 80 + 16 + CASE WHEN {_REISSUED} THEN 2 ELSE 0 END"
).replace(
    "ON o.o_custkey = c.c_custkey", f"ON o.o_custkey = c.c_custkey WHERE NOT ({_REISSUED} AND c.c_mktsegment = 'MACHINERY')"
)
for _name, _same in {
    "refresh_replaced_fact": "fact_table",
    "refresh_replaced_person": "dim_person",
    "refresh_replaced_calendar": "calendar_dim",
}.items():
    SQL[_name] = SQL[_same].replace(ARRIVALS, _REISSUED_ARRIVALS)
SQL["refresh_distinct_fact"] = SQL["fact_table"]
SQL["refresh_distinct_person"] = SQL["dim_person"]
SQL["refresh_distinct_calendar"] = SQL["calendar_dim"]
SQL["refresh_demographics"] = SQL["dim_city"]

_CLEAN_FOUND = DEMOGRAPHICS.replace(
    f"""CAST(SUM("Count") FILTER (WHERE "Race" = '{_RACES[-1][0]}') AS BIGINT) AS "{_RACES[-1][0]}\"""",
    f"""CAST(SUM("Count") FILTER (WHERE "Race" = '{_RACES[-1][0]}') AS BIGINT) AS "{_RACES[-1][0]}",
         CAST(SUM("Count") FILTER (WHERE "Race" = 'STANDARD') AS BIGINT) AS "STANDARD\"""",
)
SQL["clean_demographics_found"] = SQL["clean_demographics"].replace(DEMOGRAPHICS, _CLEAN_FOUND)
SQL["pivot_found"] = "SELECT o_custkey, " + ", ".join(
    f"CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) FILTER (WHERE o_orderpriority = '{p}') AS BIGINT) AS \"{p}\""
    for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
) + " FROM orders GROUP BY o_custkey"
SQL["gender_by_city"] = "WITH" + _MART_ARRIVALS + """
SELECT f.city_code, p.gender, COUNT(*) AS "count",
       COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY f.city_code) * 100 AS share_pct
FROM fact f JOIN person p ON f.id = p.id GROUP BY f.city_code, p.gender"""

SQL["csv_kept_rows"] = "SELECT * FROM customer WHERE c_custkey % 10 NOT IN (3, 5, 7)"
SQL["csv_rejected_lines"] = """
WITH l AS (
  SELECT c_custkey % 10 AS kind, concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal) AS head, c_mktsegment
  FROM customer)
SELECT CASE kind WHEN 3 THEN head WHEN 5 THEN head || ',' || c_mktsegment || ',more'
            ELSE 'no' || head || ',' || c_mktsegment END AS line
FROM l WHERE kind IN (3, 5, 7)"""

# The analyses over the mart's own city dimension.
_MART_JOIN = (
    "WITH" + _MART_ARRIVALS + "," + TEMPERATURE + "," + DEMOGRAPHICS + """,
dim_city AS (
  SELECT DISTINCT d.*, t.lat, t.long FROM stage_demographics d
  JOIN (SELECT DISTINCT city_code, lat, long FROM stage_temperature) t ON d.city_code = t.city_code),
j AS (
  SELECT d.city_name, f.state_code, d.foreign_born_count, d.total_pop
  FROM fact f JOIN dim_city d ON f.city_code = d.city_code AND f.state_code = d.state_code)
"""
)
SQL["q_size_on_mart"] = (
    _MART_JOIN + 'SELECT city_name, state_code, total_pop, COUNT(*) AS "count" FROM j GROUP BY ALL'
)
SQL["q_share_on_mart"] = (
    _MART_JOIN
    + """SELECT city_name, state_code, foreign_born_count,
       foreign_born_count / NULLIF(total_pop, 0) * 100 AS foreign_born_pct, COUNT(*) AS "count"
FROM j GROUP BY ALL"""
)
