"""One query per operator of the inventory, each reading the driver's
tables under ``sf_dir`` (or frames Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.functions.casts import lenient_float, lenient_long
from portmart.functions.dates import iso_date_text, sas_day_to_date
from portmart.functions.numeric import percentage, round2
from portmart.functions.text import contains_ci
from portmart.operators import aggregates as agg
from portmart.operators import cleaning, mart, quality, staging
from portmart.operators.asof import asof_join
from portmart.operators.colocated import write_bucketed
from portmart.operators.decode import decode
from portmart.operators.joins import join_on_keys, join_using_distinct
from portmart.operators.lookup import first_match_code, indexed_codes, substring_codes
from portmart.operators.ordering import order_by_desc, top_k
from portmart.operators.ranks import rank_correlation
from portmart.plans import analysis
from portmart.plans import standins as si
from portmart.config import PipelineConfig
from portmart.plans.pipeline import load_star, run_pipeline
from portmart.session import materialize, scratch_path
from portmart.sources.labels import label_table as parse_labels
from portmart.sources.labels import label_lists as parse_all_labels
from portmart.sources.labels import read_label_lines, visa_table, with_line_numbers
from portmart.sources.readers import ARRIVALS_SCHEMA, quarantine_delimited, read_arrivals, read_delimited, register_view
from portmart.streaming.refresh import refresh_arrivals, refresh_city_temperature
from portmart.sources.sinks import read_partitioned, write_clustered, write_partitioned, write_table
from portmart.streaming.distinct import stream_arrivals
from portmart.streaming.published import read_published, replace_arrivals, replace_demographics

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return si.table(spark, sf_dir, name)


# ---------------------------------------------------------------- sources


def src_parquet(spark, sf_dir):
    """Arrival-style reader: explicit schema, parquet format parameter."""
    return read_arrivals(spark, f"{sf_dir}/orders.parquet", fmt="parquet", schema=ORDERS_SCHEMA)


def src_csv_comma(spark, sf_dir):
    """customer written as comma text with a header, read back as text."""
    path = scratch_path(spark, "customer_csv")
    _t(spark, sf_dir, "customer").write.option("header", True).csv(path)
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in
         ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]]
    )
    return read_delimited(spark, path, schema, sep=",")


def src_csv_semicolon(spark, sf_dir):
    """supplier written as ';' text whose header names carry spaces and
    dashes, read back by position."""
    path = scratch_path(spark, "supplier_csv")
    s = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Supplier Key"),
        F.col("s_name").alias("Supplier Name"),
        F.col("s_nationkey").alias("Nation-key"),
        F.col("s_acctbal").alias("Account Balance"),
    )
    s.write.option("header", True).option("sep", ";").csv(path)
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in
         ["Supplier Key", "Supplier Name", "Nation-key", "Account Balance"]]
    )
    return read_delimited(spark, path, schema, sep=";").select(
        F.col("Supplier Key").alias("supplier_key"),
        F.col("Supplier Name").alias("supplier_name"),
        F.col("Nation-key").alias("nation_key"),
        F.col("Account Balance").alias("account_balance"),
    )


def _quarantined(spark, sf_dir):
    """customer written as comma text in which some lines lack the last
    field, some have one too many and some no number as key."""
    root = scratch_path(spark, "faulty_csv")
    key = F.col("c_custkey")
    names = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    line = (
        F.when(key % 10 == 3, F.concat_ws(",", *names[:-1]))
        .when(key % 10 == 5, F.concat_ws(",", *names, F.lit("more")))
        .when(key % 10 == 7, F.concat(F.lit("no"), F.concat_ws(",", *names)))
        .otherwise(F.concat_ws(",", *names))
    )
    _t(spark, sf_dir, "customer").select(line.alias("value")).write.text(f"{root}/landing")
    types = [T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType(), T.StringType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return quarantine_delimited(spark, f"{root}/landing", schema, f"{root}/parsed", header=False)


def csv_kept_rows(spark, sf_dir):
    return _quarantined(spark, sf_dir)[0]


def csv_rejected_lines(spark, sf_dir):
    return _quarantined(spark, sf_dir)[1].select("line")


def label_table(spark, sf_dir):
    """Port section parsed from a label file rendered from part."""
    path = si.part_port_labels(spark, sf_dir)
    lines = read_label_lines(spark, path)
    numbers = with_line_numbers(lines).select("line_no", "place")
    entries = parse_labels(lines)
    # Position within the section: two lines (comment, header) precede it.
    return entries.join(numbers, entries["ord"] == numbers["place"]).select(
        (F.col("line_no") - F.lit(2)).alias("ord"), "code", "label"
    )


def sink_parquet_overwrite(spark, sf_dir):
    """customer written twice in overwrite mode, read back."""
    path = scratch_path(spark, "customer_pq")
    c = _t(spark, sf_dir, "customer")
    write_table(c.where(F.col("c_custkey") < 0), path)
    write_table(c, path)
    return spark.read.parquet(path)


def sink_partitioned_1(spark, sf_dir):
    path = scratch_path(spark, "orders_by_status")
    orders = _t(spark, sf_dir, "orders")
    write_partitioned(orders, path, ["o_orderstatus"])
    return read_partitioned(spark, path, orders.schema)


def _clustered_orders(spark, sf_dir):
    path = scratch_path(spark, "orders_clustered")
    write_clustered(_t(spark, sf_dir, "orders"), path, ["o_orderdate", "o_custkey", "o_orderpriority"], 16)
    return spark.read.parquet(path)


def sink_clustered(spark, sf_dir):
    """orders written in blocks of date, customer and priority, read back."""
    return _clustered_orders(spark, sf_dir)


def sink_clustered_filter(spark, sf_dir):
    """One customer range of one quarter, read from the clustered files."""
    day = F.col("o_orderdate").cast("date")
    start, end = (F.lit(d).cast("date") for d in ("1996-01-01", "1996-04-01"))
    return _clustered_orders(spark, sf_dir).where(F.col("o_custkey").between(1, 40) & (day >= start) & (day < end))


def sink_partitioned_2(spark, sf_dir):
    path = scratch_path(spark, "orders_by_status_priority")
    orders = _t(spark, sf_dir, "orders")
    write_partitioned(orders, path, ["o_orderstatus", "o_orderpriority"])
    return read_partitioned(spark, path, orders.schema)


def count_distinct_sql(spark, sf_dir):
    view = f"orders_{abs(hash(sf_dir))}"
    register_view(_t(spark, sf_dir, "orders"), view)
    return spark.sql(f"SELECT COUNT(DISTINCT o_custkey) AS n_distinct FROM {view}")


def limit_rows(spark, sf_dir):
    """First ten customers by key (a look at the head of a table)."""
    return _t(spark, sf_dir, "customer").orderBy("c_custkey").limit(10)


# ---------------------------------------------- projections, casts, filters


def stage_arrivals(spark, sf_dir):
    return staging.stage_arrivals(cleaning.clean_arrivals(si.arrivals(spark, sf_dir)))


def _label_lines(spark, sf_dir):
    return read_label_lines(spark, si.nation_port_labels(spark, sf_dir))


def _port_codes(spark, sf_dir):
    return substring_codes(parse_labels(_label_lines(spark, sf_dir)))


def _clean_temperature(spark, sf_dir, codes=None):
    return cleaning.clean_temperature(
        si.temperature(spark, sf_dir), country=si.STANDIN_COUNTRY, codes=codes or _port_codes(spark, sf_dir)
    )


def _clean_demographics(spark, sf_dir, codes=None):
    return cleaning.clean_demographics(si.demographics(spark, sf_dir), codes=codes or _port_codes(spark, sf_dir))


def stage_temperature(spark, sf_dir):
    return _double_floats(staging.stage_temperature(_clean_temperature(spark, sf_dir)))


def stage_demographics(spark, sf_dir):
    return _double_floats(staging.stage_demographics(_clean_demographics(spark, sf_dir)))


def _double_floats(df: DataFrame) -> DataFrame:
    """FLOAT columns widened to DOUBLE for the comparison (exact)."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.FloatType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def case_insensitive_select(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select(F.col("C_CUSTKEY").alias("custkey"), F.col("C_Name").alias("name"))


def replace_column(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.withColumns(
        {
            "o_totalprice": F.round("o_totalprice", 0),
            "o_orderdate": F.to_date("o_orderdate"),
        }
    )


def add_column(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", "o_orderdate").withColumns(
        {"order_year": F.year(d), "order_month": F.month(d)}
    ).drop("o_orderdate")


def project_columns(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")


def qualified_columns(spark, sf_dir):
    """Both sides carry ``name`` and ``key``; qualified references pick
    each side's copy."""
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("key")
    )
    n = _t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")
    )
    j = join_on_keys(c, n, ["key"], "c", "n")
    return j.select(
        F.col("c.id").alias("id"),
        F.col("c.name").alias("customer_name"),
        F.col("n.name").alias("nation_name"),
        F.col("c.key").alias("nation_key"),
    )


def pct_expression(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", percentage("c_acctbal", "c_nationkey").alias("pct"))


def cast_string_float(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return o.select("o_orderkey", lenient_float(text).cast("double").alias("price_float"))


def cast_string_long(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    text = (
        F.when(F.col("p_partkey") % 5 == 0, F.lit(""))
        .when(F.col("p_partkey") % 35 == 3, F.concat(F.col("p_partkey").cast("string"), F.lit(".9999999")))
        .when(F.col("p_partkey") % 35 == 4, F.concat(F.lit("-"), F.col("p_partkey").cast("string"), F.lit(".99999999")))
        .when(F.col("p_partkey") % 35 == 7, F.concat(F.col("p_partkey").cast("string"), F.lit("e3")))
        .when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("-"), F.col("p_retailprice").cast("string")))
        .otherwise(F.col("p_retailprice").cast("string"))
    )
    return p.select("p_partkey", lenient_long(text).alias("price_long"))


def filter_equals(spark, sf_dir):
    return cleaning.keep_equal(_t(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


def drop_nulls(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    )
    return cleaning.drop_null(o, "status")


# ------------------------------------------------------------------ joins


def join_using_distinct_q(spark, sf_dir):
    """Customers with each distinct status of their orders."""
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"
    )
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderstatus")
    return join_using_distinct(c, o, ["custkey"], ["o_orderstatus"])


def join_two_keys(spark, sf_dir):
    """Line items joined to a (part, supplier)-keyed summary on both keys."""
    li = _t(spark, sf_dir, "lineitem")
    ps = li.groupBy(
        F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")
    ).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty"))
    # Written first, so the join shuffles both sides and can split a hot pair.
    ps = materialize(ps, "pair-summary")
    f = li.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")
    )
    j = join_on_keys(f, ps, ["partkey", "suppkey"], "f", "d")
    return j.select(
        "f.l_orderkey", "f.l_linenumber", F.col("f.partkey").alias("partkey"),
        F.col("f.suppkey").alias("suppkey"), "d.n_lines", "d.total_qty",
    )


def _part_names(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    words = p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("name"))
    types = p.select("p_partkey", F.lower("p_type").alias("name"))
    return words.unionByName(types)


def first_match_lookup(spark, sf_dir):
    """Words of part names (and part types) looked up in the part names:
    code of the first part, by key, whose name contains the word."""
    labels = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_brand").alias("code"), F.col("p_name").alias("label")
    )
    return first_match_code(_part_names(spark, sf_dir), "name", labels, "city_code")


def lookup_many_names(spark, sf_dir):
    """Every customer's name looked up in labels made of suppliers' names, so
    the distinct names grow with the data: the customer's number without
    leading zeros is searched in the labels."""
    labels = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ord"), F.col("s_name").alias("code"), F.col("s_name").alias("label")
    )
    c = _t(spark, sf_dir, "customer").select(
        "c_custkey", F.regexp_replace("c_name", "^Customer#0*", "").alias("name")
    )
    return first_match_code(c, "name", labels, "supplier_name")


def lookup_long_labels(spark, sf_dir):
    """The names of a part and the next one, together, looked up in labels
    that each join the names of five hundred parts: some thousand characters."""
    p = _t(spark, sf_dir, "part")
    bundle = F.floor(F.col("p_partkey") / 500)
    held = p.groupBy(bundle.alias("ord")).agg(F.sort_array(F.collect_list(F.struct("p_partkey", "p_name"))).alias("w"))
    labels = held.select(
        "ord",
        F.format_string("B%d", "ord").alias("code"),
        F.array_join(F.transform("w", lambda x: x["p_name"]), " ").alias("label"),
    )
    after = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("_next"))
    names = p.join(after, "p_partkey", "left").select("p_partkey", F.concat_ws(" ", "p_name", "_next").alias("name"))
    codes = indexed_codes(names, "name", labels)
    return first_match_code(names, "name", out_col="bundle", codes=codes)


# ------------------------------------------------ distinct and aggregation


def dedup_rows(spark, sf_dir):
    return cleaning.dedup_rows(si.orders_with_repeats(spark, sf_dir))


def distinct_projection(spark, sf_dir):
    return agg.distinct_projection(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


def distinct_values(spark, sf_dir):
    return agg.distinct_projection(_t(spark, sf_dir, "part"), ["p_type"])


def count_distinct(spark, sf_dir):
    return agg.count_distinct(_t(spark, sf_dir, "orders"), "o_custkey")


def count_rows(spark, sf_dir):
    return agg.count_rows(_t(spark, sf_dir, "lineitem"))


def pivot_sum(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn(
        "amount", F.round("o_totalprice").cast("bigint")
    )
    return cleaning.pivot_sum(o, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "amount")


def pivot_found(spark, sf_dir):
    """Order totals per customer, a column for each priority in the data."""
    o = _t(spark, sf_dir, "orders").withColumn("amount", F.round("o_totalprice").cast("bigint"))
    return cleaning.pivot_sum_found(o, ["o_custkey"], "o_orderpriority", "amount")


def clean_demographics_found(spark, sf_dir):
    """City demographics with a column for every race in the data."""
    rows = si.demographics(spark, sf_dir)
    return _double_floats(cleaning.clean_demographics(rows, codes=_port_codes(spark, sf_dir), found=True))


def group_count(spark, sf_dir):
    return agg.group_count(_t(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


# ------------------------------------------------------------ sort, top-k


def order_by_count(spark, sf_dir):
    g = agg.group_count(_t(spark, sf_dir, "orders"), ["o_orderpriority"])
    return order_by_desc(g, "count", ["o_orderpriority"])


def top_k_q(spark, sf_dir):
    g = agg.group_count(_t(spark, sf_dir, "orders"), ["o_custkey"])
    return top_k(g, "count", 7, ["o_custkey"])


def order_by_metric(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return order_by_desc(c, "c_acctbal", ["c_custkey"])


# ---------------------------------------------------------------- scalars


def sas_day_to_date_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", si.sas_day("o_orderdate").alias("sas_day"))
    # Half days and zero: the fraction is floored, zero means "no date".
    sas = F.when(F.col("o_orderkey") % 7 == 0, F.lit(0.0)).otherwise(
        F.col("sas_day") + F.when(F.col("o_orderkey") % 2 == 0, F.lit(0.5)).otherwise(F.lit(-0.5))
    )
    return o.select("o_orderkey", sas.alias("sas_day"), sas_day_to_date(sas).alias("arrival_date"))


def calendar_dim_q(spark, sf_dir):
    return mart.calendar_dim(stage_arrivals(spark, sf_dir))


def round_two(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        round2(F.col("o_totalprice") / 7).alias("price_7th"),
        round2((F.col("o_totalprice") / 1000).cast("float")).cast("double").alias("price_k_float"),
    )


def contains_filter(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.where(contains_ci("p_name", F.lit("RING"))).select("p_partkey", "p_name")


def date_iso_text(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", iso_date_text(F.to_date("o_orderdate")).alias("order_day"))


# ------------------------------------------------------------- composites


def clean_arrivals(spark, sf_dir):
    return cleaning.clean_arrivals(si.arrivals(spark, sf_dir))


def clean_temperature(spark, sf_dir):
    return _double_floats(_clean_temperature(spark, sf_dir))


def clean_demographics(spark, sf_dir):
    return _double_floats(_clean_demographics(spark, sf_dir))


def dim_person(spark, sf_dir):
    return mart.dim_person(stage_arrivals(spark, sf_dir))


def dim_city(spark, sf_dir):
    codes = _port_codes(spark, sf_dir)
    temp = staging.stage_temperature(_clean_temperature(spark, sf_dir, codes))
    demo = staging.stage_demographics(_clean_demographics(spark, sf_dir, codes))
    return _double_floats(mart.dim_city(demo, temp))


def dim_city_metric(spark, sf_dir):
    return _double_floats(mart.dim_city_metric(staging.stage_temperature(_clean_temperature(spark, sf_dir))))


def fact_table(spark, sf_dir):
    return mart.fact_table(stage_arrivals(spark, sf_dir))


def quality_report(spark, sf_dir):
    tables = {
        "nation": _t(spark, sf_dir, "nation"),
        "orders": _t(spark, sf_dir, "orders"),
        "no_orders": _t(spark, sf_dir, "orders").where(F.col("o_orderkey") < 0),
        "missing": None,
    }
    return quality.quality_report(spark, tables)


def primary_key_check(spark, sf_dir):
    o = quality.primary_key_check(_t(spark, sf_dir, "orders"), "o_orderkey", "orders")
    li = quality.primary_key_check(_t(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem")
    return o.unionByName(li)


def _fact_and_city(spark, sf_dir):
    return fact_table(spark, sf_dir), materialize(si.city_dimension(spark, sf_dir), "city-dimension")


def q_share_vs_volume(spark, sf_dir):
    return analysis.share_vs_volume(*_fact_and_city(spark, sf_dir))


def q_size_vs_volume(spark, sf_dir):
    return analysis.size_vs_volume(*_fact_and_city(spark, sf_dir))


def q_share_by_share(spark, sf_dir):
    """The share analysis in order of the share."""
    return analysis.share_vs_volume(*_fact_and_city(spark, sf_dir), by="foreign_born_pct")


def q_size_by_population(spark, sf_dir):
    """The size analysis in order of the population."""
    return analysis.size_vs_volume(*_fact_and_city(spark, sf_dir), by="total_pop")


def q_size_top_cities(spark, sf_dir):
    """The seven cities with most arrivals, next to their population."""
    return analysis.size_vs_volume(*_fact_and_city(spark, sf_dir), k=7)


def popular_cities(spark, sf_dir):
    return analysis.popular_cities(*_fact_and_city(spark, sf_dir), k=10)


def gender_distribution(spark, sf_dir):
    return analysis.gender_distribution(dim_person(spark, sf_dir))


def gender_by_city(spark, sf_dir):
    """The mart's fact and person, bucketed on the id, joined on it."""
    star = _mart(spark, sf_dir, "flat")
    root, buckets = scratch_path(spark, "by_id"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = write_bucketed(star["fact_immigration"], f"{root}/fact", "id", ["city_code"], buckets)
    person = write_bucketed(star["dim_immigrant"], f"{root}/person", "id", ["gender"], buckets)
    return analysis.gender_by_city(fact, person)


def average_age(spark, sf_dir):
    return analysis.average_age(stage_arrivals(spark, sf_dir), by="city_code")


def average_age_overall(spark, sf_dir):
    return analysis.average_age(stage_arrivals(spark, sf_dir), by=None)


def size_correlation(spark, sf_dir):
    return analysis.correlation(q_size_vs_volume(spark, sf_dir), "total_pop").select(
        F.round("corr", 6).alias("corr")
    )


def size_rank_correlation(spark, sf_dir):
    return _rounded_rank(q_size_vs_volume(spark, sf_dir), "total_pop")


def share_rank_correlation(spark, sf_dir):
    return _rounded_rank(q_share_vs_volume(spark, sf_dir), "foreign_born_pct")


def _rounded_rank(df: DataFrame, metric: str) -> DataFrame:
    return rank_correlation(df, metric, "count").select(F.round("rank_corr", 6).alias("rank_corr"))


def arrival_temperature(spark, sf_dir):
    """Every arrival with the latest reading of its port's city on or before
    its date.  The arrivals have nation keys as ports, made codes of the
    readings here; the readings' month is stretched over the arrivals' years,
    75 days for a day."""
    fact = fact_table(spark, sf_dir).withColumn("city_code", F.format_string("N%02d", F.col("city_code").cast("int")))
    day = F.datediff("date", F.lit("2024-01-01").cast("date"))
    readings = dim_city_metric(spark, sf_dir).withColumn("date", F.date_add(F.lit("1995-02-01").cast("date"), day * 75))
    values = ["avg_temperature", "avg_temperature_uncertainty"]
    return asof_join(fact, readings, ["city_code"], "date", values, F.year("date"))


# Marts written in this process, by application, tables and layout.
_MARTS: dict[tuple, PipelineConfig | str] = {}


def _source_files(spark, sf_dir, root) -> PipelineConfig:
    """The stand-in sources written as files (arrivals parquet, temperatures
    as comma text, demographics as ';' text, the label file)."""
    si.arrivals(spark, sf_dir, mart_codes=True).write.parquet(f"{root}/src/arrivals")
    si.temperature(spark, sf_dir).write.option("header", True).csv(f"{root}/src/temperature")
    si.demographics(spark, sf_dir).write.option("header", True).option("sep", ";").csv(
        f"{root}/src/demographics"
    )
    return PipelineConfig(
        arrivals_path=f"{root}/src/arrivals",
        temperature_path=f"{root}/src/temperature",
        demographics_path=f"{root}/src/demographics",
        labels_path=si.nation_port_labels(spark, sf_dir),
        output_dir=f"{root}/mart",
        country=si.STANDIN_COUNTRY,
    )


def _mart(spark, sf_dir, layout) -> dict[str, DataFrame]:
    """The star schema of one run of the batch, read back; the queries over
    it share the run."""
    key = (spark.sparkContext.applicationId, sf_dir, layout)
    if key not in _MARTS:
        cfg = replace(_source_files(spark, sf_dir, scratch_path(spark, "mart")), layout=layout)
        run_pipeline(spark, cfg)
        _MARTS[key] = cfg
    return load_star(spark, _MARTS[key])


def _mart_table(name, layout):
    def query(spark, sf_dir):
        return _double_floats(_typed(_mart(spark, sf_dir, layout)[name]))

    return query


def _typed(df: DataFrame) -> DataFrame:
    """Folder values are read as text; the person's age is a number."""
    return df.withColumn("age", F.col("age").cast("double")) if "age" in df.columns else df


def q_share_on_mart(spark, sf_dir):
    star = _mart(spark, sf_dir, "flat")
    return analysis.share_vs_volume(star["fact_immigration"], star["dim_city"])


def q_size_on_mart(spark, sf_dir):
    star = _mart(spark, sf_dir, "partitioned")
    return analysis.size_vs_volume(star["fact_immigration"], star["dim_city"])


def pipeline_report(spark, sf_dir):
    """The whole batch on the stand-in sources written as files; the checks
    of the star schema, counted while it was written."""
    cfg = _source_files(spark, sf_dir, scratch_path(spark, "pipeline"))
    return spark.createDataFrame(run_pipeline(spark, cfg).report, quality.REPORT_SCHEMA)


def share_correlation(spark, sf_dir):
    return analysis.correlation(q_share_vs_volume(spark, sf_dir), "foreign_born_pct").select(
        F.round("corr", 6).alias("corr")
    )


def count_correlation(spark, sf_dir):
    return analysis.correlation(q_share_vs_volume(spark, sf_dir), "foreign_born_count").select(
        F.round("corr", 6).alias("corr")
    )


def decode_states(spark, sf_dir):
    """Arrival states decoded; states not listed read as the entry 99."""
    states = parse_labels(_label_lines(spark, sf_dir), "i94addrl")
    return decode(fact_table(spark, sf_dir), "state_code", states, "state_label", default_code="99")


def decode_modes(spark, sf_dir):
    """Port numbers read as travel modes; a code that is not listed has no
    label."""
    modes = parse_labels(_label_lines(spark, sf_dir), "i94model")
    return decode(fact_table(spark, sf_dir), "city_code", modes, "mode_label")


def decode_visas(spark, sf_dir):
    """Persons' visa categories decoded with the list kept in a comment."""
    person = dim_person(spark, sf_dir).withColumn("visa_code", F.col("visa_type").cast("bigint").cast("string"))
    return decode(person, "visa_code", visa_table(_label_lines(spark, sf_dir)), "visa_label")


def decode_codes(spark, sf_dir):
    """Arrival port codes decoded with the country list of the label file;
    codes it does not list read as its catch-all entry 99."""
    countries = parse_labels(_label_lines(spark, sf_dir), "i94cntyl")
    return decode(fact_table(spark, sf_dir), "city_code", countries, "region_label", default_code="99")


def label_lists(spark, sf_dir):
    """All five lists of the label file, from one scan of it."""
    return parse_all_labels(_label_lines(spark, sf_dir)).select("section", "code", "label")


def _landed_files(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def monthly_refresh(spark, sf_dir):
    """Arrival files landed in date order (as many as the session's shuffle
    partitions) and drained by the streaming refresh in about four
    micro-batches; the fact table read back, with its year and month."""
    root = scratch_path(spark, "refresh")
    n_files = _landed_files(spark)
    si.arrivals(spark, sf_dir).repartitionByRange(n_files, "arrdate").write.parquet(f"{root}/landing")
    refresh_arrivals(spark, f"{root}/landing", f"{root}/mart", max_files_per_batch=max(1, -(-n_files // 4)))
    fact = read_partitioned(spark, f"{root}/mart/immigration", fact_table(spark, sf_dir).schema)
    return fact.withColumns({"year": F.year("date"), "month": F.month("date")})


def temperature_refresh(spark, sf_dir):
    """Temperature files (comma text) landed in date order and drained by
    the streaming refresh in about four micro-batches; the city temperature
    table read back."""
    root = scratch_path(spark, "temperature_refresh")
    n_files = _landed_files(spark)
    rows = si.temperature(spark, sf_dir).repartitionByRange(n_files, "dt")
    rows.write.option("header", True).csv(f"{root}/landing")
    refresh_city_temperature(
        spark, f"{root}/landing", si.nation_port_labels(spark, sf_dir), f"{root}/mart",
        country=si.STANDIN_COUNTRY, max_files_per_batch=max(1, -(-n_files // 4)),
    )
    return _double_floats(spark.read.parquet(f"{root}/mart/city_temperature"))


def _refreshed(layout):
    """The batch over the arrivals up to the middle of their dates, then the
    refresh with the later files: the mart's tables."""
    key = ("refreshed", layout)

    def tables(spark, sf_dir) -> dict[str, DataFrame]:
        at = (spark.sparkContext.applicationId, sf_dir, *key)
        if at not in _MARTS:
            root = scratch_path(spark, "refreshed")
            cfg = replace(_source_files(spark, sf_dir, root), layout=layout, arrivals_path=f"{root}/first")
            rows = spark.read.schema(ARRIVALS_SCHEMA).parquet(f"{root}/src/arrivals")
            middle = rows.agg(F.percentile_approx("arrdate", 0.5)).scalar()
            early = F.col("arrdate") <= middle
            rows.where(early).write.parquet(cfg.arrivals_path)
            n_files = _landed_files(spark)
            # The landed files repeat a week of the first ones.
            late = rows.where(F.col("arrdate") > middle - 7)
            late.repartitionByRange(n_files, "arrdate").write.parquet(f"{root}/landing")
            run_pipeline(spark, cfg)
            refresh_arrivals(
                spark, f"{root}/landing", cfg.output_dir, layout=layout, max_files_per_batch=max(1, -(-n_files // 2))
            )
            _MARTS[at] = cfg
        return load_star(spark, _MARTS[at])

    return tables


def _refreshed_table(name, layout):
    def query(spark, sf_dir):
        return _typed(_refreshed(layout)(spark, sf_dir)[name])

    return query


def _replaced_months(spark, sf_dir) -> str:
    """A mart of three deliveries: all arrivals, then the months from the
    middle on issued again with every person two years older and without the
    records of the last state, then an old issue that comes late."""
    at = (spark.sparkContext.applicationId, sf_dir, "replaced")
    if at not in _MARTS:
        root = scratch_path(spark, "replaced")
        rows = si.arrivals(spark, sf_dir)
        late = F.col("arrdate") >= si.REISSUED_FROM
        again = rows.where(late & (F.col("i94addr") != si.WITHDRAWN_STATE)).withColumn("i94bir", F.col("i94bir") + 2)
        # More files than a micro-batch takes, so an issue comes in pieces.
        n_files = _landed_files(spark)
        rows.repartition(n_files).write.parquet(f"{root}/landing/issue=2")
        replace_arrivals(spark, f"{root}/landing", f"{root}/mart", max_files_per_batch=max(1, -(-n_files // 2)))
        again.repartitionByRange(n_files, "arrdate").write.parquet(f"{root}/landing/issue=3")
        replace_arrivals(spark, f"{root}/landing", f"{root}/mart")
        rows.where(late).write.parquet(f"{root}/landing/issue=1")
        replace_arrivals(spark, f"{root}/landing", f"{root}/mart")
        _MARTS[at] = f"{root}/mart"
    return _MARTS[at]


def _replaced_table(table, schema_of):
    def query(spark, sf_dir):
        schema = schema_of(stage_arrivals(spark, sf_dir)).schema
        return read_published(spark, _replaced_months(spark, sf_dir), table, schema).drop("part")

    return query


def _streamed_twice(spark, sf_dir) -> str:
    """Arrival files landed in date order and streamed in, then all landed and
    streamed in again."""
    at = (spark.sparkContext.applicationId, sf_dir, "streamed")
    if at not in _MARTS:
        root = scratch_path(spark, "streamed")
        n_files = _landed_files(spark)
        # The customers grow too: they do not go through the driver.  Joined once:
        # each landing reads the rows twice, for the bounds and to deal them.
        rows = materialize(si.arrivals(spark, sf_dir, join="merge"), "arrivals")
        for _ in range(2):
            rows.repartitionByRange(n_files, "arrdate").write.mode("append").parquet(f"{root}/landing")
            stream_arrivals(spark, f"{root}/landing", f"{root}/mart", max_files_per_batch=max(1, -(-n_files // 2)))
        _MARTS[at] = f"{root}/mart"
    return _MARTS[at]


def _streamed_table(table):
    def query(spark, sf_dir):
        return spark.read.parquet(f"{_streamed_twice(spark, sf_dir)}/{table}")

    return query


def refresh_demographics(spark, sf_dir):
    """Demographics delivered twice, first with wrong counts, then in several
    files; the city table afterwards."""
    root = scratch_path(spark, "demographics_refresh")
    codes = _port_codes(spark, sf_dir)
    temp = materialize(staging.stage_temperature(_clean_temperature(spark, sf_dir, codes)), "temperature")
    rows = si.demographics(spark, sf_dir)

    def land(issue, df):
        df.write.option("header", True).option("sep", ";").csv(f"{root}/landing/issue={issue}")
        replace_demographics(spark, f"{root}/landing", f"{root}/mart", codes, temp, max_files_per_batch=2)

    land(1, rows.withColumn("Count", F.lit("1")))
    land(2, rows.repartition(4))
    schema = mart.dim_city(staging.stage_demographics(_clean_demographics(spark, sf_dir, codes)), temp).schema
    return _double_floats(read_published(spark, f"{root}/mart", "city", schema).drop("part"))


QUERIES: dict[str, Query] = {
    "src_parquet": src_parquet,
    "src_csv_comma": src_csv_comma,
    "src_csv_semicolon": src_csv_semicolon,
    "csv_kept_rows": csv_kept_rows,
    "csv_rejected_lines": csv_rejected_lines,
    "label_table": label_table,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "sink_partitioned_1": sink_partitioned_1,
    "sink_partitioned_2": sink_partitioned_2,
    "sink_clustered": sink_clustered,
    "sink_clustered_filter": sink_clustered_filter,
    "count_distinct_sql": count_distinct_sql,
    "limit_rows": limit_rows,
    "stage_arrivals": stage_arrivals,
    "stage_temperature": stage_temperature,
    "stage_demographics": stage_demographics,
    "case_insensitive_select": case_insensitive_select,
    "replace_column": replace_column,
    "add_column": add_column,
    "project_columns": project_columns,
    "qualified_columns": qualified_columns,
    "pct_expression": pct_expression,
    "cast_string_float": cast_string_float,
    "cast_string_long": cast_string_long,
    "filter_equals": filter_equals,
    "drop_nulls": drop_nulls,
    "join_using_distinct": join_using_distinct_q,
    "join_two_keys": join_two_keys,
    "first_match_lookup": first_match_lookup,
    "lookup_many_names": lookup_many_names,
    "lookup_long_labels": lookup_long_labels,
    "dedup_rows": dedup_rows,
    "distinct_projection": distinct_projection,
    "distinct_values": distinct_values,
    "count_distinct": count_distinct,
    "count_rows": count_rows,
    "pivot_sum": pivot_sum,
    "pivot_found": pivot_found,
    "group_count": group_count,
    "order_by_count": order_by_count,
    "top_k": top_k_q,
    "order_by_metric": order_by_metric,
    "sas_day_to_date": sas_day_to_date_q,
    "calendar_dim": calendar_dim_q,
    "round_two": round_two,
    "contains_filter": contains_filter,
    "date_iso_text": date_iso_text,
    "clean_arrivals": clean_arrivals,
    "clean_temperature": clean_temperature,
    "clean_demographics": clean_demographics,
    "clean_demographics_found": clean_demographics_found,
    "dim_person": dim_person,
    "dim_city": dim_city,
    "dim_city_metric": dim_city_metric,
    "fact_table": fact_table,
    "quality_report": quality_report,
    "pipeline_report": pipeline_report,
    "primary_key_check": primary_key_check,
    "q_share_vs_volume": q_share_vs_volume,
    "q_size_vs_volume": q_size_vs_volume,
    "q_share_by_share": q_share_by_share,
    "q_size_by_population": q_size_by_population,
    "q_size_top_cities": q_size_top_cities,
    "popular_cities": popular_cities,
    "gender_distribution": gender_distribution,
    "gender_by_city": gender_by_city,
    "average_age": average_age,
    "average_age_overall": average_age_overall,
    "size_correlation": size_correlation,
    "share_correlation": share_correlation,
    "count_correlation": count_correlation,
    "size_rank_correlation": size_rank_correlation,
    "share_rank_correlation": share_rank_correlation,
    "arrival_temperature": arrival_temperature,
    "label_lists": label_lists,
    "decode_codes": decode_codes,
    "decode_states": decode_states,
    "decode_modes": decode_modes,
    "decode_visas": decode_visas,
    "monthly_refresh": monthly_refresh,
    "temperature_refresh": temperature_refresh,
    "mart_person": _mart_table("dim_immigrant", "flat"),
    "mart_city": _mart_table("dim_city", "flat"),
    "mart_city_metric": _mart_table("dim_city_temp", "flat"),
    "mart_calendar": _mart_table("dim_time", "flat"),
    "mart_fact": _mart_table("fact_immigration", "flat"),
    "mart_person_partitioned": _mart_table("dim_immigrant", "partitioned"),
    "mart_city_partitioned": _mart_table("dim_city", "partitioned"),
    "mart_fact_partitioned": _mart_table("fact_immigration", "partitioned"),
    "q_share_on_mart": q_share_on_mart,
    "q_size_on_mart": q_size_on_mart,
    "refresh_replaced_fact": _replaced_table("immigration", mart.fact_table),
    "refresh_replaced_person": _replaced_table("immigrant", mart.dim_person),
    "refresh_replaced_calendar": _replaced_table("time", mart.calendar_dim),
    "refresh_distinct_fact": _streamed_table("immigration"),
    "refresh_distinct_person": _streamed_table("immigrant"),
    "refresh_distinct_calendar": _streamed_table("time"),
    "refresh_demographics": refresh_demographics,
    "refresh_after_batch_fact": _refreshed_table("fact_immigration", "flat"),
    "refresh_after_batch_person": _refreshed_table("dim_immigrant", "flat"),
    "refresh_after_batch_calendar": _refreshed_table("dim_time", "flat"),
    "refresh_after_batch_fact_partitioned": _refreshed_table("fact_immigration", "partitioned"),
    "refresh_after_batch_person_partitioned": _refreshed_table("dim_immigrant", "partitioned"),
}
