"""Analyses over the star schema: arrivals against city size and
foreign-born share, and the summaries the data model was built for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portmart.functions.numeric import percentage
from portmart.operators.aggregates import group_count
from portmart.operators.colocated import joined_counts
from portmart.operators.joins import join_on_keys
from portmart.operators.ordering import order_by_desc, top_k


def arrivals_by_city(fact: DataFrame, city: DataFrame) -> DataFrame:
    """Fact rows joined to the city dimension on port code and state.

    The dimension has one row per city.  Read from its table, its size is
    known, and Spark broadcasts it under the session's threshold; past that
    both sides are shuffled on both keys, and AQE splits a hot city.
    Several cities sharing both codes each receive the arrival.
    """
    return join_on_keys(fact, city, ["city_code", "state_code"], "f", "d")


def share_vs_volume(fact: DataFrame, city: DataFrame, by: str = "count") -> DataFrame:
    """Arrivals per city next to its foreign-born count and share, sorted
    descending ``by`` the count or the share (nulls last)."""
    j = arrivals_by_city(fact, city).select(
        F.col("f.id").alias("id"),
        F.col("d.city_name").alias("city_name"),
        F.col("f.state_code").alias("state_code"),
        F.col("d.foreign_born_count").alias("foreign_born_count"),
        F.col("d.total_pop").alias("total_pop"),
    )
    j = j.withColumn(
        "foreign_born_pct", percentage("foreign_born_count", "total_pop")
    )
    keys = ["city_name", "state_code", "foreign_born_count", "foreign_born_pct"]
    return order_by_desc(group_count(j, keys), by, [c for c in ["count", *keys] if c != by])


def size_vs_volume(fact: DataFrame, city: DataFrame, by: str = "count", k: int | None = None) -> DataFrame:
    """Arrivals per city next to its total population, sorted descending
    ``by`` the count or the population (nulls last); the first ``k`` only if
    given."""
    j = arrivals_by_city(fact, city).select(
        F.col("f.id").alias("id"),
        F.col("d.city_name").alias("city_name"),
        F.col("f.state_code").alias("state_code"),
        F.col("d.total_pop").alias("total_pop"),
    )
    keys = ["city_name", "state_code", "total_pop"]
    ties = [c for c in ["count", *keys] if c != by]
    counted = group_count(j, keys)
    return order_by_desc(counted, by, ties) if k is None else top_k(counted, by, k, ties)


def popular_cities(fact: DataFrame, city: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` cities with most arrivals."""
    j = arrivals_by_city(fact, city).select(
        F.col("d.city_name").alias("city_name"), F.col("f.state_code").alias("state_code")
    )
    return top_k(group_count(j, ["city_name", "state_code"]), "count", k, ["city_name", "state_code"])


def gender_distribution(person: DataFrame) -> DataFrame:
    """Arrivals per gender and their share of all arrivals (percent).

    The total is a scalar subquery over the grouped rows (one per gender);
    the grouping's shuffle is shared with the main query, not recomputed.
    """
    g = group_count(person, ["gender"])
    total = g.agg(F.sum("count")).scalar()
    return g.withColumn("share_pct", percentage(F.col("count"), total))


def gender_by_city(fact_by_id: DataFrame, person_by_id: DataFrame) -> DataFrame:
    """Arrivals per port and gender, and the gender's share of the port's
    arrivals (percent), through fact and person joined on the id.

    Both are tables of ``write_bucketed`` on the id (the fact with
    ``city_code``, the person with ``gender``).  An id with several fact and
    several person rows counts once for each pair of them; persons without
    arrivals and null ids do not count.  The share's window runs over the
    grouped rows, a few for each port.
    """
    g = joined_counts(fact_by_id, person_by_id, [F.col("l.city_code"), F.col("r.gender")])
    total = F.sum("count").over(Window.partitionBy("city_code"))
    return g.withColumn("share_pct", percentage(F.col("count"), total))


def average_age(staging_arrivals: DataFrame, by: str | None = "city_code") -> DataFrame:
    """Mean age of the arrivals, per ``by`` (port code by default) or
    overall.  Read from the arrivals staging table, which carries age and
    port on the same row, so no join of person and fact on the id is
    needed; one shuffle with map-side partial sums."""
    aggs = [F.avg("age").alias("avg_age"), F.count("age").alias("n_with_age")]
    if by is None:
        return staging_arrivals.agg(*aggs)
    return staging_arrivals.groupBy(by).agg(*aggs)


def correlation(df: DataFrame, metric: str, volume: str = "count") -> DataFrame:
    """Pearson correlation between a city metric and its arrival volume
    (the relation the scatter plots show)."""
    return df.agg(F.corr(F.col(metric).cast("double"), F.col(volume).cast("double")).alias("corr"))
