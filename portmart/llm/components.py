"""Connected components of a link table, by alternating star contractions.

The links stay in Spark; every round is written to the shared folder, so a
lost executor costs a re-read.  Rounds grow with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm.common import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Every edge ends in a root: no node both has and is a least neighbour."""
    roots = edges.select(F.col("v").alias("r")).distinct()
    return edges.join(roots, edges["u"] == roots["r"], "left_semi").isEmpty()


def _least(links: DataFrame) -> DataFrame:
    """Least neighbour of every ``u``, written so that a join with it can be
    split where one node has very many links."""
    return materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least").withColumnRenamed("u", "n")


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of every linked node: ``links`` has ``u, v``; the
    component is its least node."""
    forward = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(forward.distinct(), "links")
    while not _are_stars(edges):
        # Large star: all larger neighbours of a node to its least neighbour or itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both)
        large = both.join(low, both["u"] == low["n"]).where("v > u")
        large = materialize(large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")), "large")
        # Small star: all smaller neighbours of a node, and itself, to the least.
        low = _least(large)
        small = large.join(low, large["u"] == low["n"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
        edges = materialize(edges, "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def merge_components(component: DataFrame, links: DataFrame) -> DataFrame:
    """The components after some more links: only the graph of components is
    contracted, whose nodes are named by their least node."""
    x, y = (component.select(F.col("node").alias("n"), F.col("component").alias(c)) for c in ("cu", "cv"))
    between = links.join(x, links["u"] == x["n"], "left").drop("n").join(y, links["v"] == y["n"], "left").drop("n")
    between = between.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    merged = materialize(connected_components(between), "merged")
    m = merged.withColumnRenamed("component", "to").withColumnRenamed("node", "from")
    old = component.join(m, component["component"] == m["from"], "left").select(
        "node", F.coalesce("to", "component").alias("component")
    )
    known = component.select(F.col("node").alias("k"))
    new = merged.join(known, merged["node"] == known["k"], "left_anti")
    return old.unionByName(new)
