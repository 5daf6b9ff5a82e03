"""Shards stay near equal however many rows are equal."""

import collections
import zlib

import pytest
from pyspark.sql import functions as F

from portmart.llm import sharding


@pytest.mark.parametrize("doc_id", [None, 7])
def test_a_third_of_equal_rows_spreads(spark, doc_id):
    n = 30_000
    hot = F.col("id") % 3 == 0
    docs = spark.range(n).select(
        F.when(hot, F.lit(doc_id).cast("long")).otherwise(F.col("id") + 100).alias("doc_id"),
        F.when(hot, F.lit("same words " * 8)).otherwise(F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("text"),
    )
    rows = sharding.shard(docs).collect()
    load, places = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    mean = sum(load.values()) / 16
    assert len(rows) == n and set(load) == set(range(16))
    assert max(abs(b - mean) for b in load.values()) < 0.01 * mean
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    same = ("same words " * 8).encode()
    copies = [r for r in rows if r.doc_id == doc_id]
    assert len(copies) == n // 3 and {(r.size, r.text_crc32) for r in copies} == {(len(same) + 1, zlib.crc32(same))}


def test_places_do_not_depend_on_the_partitions(spark):
    docs = spark.range(9_000).select((F.col("id") % 2).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert key(sharding.shard(docs)) == key(sharding.shard(docs.repartition(7)))
