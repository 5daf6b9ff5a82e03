"""Files in blocks of several columns at once."""

import glob
import os
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from portmart.sources.sinks import interleaved, write_clustered, write_partitioned

SCHEMA = "id long, day date, city string, state string, _rank0 string"


def rows(n):
    rng = random.Random(5)
    out = []
    for i in range(n):
        city = "C00" if i % 3 == 0 else f"C{rng.randrange(40):02d}"  # a third in one city
        out.append((i, rng.randrange(700), city, rng.choice([None, *[f"S{k:02d}" for k in range(30)]]), "kept"))
    return out


def written(spark, tmp_out, n=12000, n_files=32):
    d = spark.createDataFrame(rows(n), "id long, n int, city string, state string, _rank0 string")
    d = d.select("id", F.date_add(F.lit("2016-01-01").cast("date"), F.col("n")).alias("day"), "city", "state", "_rank0")
    path = os.path.join(tmp_out, "clustered")
    write_clustered(d, path, ["day", "city", "state"], n_files)
    return d, path


def files_touched(path, keep):
    """Files whose minimum and maximum do not exclude the wanted values."""
    n = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = {meta.schema.column(i).name: i for i in range(len(meta.schema))}
        n += any(
            all(
                (s := meta.row_group(g).column(at[c]).statistics).has_min_max and str(s.min) <= hi and str(s.max) >= lo
                for c, (lo, hi) in keep.items()
            )
            for g in range(meta.num_row_groups)
        )
    return n


def test_rows_are_kept_and_files_pruned_on_any_column(spark, tmp_out):
    d, path = written(spark, tmp_out)
    back = spark.read.schema(d.schema).parquet(path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, d.collect()), key=repr)
    n = len(glob.glob(f"{path}/*.parquet"))
    assert 16 <= n <= 32
    one_city, one_week = {"city": ("C17", "C17")}, {"day": ("2016-06-06", "2016-06-12")}
    one_state = {"state": ("S11", "S11")}
    for keep in (one_city, one_week, one_state):
        assert files_touched(path, keep) <= 0.6 * n
    assert files_touched(path, one_city | one_week) <= 0.35 * n
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert max(sizes) <= 2.5 * 12000 / n


def test_folders_of_two_keys_make_many_more_files(spark, tmp_out):
    d, path = written(spark, tmp_out)
    folders = os.path.join(tmp_out, "folders")
    write_partitioned(d, folders, ["city", "state"])
    many = glob.glob(f"{folders}/**/*.parquet", recursive=True)
    assert len(many) >= 1000 and len(glob.glob(f"{path}/*.parquet")) <= 32
    # One week: every folder may hold it, few of the clustered files do.
    assert files_touched(path, {"day": ("2016-06-06", "2016-06-12")}) <= 0.02 * len(many)


def test_one_key_for_all_rows_is_spread_over_files(spark, tmp_out):
    d = spark.range(4000).select("id", F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    path = os.path.join(tmp_out, "same")
    write_clustered(d, path, ["a", "b"], 8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 4000 and max(sizes) <= 1500


def test_empty_table_and_interleaving(spark, tmp_out):
    d = spark.range(0).select("id", F.lit("x").alias("a"))
    path = os.path.join(tmp_out, "empty")
    write_clustered(d, path, ["a"], 4)
    assert spark.read.parquet(path).columns == ["id", "a"] and spark.read.parquet(path).count() == 0
    pairs = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    for r in pairs.select("x", "y", interleaved([F.col("x"), F.col("y")], 3).alias("z")).collect():
        want = "".join(a + b for a, b in zip(f"{r.x:03b}", f"{r.y:03b}"))
        assert r.z == int(want, 2)
