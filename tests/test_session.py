"""Where scratch tables go, and how shuffles are sized."""

import os

import pytest

from portmart.session import materialize, scale_settings, scratch_root


def test_scratch_folder_is_shared_or_local():
    assert scratch_root("s3a://bucket/ckpt/", "yarn") == "s3a://bucket/ckpt"
    assert os.path.isdir(scratch_root(None, "local[4]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(None, master)


def test_one_shuffle_partition_per_half_gigabyte():
    n = lambda b: int(scale_settings(b)["spark.sql.shuffle.partitions"])
    assert n(1) == 200
    assert n(100 * 10**12) == -(-100 * 10**12 // (512 * 1024 * 1024)) == 186265


def test_materialized_table_is_read_back(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) as s")
    back = materialize(df, "t")
    assert back.inputFiles() and sorted(back.collect()) == sorted(df.collect())
