"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every portmart session gets.  AQE re-plans joins at runtime
# (broadcast conversion from measured sizes, skew splitting, partition
# coalescing); the session clock is UTC so calendar functions agree with
# the parquet timestamps, which are zone-less.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_settings(
    input_bytes: int,
    target_partition_bytes: int = 512 * 1024 * 1024,
    min_partitions: int = 200,
) -> dict[str, str]:
    """Shuffle sizing for a run over ``input_bytes`` of input.

    AQE starts every shuffle with ``initialPartitionNum`` partitions and
    merges neighbours up to the advisory size, so the start must be large
    enough that the biggest shuffle (the arrivals dedup, about the size of
    the selected columns) lands in partitions that fit in executor memory:
    one per ``target_partition_bytes`` of input at every size, and no fewer
    than ``min_partitions`` (Spark's own default).
    """
    initial = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 4),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def build_session(
    app_name: str = "portmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the portmart defaults.

    ``master`` is only for local runs; on a cluster leave it to spark-submit
    and size shuffles with ``scale_settings`` (passed as ``extra``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_root(configured: str | None, master: str) -> str:
    """The folder for intermediate tables: the configured one, or, only when
    driver and executors are one process, a local temporary folder."""
    if configured:
        return configured.rstrip("/")
    if re.match(r"local(\[|$)", master):
        return tempfile.mkdtemp(prefix="portmart-ckpt-")
    raise RuntimeError(
        f"spark.checkpoint.dir is not set (master {master}): intermediate tables need a folder all executors share"
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    root = scratch_root(spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir(), sc.master)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "portmart-scratch", uuid.uuid4().hex, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and continue from the copy.

    Catalyst then knows the table's real size: a join broadcasts it if it is
    under the threshold, and otherwise shuffles both sides, which AQE can
    split where a key is hot.  (An aggregate joined on its own keys brings no
    shuffle of its own, and such a join is never split.)
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy._scratch_path = path
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any
    more: all that was made from them must be written itself."""
    for copy in copies:
        spark = copy.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(copy._scratch_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at.getParent(), True)
