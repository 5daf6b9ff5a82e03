"""The corpus pipeline: five stages over ``documents``.

Each stage takes all its predecessor kept, and is written as Parquet and read
again before the next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portmart.llm import decontamination, language_id, mixing, ngram_join, sharding
from portmart.llm.common import materialize, table


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language was identified; undetermined ones go."""
    return language_id.keep_identified(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return ngram_join.keep_representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the target weights of their sources ask."""
    return mixing.repeat_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row with its shard and its place in it."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_identified),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Language identification is learnt, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
