"""The near-duplicate join sends on only the texts that it needs to compare or drop."""

import re

import pytest
from edge import BASE, NEAR
from pyspark.sql import functions as F

from portmart.llm import ngram_join

ROWS = [(1, BASE), (2, NEAR), (5, NEAR + " x"), (3, "one stands alone here"), (3, "one stands alone here"), (4, None), (None, None)]
ROWS += [(None, "no id and twice the same words"), (None, "no id and twice the same words")]
ROWS += [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(10, 60)]


@pytest.fixture
def by_merge(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.withColumn("lang", F.lit("en"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [ROWS, sorted(set(ROWS), key=str)])
def test_rows_that_stay_are_not_shuffled(spark, by_merge, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = ngram_join.keep_representatives(df)
    stay = re.search(r"Union\n +:- (.*?)\n +[:+]- (?=Project|SortMergeJoin|SortAggregate)", _plan(kept)[:4000], re.S)
    assert stay and "NOT pythonUDF" in stay[1] and "Exchange" not in stay[1] and "Join" not in stay[1]
    want = sorted({r for r in ROWS if r[0] not in (2, 5)}, key=str)
    assert sorted((tuple(r) for r in kept.collect()), key=str) == want


def test_compared_texts_are_shuffled_once(spark, by_merge):
    df = _docs(spark)
    described = ngram_join.materialize(ngram_join.describe(df), "described")
    classes, _ = ngram_join.order_classes(described)
    of = described.where("n > 0").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("doc"))
    of = ngram_join.materialize(of, "classes")
    wanted = of.where("doc.doc_id is null or doc.doc_id < 6").select(F.col("class").alias("w"))
    found = ngram_join.fragments(df, of, wanted, classes, [])
    assert _plan(found).count("Exchange hashpartitioning") == 2  # texts and wanted rows
    # Repeated rows and null ids: every class once, with all its members.
    members = found.groupBy("class", "fragment").agg(F.count(F.lit(1)).alias("times"), F.sum(F.size("members")).alias("n"))
    got = {r["class"]: (r["times"], r["n"]) for r in members.groupBy("class").agg(F.max("times").alias("times"), F.sum("n").alias("n")).collect()}
    sizes = {r["class"]: r["n"] for r in described.where("n > 0").join(wanted, F.col("class") == F.col("w")).collect()}
    assert got == {k: (1, n) for k, n in sizes.items()} and len(got) == 5
