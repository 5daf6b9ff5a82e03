"""Pipeline stages keep extra columns whatever their names, and ids of any type."""

from edge import BASE, NEAR, components
from pyspark.sql import functions as F

from portmart.llm import decontamination, mixing, ngram_join

EXTRA = ["_bad_id", "_bad_hash", "_mix_source", "_mix_n", "_out_id", "_rep_id", "_hash", "_id", "_source", "__n", "times", "label"]


def _docs(spark):
    rows = [(1, BASE, "a"), (2, NEAR, "a"), (3, "other words stand here alone", "b"), (3, "other words stand here alone", "b"), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({c: F.col("doc_id") for c in EXTRA})


def _kept(df):
    rows = df.collect()
    assert df.columns == ["doc_id", "text", "source", *EXTRA]
    assert all(r[c] == r.doc_id for r in rows for c in EXTRA)
    return sorted(r.doc_id for r in rows)


def test_decontamination(spark):
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    assert _kept(decontamination.drop_contaminated(_docs(spark), items)) == [3, 3, 4]


def test_mixing(spark):
    assert set(_kept(mixing.repeat_documents(_docs(spark)))) <= {1, 2, 3, 4}


def test_representatives(spark):
    assert _kept(ngram_join.keep_representatives(_docs(spark))) == [1, 3, 4]


def test_small_ids(spark):
    rows = [(1, BASE), (2, NEAR), (3, "three short words")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast("smallint"))
    got = ngram_join.components(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(rows)
