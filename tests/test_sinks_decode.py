"""Partitioned round trips and code decoding."""

import os

from fixtures import LABEL_FILE
from pyspark.sql import types as T

from portmart.operators.decode import decode
from portmart.sources.labels import label_table, read_label_lines
from portmart.sources.sinks import read_partitioned, write_partitioned, write_table


def test_codes_keep_leading_zeros_and_nulls(spark, tmp_out):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("code", T.StringType())])
    df = spark.createDataFrame([(1, "060"), (2, "888"), (3, None), (4, "060")], schema)
    path = os.path.join(tmp_out, "p")
    write_partitioned(df, path, ["code"])
    back = read_partitioned(spark, path)
    assert dict(back.schema.fields and [(f.name, f.dataType) for f in back.schema.fields])["code"] == T.StringType()
    assert sorted(tuple(r) for r in back.select("id", "code").collect()) == [(1, "060"), (2, "888"), (3, None), (4, "060")]
    typed = read_partitioned(spark, path, df.schema)
    assert typed.schema["code"].dataType == T.StringType()
    assert typed.where("code = '060'").count() == 2


def test_overwrite_replaces(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_decode_with_default(spark, tmp_out):
    path = os.path.join(tmp_out, "labels.SAS")
    with open(path, "w") as f:
        f.write(LABEL_FILE)
    countries = label_table(read_label_lines(spark, path), "i94cntyl")
    df = spark.createDataFrame([("582",), ("236 ",), ("123",), (None,)], "c string")
    got = [tuple(r) for r in decode(df, "c", countries, "name", default_code="996").orderBy("c").collect()]
    assert sorted(got, key=repr) == sorted(
        [
            ("582", "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"),
            ("236 ", "AFGHANISTAN"),
            ("123", "No Country Code (996)"),
            (None, "No Country Code (996)"),
        ],
        key=repr,
    )
    plain = decode(df, "c", countries, "name")
    assert plain.where("name IS NULL").count() == 2


def test_csv_header_checked_against_schema(spark, tmp_out):
    import pytest

    from portmart.sources.readers import read_temperature

    good = os.path.join(tmp_out, "good.csv")
    with open(good, "w") as f:
        f.write("dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
                "2013-08-01,18.5,,San Francisco,United States,37.78N,122.03W\n")
    row = read_temperature(spark, good).first()
    assert (row.City, row.AverageTemperatureUncertainty) == ("San Francisco", None)
    bad = os.path.join(tmp_out, "bad.csv")
    with open(bad, "w") as f:
        f.write("City,dt,AverageTemperature,AverageTemperatureUncertainty,Country,Latitude,Longitude\n"
                "San Francisco,2013-08-01,18.5,0.3,United States,37.78N,122.03W\n")
    with pytest.raises(Exception):
        read_temperature(spark, bad).collect()
