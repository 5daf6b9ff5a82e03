"""Lines that do not fit their schema land in a table of their own."""

import os

import pytest
from pyspark.sql import types as T

from portmart.sources.readers import quarantine_delimited

SCHEMA = T.StructType(
    [T.StructField("k", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())]
)
GOOD = ["1,a,1.5", "2,,", "3,\"b,c\",NaN", "1,a,1.5"]
BAD = ["4,short", "5,long,1.0,more", "six,a,1.0", "7,a,much", "7,a,much", "8,\"open,1.0"]


def _land(root, name, lines, header="k,name,x"):
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/{name}", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def _split(spark, root, schema=SCHEMA, **kw):
    rows, rejects = quarantine_delimited(spark, f"{root}/in", schema, f"{root}/out", **kw)
    return rows, rejects


def test_kept_plus_rejected_are_all_lines(spark, tmp_out):
    _land(tmp_out, "a.csv", GOOD + BAD)
    _land(tmp_out, "b.csv", BAD[:1] + ["", "9,z,2"])
    rows, rejects = _split(spark, tmp_out)
    kept = sorted(map(repr, (tuple(r) for r in rows.collect())))
    assert kept == sorted(
        map(repr, [(1, "a", 1.5), (2, None, None), (3, "b,c", float("nan")), (1, "a", 1.5), (9, "z", 2.0)])
    )
    got = sorted((os.path.basename(r.file), r.line) for r in rejects.collect())
    assert got == sorted([("a.csv", line) for line in BAD] + [("b.csv", BAD[0])])


def test_a_narrow_read_finds_the_same_lines(spark, tmp_out):
    _land(tmp_out, "a.csv", GOOD + BAD)
    rows, rejects = _split(spark, tmp_out)
    assert rows.select("k").count() == len(GOOD) and rejects.count() == len(BAD)
    plan = rows.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c0:int>" in plan and "Scan csv" not in plan


def test_columns_named_like_our_own(spark, tmp_out):
    names = ["_fault", "_FILE", "_rejected"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    _land(tmp_out, "a.csv", ["1;2;3", "1;2"], header=";".join(names))
    rows, rejects = _split(spark, tmp_out, schema, sep=";")
    assert rows.columns == names and [tuple(r) for r in rows.collect()] == [("1", "2", "3")]
    assert [r.line for r in rejects.collect()] == ["1;2"]


def test_only_good_only_bad_or_no_lines(spark, tmp_out):
    for name, lines in (("good", GOOD), ("bad", BAD), ("none", [])):
        _land(f"{tmp_out}/{name}", "a.csv", lines)
        rows, rejects = _split(spark, f"{tmp_out}/{name}")
        assert (rows.count(), rejects.count()) == (len(lines) * (name == "good"), len(lines) * (name == "bad"))


def test_another_order_of_columns_is_an_error(spark, tmp_out):
    _land(tmp_out, "a.csv", GOOD, header="name,k,x")
    with pytest.raises(Exception, match="[Hh]eader"):
        _split(spark, tmp_out)
