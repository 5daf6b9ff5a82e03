"""Mid-ranks with ties and the rank correlation."""

import random

import pandas as pd
import pytest

from portmart.operators.ranks import mid_ranks, rank_correlation

SCHEMA = "id long, x double, y long, _value string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA)


def random_rows(n):
    rng = random.Random(3)
    # A third of the rows share one value.
    return [(i, 1.0 if i % 3 == 0 else rng.choice([None, float(rng.randrange(40))]), rng.choice([None, rng.randrange(2000)])) for i in range(n)]


def test_mid_ranks_against_pandas(spark):
    rows = random_rows(3000)
    d = mid_ranks(table(spark, rows).repartition(7), "x", "r")
    assert d.columns == ["id", "x", "y", "_value", "r"]
    want = pd.Series([r[1] for r in rows]).rank(method="average")
    got = {r.id: r.r for r in d.collect()}
    assert got == {r[0]: (None if r[1] is None else want[i]) for i, r in enumerate(rows)}


def test_rank_correlation_against_pandas(spark):
    rows = random_rows(3000)
    pdf = pd.DataFrame(rows, columns=["id", "x", "y"]).dropna()
    want = pdf["x"].rank().corr(pdf["y"].rank())
    got = rank_correlation(table(spark, rows), "x", "y").first().rank_corr
    assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize(
    "rows, want",
    [
        ([], None),
        ([(1, 1.0, 1)], None),
        ([(1, 1.0, 1), (2, 1.0, 5)], None),
        ([(1, None, 1), (2, 2.0, None)], None),
        ([(1, 1.0, 1), (2, 10.0, 2), (3, 1000.0, 3), (4, None, 9)], 1.0),
        ([(1, 1.0, 9), (2, 10.0, 7), (3, 1000.0, -3)], -1.0),
    ],
)
def test_few_rows(spark, rows, want):
    got = rank_correlation(table(spark, rows), "x", "y").collect()
    assert len(got) == 1
    assert got[0].rank_corr == (None if want is None else pytest.approx(want))
