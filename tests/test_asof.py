"""As-of join: the latest reading of a key on or before a row's time."""

import datetime as dt
import random

from pyspark.sql import functions as F

from portmart.operators.asof import asof_join

ROWS = "id long, city string, date date, city_slice string"
READINGS = "city string, date date, temp double, unc double, noise string"


def day(n):
    return None if n is None else dt.date(2000, 1, 1) + dt.timedelta(n)


def expected(rows, readings):
    out = []
    for i, c, d, x in rows:
        fit = [r for r in readings if c is not None and d is not None and r[0] == c and r[1] is not None and r[1] <= d]
        at = max((r[1] for r in fit), default=None)
        null_first = lambda v: (v is not None, v if v is not None else 0.0)
        best = max((r for r in fit if r[1] == at), key=lambda r: (null_first(r[2]), null_first(r[3])), default=(None,) * 4)
        out.append((i, c, d, x, at, best[2], best[3]))
    return sorted(map(str, out))


def joined(spark, rows, readings):
    a = spark.createDataFrame(rows, ROWS)
    b = spark.createDataFrame(readings, READINGS)
    df = asof_join(a, b, ["city"], "date", ["temp", "unc"], F.year("date"))
    assert df.columns == ["id", "city", "date", "city_slice", "reading_at", "temp", "unc"]
    return df


def test_against_brute_force(spark):
    rng = random.Random(7)
    cities = ["hot"] * 6 + ["a", "b", "none", None]
    rows = [(i, rng.choice(cities), day(rng.choice([None, rng.randrange(2500)])), "x") for i in range(600)]
    rows += rows[:40]  # repeated rows
    readings = [
        (rng.choice(["hot", "a", "b", "unvisited", None]), day(rng.choice([None, *[rng.randrange(300, 2200) for _ in range(6)]])),
         rng.choice([None, float(rng.randrange(5))]), rng.choice([None, 1.0, 2.0]), "n")
        for _ in range(120)
    ]
    readings += readings[:10] + [("a", day(500), 1.0, None, "n"), ("a", day(500), 1.0, 3.0, "n"), ("a", day(500), None, 9.0, "n")]
    got = sorted(str(tuple(r)) for r in joined(spark, rows, readings).collect())
    assert got == expected(rows, readings)


def test_a_reading_is_carried_over_empty_slices_and_counts_on_its_day(spark):
    rows = [(1, "a", day(0), "x"), (2, "a", day(1), "x"), (3, "a", day(3000), "x"), (4, "a", day(-1), "x")]
    got = {r.id: (r.reading_at, r.temp) for r in joined(spark, rows, [("a", day(0), 5.0, 1.0, "n")]).collect()}
    assert got == {1: (day(0), 5.0), 2: (day(0), 5.0), 3: (day(0), 5.0), 4: (None, None)}


def test_empty_tables(spark):
    rows = [(1, "a", day(0), "x")]
    assert [(r.id, r.reading_at, r.temp) for r in joined(spark, rows, []).collect()] == [(1, None, None)]
    assert joined(spark, [], [("a", day(0), 5.0, 1.0, "n")]).count() == 0
