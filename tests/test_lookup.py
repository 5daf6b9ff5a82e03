"""First-match containment lookup against a brute-force
loop over the label list."""

import random
import re

from fixtures import PORTS
from pyspark.sql import functions as F

from portmart.operators.lookup import first_match_code, gram_index, indexed_codes


def brute(name, labels):
    if name is None:
        return None
    for _, code, label in sorted(labels):
        if name.lower() in label.lower():
            return code
    return None


def _labels_df(spark, labels):
    return spark.createDataFrame(labels, "ord long, code string, label string")


def test_reference_cases(spark):
    labels = [(i, c, l) for i, (c, l) in enumerate(PORTS)]
    names = ["Portland", "Mesa", "Alton", "Oakland", None, "", "Nowhere", "int'l falls", "SAN FRANCISCO"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, City string")
    got = dict(first_match_code(df, "City", _labels_df(spark, labels)).select("i", "city_code").collect())
    # Portland -> Maine (listed first), Mesa -> OTAY MESA, Alton -> DALTONS
    # CACHE (substring), empty -> first label, null and unknown -> null.
    assert [got[i] for i in range(len(names))] == ["POM", "OTM", "DAC", "OAK", None, "ALC", None, "INT", "SFR"]


def test_rows_are_kept_and_not_multiplied(spark):
    labels = [(i, c, l) for i, (c, l) in enumerate(PORTS)]
    df = spark.createDataFrame([("Portland",)] * 50 + [("x",)] * 3, "City string")
    out = first_match_code(df, "City", _labels_df(spark, labels))
    assert out.count() == 53
    assert out.where(F.col("city_code") == "POM").count() == 50


def test_matches_brute_force_on_random_lists(spark):
    rng = random.Random(7)
    alphabet = "abcab "
    for _ in range(3):
        labels = [
            (rng.randrange(10_000), f"C{i}", "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))))
            for i in range(60)
        ]
        # distinct ords, as positions in a file are
        labels = list({o: (o, c, l) for o, c, l in labels}.values())
        names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(80)] + [None]
        df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, City string")
        got = dict(first_match_code(df, "City", _labels_df(spark, labels)).select("i", "city_code").collect())
        want = {i: brute(n, labels) for i, n in enumerate(names)}
        assert got == want


def test_no_python_udf_in_plan(spark):
    labels = [(i, c, l) for i, (c, l) in enumerate(PORTS)]
    df = spark.createDataFrame([("Portland",)], "City string")
    plan = first_match_code(df, "City", _labels_df(spark, labels))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_one_code_per_substring(spark):
    from portmart.operators.lookup import substring_codes

    labels = [(i, c, l) for i, (c, l) in enumerate(PORTS)]
    codes = dict(tuple(r) for r in substring_codes(_labels_df(spark, labels)).collect())
    texts = [label.lower() for _, _, label in labels]
    assert set(codes) == {t[i:j] for t in texts for i in range(len(t) + 1) for j in range(i, len(t) + 1)}
    assert (codes["mesa"], codes["portland"], codes[""]) == ("OTM", "POM", "ALC")


def _indexed(spark, names, labels):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, City string")
    codes = indexed_codes(df, "City", _labels_df(spark, labels))
    return dict(first_match_code(df, "City", codes=codes).select("i", "city_code").collect())


def test_index_matches_brute_force(spark):
    rng = random.Random(11)
    labels = [(10 * i, f"C{i}", "".join(rng.choice("abcAB \u00e9") for _ in range(rng.randint(0, 30)))) for i in range(60)]
    labels += [(5, "NULL", None), (7, "REPEAT", labels[3][2])]
    names = ["".join(rng.choice("abcB ") for _ in range(rng.randint(0, 8))) for _ in range(150)]
    names += [labels[9][2], labels[9][2][:15], "", None, "zzzz", "abcabcabcabcabcabcabcabcabcabcabcabcabc"]
    whole = [x for x in labels if x[2] is not None]
    assert _indexed(spark, names, labels) == {i: brute(n, whole) for i, n in enumerate(names)}


def test_index_of_long_labels(spark):
    rng = random.Random(3)
    labels = [(i, f"C{i}", "".join(rng.choice("abcdefgh") for _ in range(10_000))) for i in range(20)]
    cut = [(rng.randrange(20), rng.randrange(9_000), n) for n in (1, 2, 3, 4, 5, 9, 50, 900, 1_000) for _ in range(4)]
    names = [labels[i][2][at : at + n] for i, at, n in cut] + [labels[4][2], labels[4][2] + "a", "a" * 10_000]
    assert _indexed(spark, names, labels) == {i: brute(n, labels) for i, n in enumerate(names)}
    # Rows are linear in the label's length, here fewer: runs repeat.
    assert gram_index(_labels_df(spark, labels)).groupBy("ord").count().agg(F.max("count")).first()[0] <= 3 * 10_000 + 1


def test_index_without_labels_or_names(spark):
    assert _indexed(spark, ["a", "abcd", ""], []) == {0: None, 1: None, 2: None}
    assert _indexed(spark, [], [(0, "C", "label")]) == {}


def test_index_pairs_by_equal_keys_only(spark):
    df = spark.createDataFrame([("abcd",)], "City string")
    codes = indexed_codes(df, "City", _labels_df(spark, [(0, "C", "xabcdx")]))
    plan = first_match_code(df, "City", codes=codes)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Cartesian", "NestedLoop", "Python"))


def _written_plans(monkeypatch):
    """The plans of the tables that a lookup writes, by name, and the tables."""
    from portmart.operators import lookup

    plans, write = {}, lookup.materialize

    def keep(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(lookup, "materialize", keep)
    return plans


def test_substrings_are_hashed_not_sorted(spark, monkeypatch):
    from portmart.operators.lookup import substring_codes

    plans = _written_plans(monkeypatch)
    substring_codes(_labels_df(spark, [(i, c, l) for i, (c, l) in enumerate(PORTS)]))
    plan = plans["label-substrings"]
    assert "HashAggregate(keys=[key" in plan and "SortAggregate" not in plan


def test_codes_of_repeated_and_missing_orders(spark):
    from portmart.operators.lookup import substring_codes

    labels = [(5, "X", "ab"), (5, "Y", "cd"), (None, "Z", "abz"), (7, None, "ef"), (9, "W", "efg"), (1, "N", None)]
    codes = dict(tuple(r) for r in substring_codes(_labels_df(spark, labels)).collect())
    got = {k: codes[k] for k in ("ab", "cd", "z", "ef", "fg")}
    assert got == {"ab": "X", "cd": "Y", "z": None, "ef": None, "fg": "W"}
    assert codes[""] in ("X", "Y")
    assert substring_codes(_labels_df(spark, [])).count() == 0


def test_labels_of_one_file_are_spelled_out_by_several_tasks(spark, monkeypatch):
    from portmart.operators.lookup import substring_codes

    plans = _written_plans(monkeypatch)
    labels = [(i, f"C{i}", f"label {i:04d}") for i in range(100)]
    df = _labels_df(spark, labels).coalesce(1)
    codes = dict(tuple(r) for r in substring_codes(df, at_once=500).collect())
    # 56 substrings of each of the 100 labels, at most 500 to a task.
    assert re.search(r"Exchange hashpartitioning\(_text#\d+, 12\), REPARTITION_BY_NUM", plans["label-substrings"])
    assert {k: codes[k] for k in ("0042", "label", "1")} == {"0042": "C42", "label": "C0", "1": "C1"}
    assert set(codes) == {t[i:j] for _, _, t in labels for i in range(len(t) + 1) for j in range(i, len(t) + 1)}
