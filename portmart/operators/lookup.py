"""First-match containment lookup: name -> code of the first label (in list
order) that contains the name, ignoring case.

This is a theta join (``label LIKE '%' || name || '%'``), answered exactly
with an equi-join: the labels alone give a table of every substring that
occurs in some label and the code of the first label it occurs in, and a row
finds its code there by its name.  The table depends on the labels only, so
the rows are read once, nothing is measured beforehand, and no pair of row
and label is ever enumerated.

That table is quadratic in the length of a label.  For long labels
``indexed_codes`` answers the names at hand through an index of the labels'
short runs of characters, which is linear in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.functions.text import explode_substrings, substring_count
from portmart.session import materialize


# Substrings that one task spells out.
SUBSTRINGS_AT_ONCE = 1_000_000


def substring_codes(
    labels: DataFrame,
    *,
    label_col: str = "label",
    code_col: str = "code",
    ord_col: str = "ord",
    at_once: int = SUBSTRINGS_AT_ONCE,
) -> DataFrame:
    """``(key, code)`` for each lower-case substring of the labels: the code
    of the first label, by ``ord_col``, that contains it.

    Written once: Spark then knows its size, broadcasts it while it is small
    and otherwise shuffles both sides of the join, where AQE splits a hot
    name.  Its size is quadratic in the length of one label and linear in
    their number (660 port labels of 20 characters: some 90,000 keys).

    A label's place in the order is one number, so the least place of a
    substring is found by hashing, and no task sorts substrings.  Their number
    is known from the lengths beforehand: about ``at_once`` go to a task,
    however few files the labels come from.
    """
    ord_ = F.col(ord_col).alias("_ord")
    pieces = labels.select(ord_, F.col(code_col).alias("_code"), F.lower(F.col(label_col)).alias("_text"))
    # A label without an order gives way to any other and has no code.
    ordered = pieces.where(F.col("_text").isNotNull()).orderBy(F.col("_ord").asc_nulls_last())
    code = F.when(F.col("_ord").isNotNull(), F.col("_code"))
    # Grows along the order; written, as a second run may number equal orders otherwise.
    placed = materialize(
        ordered.select(F.monotonically_increasing_id().alias("_place"), code.alias("code"), "_text"), "label-places"
    )
    texts = materialize(placed.groupBy("_text").agg(F.min("_place").alias("_place")), "label-texts")
    total = texts.agg(F.sum(substring_count("_text"))).first()[0] or 0
    spread = texts.repartition(max(1, -(-total // at_once)), "_text")
    # Partial aggregation collapses a popular substring inside each task.
    firsts = explode_substrings(spread, "_text", "key").groupBy("key").agg(F.min("_place").alias("_place"))
    return materialize(firsts.join(placed.select("_place", "code"), "_place").select("key", "code"), "label-substrings")


def first_match_code(
    df: DataFrame,
    name_col: str,
    labels: DataFrame | None = None,
    out_col: str = "city_code",
    *,
    codes: DataFrame | None = None,
    label_col: str = "label",
    code_col: str = "code",
    ord_col: str = "ord",
) -> DataFrame:
    """Add ``out_col``: code of the first label containing ``df[name_col]``
    (case-insensitive), or null.  A null name gives null; an empty name
    matches the first label.  ``codes`` is the labels' ``substring_codes``
    when several lookups share it.
    """
    if codes is None:
        codes = substring_codes(labels, label_col=label_col, code_col=code_col, ord_col=ord_col)
    side = codes.select(F.col("key").alias("_key"), F.col("code").alias(out_col))
    return df.join(side, F.lower(F.col(name_col)) == F.col("_key"), "left").drop("_key")


# Characters of the longest run in the index of the labels.
GRAM = 3


def grams(chars: str, size: int) -> Column:
    """The distinct runs of ``size`` of the characters in the array column
    ``chars`` (a column, not an expression: it is read for every run)."""
    n = F.size(chars)
    runs = F.transform(
        F.sequence(F.lit(0), n - size), lambda i: F.concat(*[F.get(chars, i + k) for k in range(size)])
    )
    return F.when(n >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def gram_index(
    labels: DataFrame,
    *,
    label_col: str = "label",
    code_col: str = "code",
    ord_col: str = "ord",
    gram: int = GRAM,
) -> DataFrame:
    """``(key, ord, code)`` for each distinct run of up to ``gram`` characters
    of each label, lower case, and for the empty one: at most ``gram`` rows
    for a character of a label."""
    text = F.lower(F.col(label_col))
    rows = labels.where(F.col(label_col).isNotNull()).select(
        F.col(ord_col).alias("ord"), F.col(code_col).alias("code"), F.split(text, "").alias("_chars")
    )
    keys = F.concat(F.array(F.lit("")), *[grams("_chars", k) for k in range(1, gram + 1)])
    return rows.select(F.explode(keys).alias("key"), "ord", "code")


def indexed_codes(
    names: DataFrame,
    name_col: str,
    labels: DataFrame,
    *,
    label_col: str = "label",
    code_col: str = "code",
    ord_col: str = "ord",
    gram: int = GRAM,
) -> DataFrame:
    """``(key, code)`` for the distinct lower-case names: what
    ``substring_codes`` holds for them, without its quadratic size.  ``ord``
    tells the labels apart.

    A name of up to ``gram`` characters is a key of the index.  A longer one
    is compared with the labels that hold its rarest run of ``gram``
    characters, and with none if a run of it is in no label.  The pairs
    compared carry places; texts join in one by one to be tested, never
    within the index.
    """
    index = materialize(
        gram_index(labels, label_col=label_col, code_col=code_col, ord_col=ord_col, gram=gram), "label-grams"
    )
    wanted = names.select(F.lower(F.col(name_col)).alias("key")).where(F.col("key").isNotNull()).distinct()
    wanted = materialize(wanted, "names")
    firsts = index.groupBy("key").agg(F.min_by("code", "ord").alias("code"), F.count(F.lit(1)).alias("_n"))
    firsts = materialize(firsts, "gram-codes")
    short = wanted.where(F.length("key") <= gram).join(firsts, "key").select("key", "code")

    long = wanted.where(F.length("key") > gram).select("key", F.split("key", "").alias("_chars"))
    runs = long.select("key", F.explode(grams("_chars", gram)).alias("_gram"))
    known = firsts.select(F.col("key").alias("_gram"), "_n")
    counted = runs.join(known, "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = counted.groupBy("key").agg(F.min(F.struct("_n", "_gram")).alias("_rarest"))
    rarest = materialize(
        rarest.where(F.col("_rarest._n") > 0).select("key", F.col("_rarest._gram").alias("_gram")), "rarest-grams"
    )
    places = index.where(F.length("key") == gram).select(F.col("key").alias("_gram"), "ord")
    texts = labels.select(
        F.col(ord_col).alias("ord"), F.col(code_col).alias("code"), F.lower(F.col(label_col)).alias("_text")
    )
    met = rarest.join(places, "_gram").join(materialize(texts, "label-texts"), "ord")
    found = met.where(F.contains("_text", "key")).groupBy("key").agg(F.min_by("code", "ord").alias("code"))
    return materialize(short.unionByName(found), "name-codes")
