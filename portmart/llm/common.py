"""Expressions and table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.session import discard as discard
from portmart.session import materialize as materialize

# The white space that separates words, x20 and x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_of(col: str | Column) -> Column:
    """The text, null read as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters, unchanged."""
    t = F.btrim(text, F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def own_prefix(docs: DataFrame) -> str:
    """A prefix that no column name of ``docs`` starts with."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no model may learn from; a null
    id is never learnt from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def count_in(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def shingle_hashes(ws: Column, width: int = 5) -> Column:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; fewer
    words count as one run, no word as none.  ``ws`` must be a plain column."""
    n = F.size(ws)
    runs = F.transform(
        F.slice(ws, 1, F.greatest(n - (width - 1), F.lit(1))),
        lambda x, i: F.xxhash64(x, *[F.get(ws, i + k) for k in range(1, width)]),
    )
    return F.sort_array(F.array_distinct(runs))
