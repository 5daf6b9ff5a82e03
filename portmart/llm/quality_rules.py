"""Threshold rules over text statistics, compiled into one Spark projection.

``measure`` computes the statistics, ``RULES`` is the threshold table and
``compile_rules`` turns any such table into one boolean column.  Everything
is built-in expressions: no user function, no shuffle.

Defined results: a null or empty text has zero words, all counts zero, and
fails the base rule; a ratio over nothing is 0; null ids pass through;
repeated rows are judged alike, each on its own; an empty table gives an
empty result; columns other than the id and the text are ignored, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.llm.common import SPACES, text_of, words

SYMBOL = "[#*$%&|<>]"

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in that is was for it on with as at by be this are from or an not "
    "la le les de des du et un une en est que qui dans pour pas sur au par avec "
    "der die das und in zu den ist mit von für auf nicht ein eine im dem sich auch es "
    "el los las y del se por con una para su al lo como más o pero"
).split()

# As they stand inside and at the start of a sentence.
STOP_WORD_FORMS = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]

BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PCT = 50


@dataclass(frozen=True)
class Rule:
    """Keep a document only while ``low <= measure <= high``."""

    measure: str
    low: float | None = None
    high: float | None = None


# The threshold table.  The bounds are those published for web-text filters
# (word count, mean word length, symbol share, stop words, line repetition),
# eased where four languages have to pass the same table.
RULES = (
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("symbol_ratio", high=0.05),
    Rule("symbols_per_word", high=0.25),
    Rule("stop_word_ratio", low=0.03),
    Rule("dup_line_ratio", high=0.5),
    Rule("ellipsis_line_ratio", high=0.3),
    Rule("bullet_line_ratio", high=0.9),
)


def _repeat_positions(keys: Column, ws: Column, mask: Column) -> Column:
    """Start positions, ascending, of the 3-word windows found twice or more.

    ``keys`` is sorted and holds the window hash above the position (the bits
    of ``mask``), so equal windows are neighbours and differ in those low
    bits only; the words themselves confirm a match.
    """

    def at(k: Column) -> Column:
        return k.bitwiseAND(mask).cast("int")

    def same(k: Column, other: Column) -> Column:
        differing = k.bitwiseXOR(other)
        return (
            (differing >= 0)
            & (differing <= mask)
            & (F.get(ws, at(k)) == F.get(ws, at(other)))
            & (F.get(ws, at(k) + 1) == F.get(ws, at(other) + 1))
            & (F.get(ws, at(k) + 2) == F.get(ws, at(other) + 2))
        )

    # Each match gives its window and the one that follows it in key order.
    found = F.filter(
        F.transform(keys, lambda k, j: F.when(same(k, F.get(keys, j + 1)), F.array(at(k), at(F.get(keys, j + 1))))),
        lambda pair: pair.isNotNull(),
    )
    return F.sort_array(F.array_distinct(F.flatten(found)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, the counts and the ratios the rules use.

    ``n_repeat_words`` counts the words covered by a 3-word window that
    occurs at two or more places of the text.  Work and memory are
    proportional to the length of one text (n log n for the window sort).
    """
    t, w, lines, keys = F.col("t"), F.col("w"), F.col("lines"), F.col("keys")
    n, bits, mask = F.col("n"), F.col("bits"), F.col("mask")
    d = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    d = d.select(
        "doc_id",
        F.regexp_count(t, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        words(t).alias("w"),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    d = d.select(
        "doc_id",
        "n_symbols",
        "w",
        F.size(w).cast("long").alias("n"),
        # Positions need as many low bits as the word count has; the hash gets the rest.
        F.coalesce(F.length(F.bin(F.size(w).cast("bigint"))), F.lit(1)).alias("bits"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORD_FORMS))).alias("n_stop"),
        F.size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias(
            "n_ellipsis_lines"
        ),
        F.size(
            F.filter(lines, lambda x: F.substring(F.btrim(x, F.lit(SPACES)), 1, 1).isin("-", "*", "•", "–"))
        ).alias("n_bullet_lines"),
    )
    windows = F.transform(
        F.slice(w, 1, F.greatest(n.cast("int") - 2, F.lit(0))),
        lambda x, i: F.call_function(
            "shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits
        ).bitwiseOR(i.cast("bigint")),
    )
    d = d.withColumns(
        {
            "mask": F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1,
            "keys": F.when(n >= 3, F.sort_array(windows)).otherwise(F.array().cast("array<bigint>")),
        }
    )
    d = d.withColumn("pos", _repeat_positions(keys, w, mask)).drop("w", "keys", "bits", "mask")
    pos = F.col("pos")
    d = d.withColumnRenamed("n", "n_words").withColumn(
        "n_repeat_words",
        F.aggregate(
            F.transform(pos, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(pos, j + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda acc, x: acc + x,
        ),
    ).drop("pos")

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return d.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "symbols_per_word": ratio("n_symbols", "n_words"),
            "stop_word_ratio": ratio("n_stop", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
            "bullet_line_ratio": ratio("n_bullet_lines", "n_lines"),
        }
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean expression: every rule of the table holds."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= r.low)
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= r.high)
    return ok


def apply_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The measures plus ``base_failed`` and ``kept`` for every document."""
    m = measure(docs, id_col, text_col)
    failed = (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PCT * F.col("n_words")
    )
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
