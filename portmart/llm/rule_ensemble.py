"""Quality classifier: a sparse ensemble of rules over text statistics.

1. ``statistics`` measures every text with built-in expressions.
2. A small random forest is grown on the labelled documents; every path from
   a root to a node is a rule, a conjunction of thresholds on statistics.
3. A logistic model with an L1 penalty weighs the rules; most get weight 0.
4. The rules left are compiled into one column expression, so scoring is a
   projection over the statistics, without any model object in the tasks.

Trees and weights are fitted by Spark on a bounded sample, ``TRAIN_ROWS`` of
the labelled documents that are not held out, drawn by a hash of the id.

Defined results: null and empty texts have all statistics 0 and are scored
like any other; labels without quality or id are not learnt from, several
labels of one id count as their mean, rounded; with no label to learn from
every score is 0.5, with labels of one class all scores are that class;
repeated rows are scored alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.llm.common import SPACES, held_out, materialize, text_of, words
from portmart.llm.quality_rules import STOP_WORD_FORMS

TRAIN_ROWS = 50_000
TREES = 12
DEPTH = 3
L1_PENALTY = 0.0005
CUTOFF = 0.3
SEED = 7

STATISTICS = (
    "log_words",
    "mean_word_chars",
    "symbols_per_word",
    "pipes_per_word",
    "marks_per_word",
    "stops_per_word",
    "capitals_share",
    "digits_share",
    "distinct_share",
    "repeat_share",
    "words_per_line",
    "dup_line_share",
)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the statistics of every document."""
    t, w, lines = F.col("t"), F.col("w"), F.col("lines")

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern))

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    d = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    d = d.select(
        "doc_id",
        words(t).alias("w"),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.length(t).alias("chars"),
        count("[#*$%&<>]").alias("symbols"),
        count("[|]").alias("pipes"),
        count("[!?]").alias("marks"),
        count("\\p{Lu}").alias("capitals"),
        count("[0-9]").alias("digits"),
    )
    n = F.size(w)
    d = d.select(
        "doc_id",
        F.log1p(n).alias("log_words"),
        share(F.length(F.array_join(w, "")), n).alias("mean_word_chars"),
        share(F.col("symbols"), n).alias("symbols_per_word"),
        share(F.col("pipes"), n).alias("pipes_per_word"),
        share(F.col("marks"), n).alias("marks_per_word"),
        share(F.size(F.filter(w, lambda x: x.isin(STOP_WORD_FORMS))), n).alias("stops_per_word"),
        share(F.col("capitals"), F.col("chars")).alias("capitals_share"),
        share(F.col("digits"), F.col("chars")).alias("digits_share"),
        share(F.size(F.array_distinct(w)), n).alias("distinct_share"),
        share(F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))), n).alias("repeat_share"),
        share(n, F.size(lines)).alias("words_per_line"),
        share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)).alias("dup_line_share"),
    )
    return d


# One rule: (statistic, True for "at most" or False for "above", threshold) each.
Rule = tuple[tuple[str, bool, float], ...]

_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)$")


def tree_rules(description: str) -> list[Rule]:
    """The path to every node below the root, read from a tree's text."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    rules = []
    for line in description.splitlines():
        if m := _BRANCH.match(line):
            depth = len(m[1])
            path = [step for step in path if step[0] < depth]
            path.append((depth, (STATISTICS[int(m[2])], m[3] == "<=", float(m[4]))))
            rules.append(tuple(sorted({step for _, step in path})))
    return rules


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, at_most, threshold in rule:
        out = out & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
    return out


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; ``constant`` replaces them where nothing was learnt."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float
    constant: float | None = None

    def score(self) -> Column:
        """Probability of label 1 as one expression over the statistics."""
        if self.constant is not None:
            return F.lit(self.constant)
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(condition(rule), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-z))


def training_rows(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Statistics and ``label`` of the sample, written once."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("double").alias("label"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    if n > train_rows:
        known = known.where(draw < train_rows / n)
    return materialize(stats.join(known, "doc_id").select(*STATISTICS, "label"), "training-rows")


def fit(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ensemble:
    rows = training_rows(stats, labels, train_rows)
    present = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(present) < 2:
        return Ensemble((), 0.0, constant=present.pop() if present else 0.5)
    vectors = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)})
    if not rules:  # no statistic tells the classes apart
        return Ensemble((), 0.0, constant=rows.agg(F.avg("label")).first()[0])
    held = rows.select(array_to_vector(F.array(*[condition(r).cast("double") for r in rules])).alias("features"), "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=L1_PENALTY, maxIter=60).fit(held)
    weighed = tuple((r, float(c)) for r, c in zip(rules, lasso.coefficients.toArray(), strict=True) if c)
    return Ensemble(weighed, float(lasso.intercept))


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    stats = materialize(statistics(docs), "statistics")
    score = fit(stats, labels, train_rows).score()
    out = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= cutoff, 1).otherwise(0))
