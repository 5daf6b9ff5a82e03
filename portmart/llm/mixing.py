"""Mixing sources to target weights by capped water-filling.

Every source gets a weight; its target is its share of the budget, stopped
at ``max_epochs`` times its own size, the excess going to the others by
weight until none is above its stop.  A target is met with whole
repetitions of every document plus a seeded sample for the fraction.

The sample is stratified by size: documents whose sizes have the same number
of binary digits are a class, and from each class, largest first, the first
draws (a seeded hash order) are taken until the words taken from this and the
larger classes come nearest to their share of the need.  What a class misses
or exceeds is carried to the next, so a document that is longer than what is
missing is made up for by the shorter ones.  This is decided on sums over hash
ranges first, and then once more on the documents of the ranges next to each
class's cut; both tables grow with the square root of a source's rows, and one
task reads those of a source.  What decides in the end is one row per source
(``plan``), so documents meet their decision in one join on the source and
their text never moves.

Defined results: a null text has size 0; a null source is a source of its
own, last in order; a source of size 0 has target 0; rows equal in id and
text are taken or left together; an empty table gives an empty result;
columns other than id, text and source are ignored by ``mix`` and kept by
``repeat_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portmart.llm.common import materialize, own_prefix, text_of, words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = "mix-1"

# The first 8 hex digits of the key as a number below 2**32.
KEY_SPAN = float(2**32)


def draw_key(doc_id: Column, text: Column, seed: str) -> Column:
    """The seeded draw of a document: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text))


def hash_range(key: Column, n_ranges: Column) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") * n_ranges / KEY_SPAN)


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, key`` of every document."""
    t = text_of("text")
    return docs.select("doc_id", "source", F.size(words(t)).cast("long").alias("size"), draw_key(F.col("doc_id"), t, seed).alias("key"))


def sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` with the sum of each expression over all rows before, in total
    ``order``: range partitions are summed first, so no task holds all rows
    (the window over the partitions has one row for each of them)."""
    parts = materialize(rows.orderBy(*order).withColumn("part", F.spark_partition_id()), name)
    whole = parts.groupBy("part").agg(*[F.sum(c).alias(f"{n}_part") for n, c in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select("part", *[F.coalesce(F.sum(f"{n}_part").over(earlier), F.lit(0)).alias(f"{n}_start") for n in sums])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(starts, "part").select(
        *rows.columns, *[(F.col(f"{n}_start") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()]
    )
    return materialize(out, name)


def water_fill(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """Targets for ``source, source_size`` rows, one row per source.

    Clamping and resharing until nothing is above its stop ends at one common
    level per unit of weight; sources in order of stop per weight reach it
    last, so running sums over that order give the level directly.
    """
    by_name = F.col("source").asc_nulls_last()
    pick = F.array(*[F.lit(w) for w in weights])
    s = sums_before(sources, [by_name], {"number": F.lit(1)}, "mix-sources-by-name")
    s = s.withColumn("weight", F.get(pick, (F.col("number") % len(weights)).cast("int"))).drop("number")
    s = s.withColumn("stop", F.col("source_size") * F.lit(max_epochs))
    by_level = [F.col("stop") / F.col("weight"), by_name]
    s = sums_before(s, by_level, {"stops_before": F.col("stop"), "weight_before": F.col("weight")}, "mix-sources-by-level")
    everything = s.agg(F.sum("source_size").alias("words"), F.sum("stop").alias("stops"), F.sum("weight").alias("all_weight"))
    s = s.withColumn("budget", F.least(everything.select("words").scalar() * F.lit(share), everything.select("stops").scalar()))
    s = s.withColumn(
        "stopped",
        F.col("stop") * (everything.select("all_weight").scalar() - F.col("weight_before"))
        <= (F.col("budget") - F.col("stops_before")) * F.col("weight"),
    )
    s = materialize(s, "mix-levels")
    rest = F.max("budget") - F.coalesce(F.sum(F.when(F.col("stopped"), F.col("stop"))), F.lit(0.0))
    free = F.sum(F.when(~F.col("stopped"), F.col("weight")))
    return s.select(
        "source",
        "source_size",
        F.when(F.col("stopped"), F.col("stop"))
        .otherwise(F.col("weight") * s.agg(rest).scalar() / s.agg(free).scalar())
        .alias("target"),
    )


def size_class(size: Column) -> Column:
    """The number of binary digits of a size."""
    return F.length(F.bin(size))


def nearest(options: pd.DataFrame) -> pd.DataFrame:
    """One row per class of one source: of its options, each the first
    ``words`` words up to ``pos``, or none (``base`` words), the one that comes
    nearest to ``goal`` with what the larger classes took; ties to the fewest.
    ``words_before`` is of the option before it, ``pos_after`` of the one after."""
    taken, out = 0, []
    options = options.sort_values(["class", "pos"], ascending=[False, True])
    for size_cls, c in options.groupby("class", sort=False):
        words = np.concatenate([c["base"].to_numpy()[:1], c["words"].to_numpy()])
        pos = [None, *c["pos"], None]
        i = int(np.argmin(np.abs(words + taken - c["goal"].to_numpy()[0])))
        taken += int(words[i])
        out.append((c["source"].iloc[0], size_cls, pos[i], pos[i + 1], int(words[max(i - 1, 0)])))
    return pd.DataFrame(out, columns=["source", "class", "pos", "pos_after", "words_before"])


def plan(
    records: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """One row per source: its target and which draws are taken once more.

    ``whole`` is how often every document is taken; ``cuts`` gives for each
    size class the first hash range (of about sqrt(n) for n documents) that is
    not taken whole and the last draw taken in it or after it.
    """
    per_source = records.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    per_source = materialize(per_source, "mix-sources")
    targets = water_fill(per_source.select("source", "source_size"), weights, share, max_epochs)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("int")
    s = targets.alias("t").join(
        per_source.select(F.col("source").alias("s2"), "n_docs"), F.col("t.source").eqNullSafe(F.col("s2"))
    )
    need = F.col("target") - whole * F.col("source_size")
    s = s.select(
        "source",
        "source_size",
        "target",
        whole.alias("whole"),
        F.coalesce(F.try_divide(need, F.col("source_size")), F.lit(0.0)).alias("fraction"),
        F.ceil(F.sqrt("n_docs")).cast("double").alias("n_ranges"),
    )
    s = materialize(s, "mix-targets")

    side = s.select(F.col("source").alias("s_source"), "fraction", "n_ranges")
    r = records.join(side, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    r = r.select(
        "source", "fraction", size_class(F.col("size")).alias("class"), "size", "key",
        hash_range(F.col("key"), F.col("n_ranges")).alias("range"),
    )
    ranges = materialize(r.groupBy("source", "fraction", "class", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    larger = Window.partitionBy("source").orderBy(F.desc("class"))
    goals = ranges.groupBy("source", "fraction", "class").agg(F.sum("words").alias("words"))
    goals = goals.select(
        F.col("source").alias("g_source"), F.col("class").alias("g_class"),
        (F.col("fraction") * F.sum("words").over(larger)).alias("goal"),
    )
    goals = materialize(goals, "mix-goals")
    in_class = F.col("source").eqNullSafe(F.col("g_source")) & (F.col("class") == F.col("g_class"))
    by_range = Window.partitionBy("source", "class").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    options = ranges.join(goals, in_class).select(
        "source", "class", F.col("range").alias("pos"), F.sum("words").over(by_range).alias("words"),
        F.lit(0).cast("long").alias("base"), "goal",
    )
    kind = records.schema["source"].dataType.simpleString()
    chosen = f"source {kind}, class int, pos %s, pos_after %s, words_before long"
    near = options.groupBy("source").applyInPandas(nearest, chosen % ("long", "long"))

    # Of a class, the last range taken and the next one are decided by document.
    near = near.select(
        F.col("source").alias("n_source"), F.col("class").alias("n_class"), F.col("words_before").alias("base"),
        F.coalesce("pos", "pos_after").alias("from_range"), F.coalesce("pos_after", "pos").alias("to_range"),
    )
    near = materialize(near, "mix-near")
    at_cut = F.col("source").eqNullSafe(F.col("n_source")) & (F.col("class") == F.col("n_class"))
    at_cut &= F.col("range").between(F.col("from_range"), F.col("to_range"))
    drawn = r.join(near, at_cut).groupBy("source", "class", "key", "base").agg(F.sum("size").alias("size"))
    by_key = Window.partitionBy("source", "class").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    options = drawn.join(goals, in_class).select(
        "source", "class", F.col("key").alias("pos"), (F.col("base") + F.sum("size").over(by_key)).alias("words"), "base", "goal"
    )
    last = options.groupBy("source").applyInPandas(nearest, chosen % ("string", "string"))
    cuts = last.join(near, F.col("source").eqNullSafe(F.col("n_source")) & (F.col("class") == F.col("n_class")))
    # One entry for each binary digit of a size at most.
    cuts = cuts.groupBy(F.col("source").alias("c_source")).agg(
        F.map_from_entries(
            F.collect_list(F.struct("class", F.struct("from_range", F.coalesce("pos", F.lit("")).alias("key"))))
        ).alias("cuts")
    )
    p = s.join(cuts, F.col("source").eqNullSafe(F.col("c_source")))
    return materialize(p.select("source", "source_size", "target", "whole", "n_ranges", "cuts"), "mix-plan")


def copies(size: Column, key: Column, prefix: str = "") -> Column:
    """How often the plan, its columns named with ``prefix``, takes the
    document of this size and draw."""
    col = lambda name: F.col(prefix + name)
    cut = F.element_at(col("cuts"), size_class(size))
    once = (hash_range(key, col("n_ranges")) < cut["from_range"]) | (key <= cut["key"])
    return col("whole") + F.when(once, 1).otherwise(0)


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    records = materialize(measured(docs, seed), "mix-records")
    p = plan(records).withColumnRenamed("source", "p_source")
    r = records.join(p, F.col("source").eqNullSafe(F.col("p_source")))
    return r.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies(F.col("size"), F.col("key"))).cast("long").alias("taken"),
    )


def repeat_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as many times as it is taken."""
    records = materialize(measured(docs, seed), "mix-records")
    own = own_prefix(docs)
    names = ("source", "whole", "n_ranges", "cuts")
    p = plan(records).select(*[F.col(c).alias(own + c) for c in names])
    d = docs.join(p, F.col("source").eqNullSafe(F.col(f"{own}source")))
    t = text_of("text")
    times = copies(F.size(words(t)), draw_key(F.col("doc_id"), t, seed), own)
    d = d.withColumn(f"{own}n", times).where(F.col(f"{own}n") > 0)
    return d.withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}n")))).select(*docs.columns)

