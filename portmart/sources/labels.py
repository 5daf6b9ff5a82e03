"""Code-to-label lists ("value <name> 'CODE' = 'LABEL' ... ;") read as data.

The file is read with Spark's text source, once: its lines are written down
with the place they were found at (file, split, row in the scan), and all
that follows reads that copy.  The place orders the entries, which decides
the winner of the first-match lookup, for any number of files and splits, and
no two scans have to agree on how the files are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.session import materialize

# Layout of a label list.
# Section that lists port codes.
PORT_SECTION = "$i94prtl"
# One entry: optional quotes around the code, '=' and a quoted label in
# which a quote is written twice.
ENTRY_PATTERN = r"^\s*'?([^'=]*?)'?\s*=\s*'((?:[^']|'')*)'"
# A quoted string, removed before looking for the closing ';'.
QUOTED_PATTERN = r"'(?:[^']|'')*'"
# The visa list: a comment that names its column, then "code = label" lines.
VISA_HEADER = r"(?i)^\s*/\*\s*I94VISA\b"
VISA_ENTRY = r"^\s*([0-9]+)\s*=\s*([^'*]+?)\s*(?:\*/\s*)?$"

# The head of any value section, and the name its lines get in ``label_lists``.
ANY_HEADER = r"(?i)^\s*value\s+(\$?\w+)"
VISA_LIST = "i94visa"

# Where a line stands: compares in file-name order, then by position.
PLACE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(place, value)`` for the lines of a text file (or folder of files).

    A split is scanned in file order, so inside one split the row id grows
    line by line; splits compare by file and start.
    """
    lines = spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
        "value",
    )
    return materialize(lines, "label-lines")


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """The lines with a 1-based ``line_no``: lines in earlier splits plus the
    place in the own split.  One row per split passes through the driver."""
    splits = lines.groupBy("place.file", "place.block").agg(
        F.count(F.lit(1)).alias("n"), F.min("place.row").alias("first_row")
    )
    starts, before = [], 0
    for s in sorted(splits.collect(), key=lambda r: (r.file, r.block)):
        starts.append((s.file, s.block, before - s.first_row + 1))
        before += s.n
    table = lines.sparkSession.createDataFrame(starts, "_file string, _block long, _shift long")
    here = (F.col("place.file") == F.col("_file")) & (F.col("place.block") == F.col("_block"))
    return lines.join(table, here).select((F.col("place.row") + F.col("_shift")).alias("line_no"), "place", "value")


def _header_pattern(section: str) -> str:
    # Section names may start with '$' (text codes).
    name = section.replace("$", r"\$")
    return rf"(?i)^\s*value\s+{name}\b"


def label_table(lines: DataFrame, section: str = PORT_SECTION) -> DataFrame:
    """Entries of one section as ``(ord, code, label)``.

    ``ord`` is the place of the line (file order); ``code`` keeps inner and
    trailing spaces inside its quotes; the label loses its trailing
    whitespace and doubled quotes become one.  The section runs from its
    ``value`` line to the first line with a ';' outside quotes, and an
    entry on that closing line counts.
    """
    # The section's bounds are scalar subqueries over the same lines.
    start = lines.where(F.col("value").rlike(_header_pattern(section))).agg(F.min("place")).scalar()
    closes = F.contains(F.regexp_replace("value", QUOTED_PATTERN, ""), F.lit(";"))
    after = lines.where(F.col("place") > start)
    end = after.where(closes).agg(F.min("place")).scalar()
    return _entries(after.where(end.isNull() | (F.col("place") <= end)).where(F.col("value").rlike(ENTRY_PATTERN)))


def _entries(body: DataFrame) -> DataFrame:
    label = F.regexp_replace(F.regexp_extract("value", ENTRY_PATTERN, 2), "''", "'")
    return body.select(
        F.col("place").alias("ord"),
        F.regexp_extract("value", ENTRY_PATTERN, 1).alias("code"),
        F.regexp_replace(label, r"\s+$", "").alias("label"),
    )


def visa_table(lines: DataFrame) -> DataFrame:
    """The visa categories as ``(ord, code, label)``.  Their list is not a
    value section but a comment under the visa column's description: lines
    ``<digits> = <unquoted label>`` up to the end of the comment."""
    start = lines.where(F.col("value").rlike(VISA_HEADER)).agg(F.min("place")).scalar()
    after = lines.where(F.col("place") > start)
    end = after.where(F.contains("value", F.lit("*/"))).agg(F.min("place")).scalar()
    body = after.where(end.isNull() | (F.col("place") <= end)).where(F.col("value").rlike(VISA_ENTRY))
    return body.select(
        F.col("place").alias("ord"),
        F.regexp_extract("value", VISA_ENTRY, 1).alias("code"),
        F.trim(F.regexp_extract("value", VISA_ENTRY, 2)).alias("label"),
    )


def _in_force(lines: DataFrame, events: dict[str, Column]) -> DataFrame:
    """``lines`` with, for each column of ``events``, the last event that is not
    null on the lines before.

    A segmented scan: inside a split by a window over its lines, then every
    split takes over what the splits before it left (one row for each split).
    """
    marked = lines.select("place", "value", *[e.alias(n) for n, e in events.items()])
    split = ["place.file", "place.block"]
    left = marked.groupBy(*[F.col(c).alias(f"_{c[6:]}") for c in split]).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("place.row"))).alias(f"_{n}") for n in events]
    )
    splits_before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = left.select("_file", "_block", *[F.last(f"_{n}", ignorenulls=True).over(splits_before).alias(f"_{n}") for n in events])
    lines_before = Window.partitionBy(*split).orderBy("place.row").rowsBetween(Window.unboundedPreceding, -1)
    scanned = marked.select("place", "value", *[F.last(n, ignorenulls=True).over(lines_before).alias(n) for n in events])
    here = (F.col("place.file") == F.col("_file")) & (F.col("place.block") == F.col("_block"))
    return scanned.join(handed, here).select("place", "value", *[F.coalesce(n, f"_{n}").alias(n) for n in events])


def label_lists(lines: DataFrame) -> DataFrame:
    """The entries of every list of the file, ``(section, ord, code, label)``,
    found together: all value sections by their name in lower case, and the visa
    list as ``i94visa``.  The text is scanned once; the written lines are read
    three times (lines, splits, heads), however many lists there are.

    Each list equals ``label_table`` (or ``visa_table``) of its section: of a
    section named twice the first counts.  A header ends a section that was
    left open before it.
    """
    value = F.col("value")
    name = F.lower(F.regexp_extract(value, ANY_HEADER, 1))
    opened = lambda n: F.struct(n.alias("name"), F.col("place").alias("head"))
    closed = opened(F.lit(None).cast("string"))
    closes = F.contains(F.regexp_replace("value", QUOTED_PATTERN, ""), F.lit(";"))
    events = {
        "section": F.when(name != "", opened(name)).when(closes, closed),
        "visa": F.when(value.rlike(VISA_HEADER), opened(F.lit(VISA_LIST))).when(F.contains(value, F.lit("*/")), closed),
    }
    state = _in_force(lines, events)
    label = F.regexp_replace(F.regexp_replace(F.regexp_extract(value, ENTRY_PATTERN, 2), "''", "'"), r"\s+$", "")
    entry = F.when(
        F.col("section.name").isNotNull() & value.rlike(ENTRY_PATTERN),
        F.struct(F.col("section").alias("s"), F.regexp_extract(value, ENTRY_PATTERN, 1).alias("code"), label.alias("label")),
    )
    visa = F.when(
        F.col("visa.name").isNotNull() & value.rlike(VISA_ENTRY),
        F.struct(
            F.col("visa").alias("s"),
            F.regexp_extract(value, VISA_ENTRY, 1).alias("code"),
            F.trim(F.regexp_extract(value, VISA_ENTRY, 2)).alias("label"),
        ),
    )
    found = state.select("place", F.inline(F.array_compact(F.array(entry, visa))))
    heads = lines.select(F.inline(F.array_compact(F.array(*events.values())))).where(F.col("name").isNotNull())
    first = heads.groupBy(F.col("name").alias("section")).agg(F.min("head").alias("first"))
    return found.join(first, (F.col("s.name") == F.col("section")) & (F.col("s.head") == F.col("first"))).select(
        "section", F.col("place").alias("ord"), "code", "label"
    )


def read_label_table(
    spark: SparkSession, path: str, section: str = PORT_SECTION
) -> DataFrame:
    return label_table(read_label_lines(spark, path), section)
