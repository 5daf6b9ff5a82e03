"""Code -> label decoding with a label list (country, state, mode ...).

An equi-join on the code, not a search.  The list is written once, so Spark
knows its size: short lists are broadcast, longer ones shuffled.  Codes missing from the list take the
label of ``default_code`` when the list has one (the state list files
unknown states under '99').
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.session import materialize


def decode(
    df: DataFrame,
    code_col: str,
    labels: DataFrame,
    out_col: str,
    default_code: str | None = None,
) -> DataFrame:
    """Add ``out_col``: the label of ``df[code_col]`` in ``labels``
    (``code, label``), compared after trimming spaces.  When the same code
    is listed twice the first listing wins."""
    lab = labels.select(
        F.trim("code").alias("_code"), F.col("label").alias("_label"), F.col("ord").alias("_ord")
    )
    lab = materialize(lab.groupBy("_code").agg(F.min_by("_label", "_ord").alias("_label")), "codes")
    out = df.join(lab, F.trim(F.col(code_col)) == F.col("_code"), "left").drop("_code")
    if default_code is not None:
        fallback = lab.where(F.col("_code") == F.lit(default_code)).agg(F.min("_label")).scalar()
        out = out.withColumn("_label", F.coalesce("_label", fallback))
    return out.withColumnRenamed("_label", out_col)
