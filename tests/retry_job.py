"""Run by test_retries.py in its own process: a session that retries
failed tasks, and a filter that fails the first attempt of partition 0."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import LABEL_FILE  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from portmart.operators.lookup import first_match_code  # noqa: E402
from portmart.sources.labels import label_table, read_label_lines, with_line_numbers  # noqa: E402


def _flaky(_):
    tc = TaskContext.get()
    if tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def main(folder: str) -> None:
    spark = (
        SparkSession.builder.master("local[2,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    flaky = F.udf(_flaky, "boolean")
    lines = LABEL_FILE.splitlines()
    os.makedirs(folder, exist_ok=True)
    for i, (a, b) in enumerate([(0, 5), (5, 19), (19, len(lines))]):
        with open(os.path.join(folder, f"part-{i:05d}.txt"), "w") as f:
            f.write("\n".join(lines[a:b]) + "\n")
    numbered = with_line_numbers(read_label_lines(spark, folder)).where(flaky(F.col("value")))
    labels = label_table(numbered)
    names = spark.createDataFrame(
        [(n,) for n in ["Portland", "Mesa", "Alton", "Oakland", "", None, "Nowhere"] * 30], "City string"
    ).repartition(3)
    out = first_match_code(names.where(flaky(F.col("City"))), "City", labels)
    result = {
        "line_nos": [r.line_no for r in numbered.orderBy("line_no").collect()],
        "n_lines": len(lines),
        "codes": sorted({(r.City, r.city_code) for r in out.collect()}, key=repr),
        "rows": out.count(),
    }
    print("RESULT " + json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
