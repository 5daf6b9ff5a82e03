"""Run the batch pipeline.

    python -m portmart --config config.cfg [--layout partitioned]
    python -m portmart --arrivals A --temperature T --demographics D \\
        --labels L --output O

On a cluster, ship the package (``--py-files portmart.zip``) and submit
``portmart/__main__.py`` with the same arguments.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from portmart.config import PipelineConfig
from portmart.plans.pipeline import run_pipeline
from portmart.session import build_session, scale_settings


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="portmart", description=__doc__.splitlines()[0])
    ap.add_argument("--config", help="INI file with a [DATA] section of paths")
    ap.add_argument("--arrivals")
    ap.add_argument("--arrivals-format", default="parquet")
    ap.add_argument("--temperature")
    ap.add_argument("--demographics")
    ap.add_argument("--labels")
    ap.add_argument("--output")
    ap.add_argument("--layout", choices=["flat", "partitioned"], default="flat")
    ap.add_argument("--country", default="United States")
    ap.add_argument("--master", default=None, help="only for local runs")
    ap.add_argument(
        "--input-bytes", type=int, default=None,
        help="total input size; sizes the shuffles (see session.scale_settings); needed unless --master is given",
    )
    ap.add_argument("--strict", action="store_true", help="fail when a check fails")
    args = ap.parse_args(argv)
    options = dict(arrivals_format=args.arrivals_format, layout=args.layout, country=args.country)
    paths = [args.arrivals, args.temperature, args.demographics, args.labels, args.output]
    if args.config:
        cfg = PipelineConfig.from_ini(args.config, **options)
    elif all(paths):
        cfg = PipelineConfig(*paths, **options)
    else:
        ap.error("give --config or all of --arrivals --temperature --demographics --labels --output")
    if args.input_bytes is None and args.master is None and SparkSession.getActiveSession() is None:
        ap.error("on a cluster give --input-bytes: the shuffles are sized from it")
    extra = scale_settings(args.input_bytes) if args.input_bytes else None
    spark = build_session(master=args.master, extra=extra)
    result = run_pipeline(spark, cfg, raise_on_failure=args.strict)
    print(result.message)
    return 0 if all(r[2] for r in result.report) else 1


if __name__ == "__main__":
    sys.exit(main())
