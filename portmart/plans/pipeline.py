"""The batch pipeline: sources -> clean -> staging -> star schema ->
checks -> parquet."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from portmart.config import PipelineConfig
from portmart.operators import cleaning, mart, quality, staging
from portmart.operators.lookup import substring_codes
from portmart.sources.labels import read_label_table
from portmart.sources.readers import read_arrivals, read_demographics, read_temperature
from portmart.sources.sinks import read_partitioned, write_counted, write_partitioned, write_table

# Output folder of each star-schema table.
TABLE_FOLDERS = {
    "dim_immigrant": "immigrant",
    "dim_city": "city",
    "dim_city_temp": "city_temperature",
    "dim_time": "time",
    "fact_immigration": "immigration",
}

# Folder keys of the partitioned layout.
PARTITION_KEYS = {
    "dim_immigrant": ["gender", "age"],
    "dim_city": ["state_code"],
    "fact_immigration": ["state_code", "city_code"],
}


def folder_keys(name: str, layout: str) -> list[str]:
    """Folder keys of a table under a layout: one table, one layout, for the
    batch that writes it and the refresh that adds to it."""
    return PARTITION_KEYS.get(name, []) if layout == "partitioned" else []


def write_star_table(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    if keys:
        write_partitioned(df, path, keys, mode=mode)
    else:
        write_table(df, path, mode=mode)


@dataclass
class PipelineResult:
    message: str
    report: list[tuple]
    paths: dict[str, str] = field(default_factory=dict)


def _materialize(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and continue from the written copy: later consumers
    read parquet instead of recomputing the lineage (and a lost executor
    costs a re-read, not a re-run of the cleaning)."""
    write_table(df, path)
    # The schema is known: no footer-reading job to infer it.
    return spark.read.schema(df.schema).parquet(path)


def build_staging(
    spark: SparkSession, cfg: PipelineConfig
) -> tuple[DataFrame, DataFrame, DataFrame]:
    # One table of the labels serves both lookups.
    codes = substring_codes(read_label_table(spark, cfg.labels_path))
    arrivals = read_arrivals(
        spark, cfg.arrivals_path, fmt=cfg.arrivals_format, options=cfg.arrivals_reader_options()
    )
    temperature = read_temperature(spark, cfg.temperature_path)
    demographics = read_demographics(spark, cfg.demographics_path)

    stg_demo = staging.stage_demographics(cleaning.clean_demographics(demographics, codes=codes))
    stg_temp = staging.stage_temperature(
        cleaning.clean_temperature(temperature, country=cfg.country, codes=codes)
    )
    stg_arr = staging.stage_arrivals(cleaning.clean_arrivals(arrivals))
    return stg_arr, stg_temp, stg_demo


def build_star(stg_arr: DataFrame, stg_temp: DataFrame, stg_demo: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_immigrant": mart.dim_person(stg_arr),
        "dim_city": mart.dim_city(stg_demo, stg_temp),
        "dim_city_temp": mart.dim_city_metric(stg_temp),
        "dim_time": mart.calendar_dim(stg_arr),
        "fact_immigration": mart.fact_table(stg_arr),
    }


def run_pipeline(
    spark: SparkSession, cfg: PipelineConfig, raise_on_failure: bool = False
) -> PipelineResult:
    """Run the whole batch and return the check summary.

    Staging tables are written under ``<output>/staging`` and read back,
    so the arrivals staging (used by three tables) is computed once.
    The checks count each table's rows in the tasks that write it, so no
    written table is read again.
    """
    stg_arr, stg_temp, stg_demo = build_staging(spark, cfg)
    stg_arr = _materialize(spark, stg_arr, cfg.out("staging/immigration"))
    stg_temp = _materialize(spark, stg_temp, cfg.out("staging/temperature"))
    stg_demo = _materialize(spark, stg_demo, cfg.out("staging/demographics"))

    paths, records = {}, {}
    for name, df in build_star(stg_arr, stg_temp, stg_demo).items():
        paths[name] = cfg.out(TABLE_FOLDERS[name])
        records[name] = write_counted(df, paths[name], folder_keys(name, cfg.layout))
    report = quality.observed_report(records)
    message = quality.summarise(report, raise_on_failure)
    return PipelineResult(message=message, report=report, paths=paths)


def load_star(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """The written star schema, ready for the analyses."""
    reader = read_partitioned if cfg.layout == "partitioned" else (lambda s, p: s.read.parquet(p))
    return {name: reader(spark, cfg.out(folder)) for name, folder in TABLE_FOLDERS.items()}
