"""Pipeline paths, passed as an argument instead of read at import time."""

from __future__ import annotations

import configparser
import os
from dataclasses import dataclass

# Section and key names of the INI file the original batch
# program reads its paths from.
INI_SECTION = "DATA"
INI_KEYS = {
    "arrivals_path": "IMMIGRATION_DATA_FILE_PATH",
    "temperature_path": "TEMPERATURE_DATA_FILE_PATH",
    "demographics_path": "DEMOGRAPHICS_DATA_FILE_PATH",
    "labels_path": "SAS_LABELS_DESCRIPTION_FILE_PATH",
    "output_dir": "OUTPUT_DATA_DIR",
}


@dataclass(frozen=True)
class PipelineConfig:
    arrivals_path: str
    temperature_path: str
    demographics_path: str
    labels_path: str
    output_dir: str
    arrivals_format: str = "parquet"
    # Reader options for the arrivals (a CSV copy gets a header line by
    # default).
    arrivals_options: dict | None = None
    # "flat" writes each table unpartitioned; "partitioned" uses the
    # folder layout keyed for analysis (fact by state and city,
    # person by gender and age, city by state).
    layout: str = "flat"
    # Value the temperature rows must carry in Country to be kept.
    country: str = "United States"

    def arrivals_reader_options(self) -> dict:
        if self.arrivals_options is not None:
            return dict(self.arrivals_options)
        return {"header": True} if self.arrivals_format == "csv" else {}

    def out(self, table: str) -> str:
        return os.path.join(self.output_dir, table)

    @classmethod
    def from_ini(cls, path: str, **overrides) -> "PipelineConfig":
        """Paths from an INI file with a [DATA] section; relative paths are
        taken relative to the file's folder.  ``overrides`` set the other
        fields (format, layout, country)."""
        parser = configparser.ConfigParser()
        parser.optionxform = str  # keys keep their case
        if not parser.read(path):
            raise FileNotFoundError(path)
        section = parser[INI_SECTION]
        base = os.path.dirname(os.path.abspath(path))

        def resolve(value: str) -> str:
            return value if "://" in value or os.path.isabs(value) else os.path.normpath(os.path.join(base, value))

        fields = {name: resolve(section[key]) for name, key in INI_KEYS.items()}
        return cls(**fields, **overrides)
