"""Incremental refresh of the star schema as new monthly source files
land (Structured Streaming, run to completion on each schedule)."""

from portmart.streaming.refresh import append_new_rows, refresh_arrivals, refresh_city_temperature

__all__ = ["append_new_rows", "refresh_arrivals", "refresh_city_temperature"]
