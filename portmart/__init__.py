"""portmart: arrival records, city temperatures and city demographics turned
into a star schema and analysed, written as plain PySpark DataFrame jobs."""

__version__ = "0.1.0"
