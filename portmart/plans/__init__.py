"""Composite jobs: the ETL pipeline, the analyses and the query catalog."""
