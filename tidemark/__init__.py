"""Tidemark: catalogued, revisioned Parquet data on Spark."""
