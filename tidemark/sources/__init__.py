"""Readers, writers and the tables derived from the driver's parquet files."""
