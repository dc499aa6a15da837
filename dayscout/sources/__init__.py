"""Readers, parsers, dimension tables and the Parquet table store."""
