"""Readers: raw CSV, partitioned Parquet, catalog tables, the event-log adapter."""
