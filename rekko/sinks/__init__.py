"""Sinks: CSV reports and parquet tables."""
