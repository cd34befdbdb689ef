"""Sinks: CSV reports and parquet artifact tables (K1-K6).

Every writer produces a directory of part files (Spark's output layout) in
overwrite mode; rows keep a meaningful order only where the report has one
(the writer sorts first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, order_by: list | None = None) -> str:
    """CSV with a header line, no quoting of plain fields."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet table (artifacts, intermediate tables in the shared folder)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
