"""Evaluation of predictions against true ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Error buckets (fixed values): half-open [low, high), the last open-ended.
BUCKETS = [("0-1", 0.0, 1.0), ("1-2", 1.0, 2.0), ("2-3", 2.0, 3.0),
           ("3-4", 3.0, 4.0), ("4+", 4.0, None)]


def _scored(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Rows with a numeric label; rows whose label is null are left out."""
    return (df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull())
            .select("*", F.abs(F.col(pred) - F.col(label)).alias("abs_err")))


def rmse(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """One row ``(rmse, n)``; one aggregate pass."""
    s = _scored(df, pred, label)
    return s.agg(F.sqrt(F.avg(F.col("abs_err") * F.col("abs_err"))).alias("rmse"),
                 F.count(F.lit(1)).alias("n"))


def error_histogram(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """``(bucket, count, percent)`` for the 5 buckets, zeros kept.

    All five counts come from one aggregate (``count_if`` per bucket), then
    ``stack`` turns the single row into five.
    """
    s = _scored(df, pred, label)
    e = F.col("abs_err")
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, (_, lo, hi) in enumerate(BUCKETS):
        cond = (e >= lo) if hi is None else ((e >= lo) & (e < hi))
        aggs.append(F.count_if(cond).alias(f"b{i}"))
    one = s.agg(*aggs)
    stack = "stack(5, " + ", ".join(f"'{name}', b{i}" for i, (name, _, _) in enumerate(BUCKETS)) \
        + ") AS (bucket, count)"
    return (one.selectExpr("total", stack)
            .select("bucket", F.col("count").cast("long").alias("count"),
                    (F.col("count") / F.nullif(F.col("total"), F.lit(0)) * 100.0)
                    .alias("percent")))


def high_errors(df: DataFrame, pred: str = "prediction", label: str = "label",
                threshold: float = 3.0, keys: tuple[str, ...] = ("user_id", "business_id")) -> DataFrame:
    """rows whose absolute error is at least ``threshold``."""
    s = _scored(df, pred, label)
    return s.filter(F.col("abs_err") >= threshold).select(
        *keys, F.col(pred).alias("predicted"), F.col(label).alias("actual"),
        F.col("abs_err").alias("error"))
