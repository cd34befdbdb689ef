"""Ranked samples of validation results.

``results`` rows: ``user_id, business_id, pred_rating, true_rating,
user_name, business_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Prediction intervals of the low-error sample (fixed values); they overlap,
# so a row may be reported in two intervals.
INTERVALS = [(1.0, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, 5.0), (4.9, 5.1)]

RESULT_COLUMNS = ["user_id", "business_id", "pred_rating", "true_rating",
                  "user_name", "business_name"]


def top_predicted(results: DataFrame, n: int = 10) -> DataFrame:
    """L1: the ``n`` rows with the highest prediction (ties by ids).

    Planned as TakeOrderedAndProject: a top-n per partition, then a merge.
    """
    return (results.orderBy(F.desc("pred_rating"), "user_id", "business_id")
            .limit(n).select(*RESULT_COLUMNS))


def low_error_sample(results: DataFrame, per_interval: int = 3, max_error: float = 0.1,
                     order: str | None = None) -> DataFrame:
    """Per interval [low, high), the ``per_interval`` rows with the
    smallest error among rows with error < ``max_error``.

    The range condition against the five intervals is an array filter on
    each row (no join); ``row_number() <= n`` per interval is limited before
    the shuffle, so each interval's task receives at most n rows per map
    task.  Ties in error keep the earlier row (``order``, else the ids).
    """
    err = F.abs(F.col("pred_rating") - F.col("true_rating"))
    table = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(lo).alias("low"),
                               F.lit(hi).alias("high"),
                               F.lit(f"{lo}-{hi}").alias("interval"))
                      for i, (lo, hi) in enumerate(INTERVALS)])
    p = F.col("pred_rating")
    hits = F.filter(table, lambda iv: (p >= iv["low"]) & (p < iv["high"]))
    tagged = (results.withColumn("error", err).filter(F.col("error") < max_error)
              .select("*", F.explode(hits).alias("iv")))
    tie = [F.col(order)] if order else [F.col("user_id"), F.col("business_id")]
    w = Window.partitionBy(F.col("iv.pos")).orderBy(F.col("error"), *tie)
    return (tagged.withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= per_interval)
            .select(*RESULT_COLUMNS, "error", F.col("iv.interval").alias("interval"),
                    F.col("iv.pos").cast("long").alias("interval_pos"),
                    F.col("rn").cast("long").alias("rank_in_interval")))
