"""Online pair scoring as a Structured Streaming query.

The original serves one prediction per HTTP request (M10 behind an API).
Here requests arrive as files of ``user_id,business_id`` lines in a folder;
each micro-batch is scored with the same scorer used in batch (stream-static
left joins against the user / business / mean tables, then the model's
``transform`` for the model scorer) and written to the sink with names and
the actual validation rating when there is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rekko.operators.scoring import rejected
from rekko.session import cut_lineage

REQUEST_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()),
                               T.StructField("business_id", T.StringType())])


def request_stream(spark: SparkSession, folder: str, schema: T.StructType = REQUEST_SCHEMA,
                   max_files_per_trigger: int = 100) -> DataFrame:
    """Pair requests from CSV files (with a header) dropped into ``folder``."""
    return (spark.readStream.schema(schema).option("header", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))


def scored_stream(requests: DataFrame, scorer, user_names: DataFrame,
                  business_names: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """Score each request; rows with a missing id go to :func:`rejected_stream` (the API
    answered 400 for them)."""
    # Static sides are materialized once (reliable checkpoints): the stream
    # then joins plain tables, whatever the lineage that built them.
    scorer = scorer.materialized() if hasattr(scorer, "materialized") else scorer
    ok = requests.filter(F.col("user_id").isNotNull() & F.col("business_id").isNotNull())
    scored = scorer.score(ok.select("user_id", "business_id"))
    out = (scored.join(cut_lineage(user_names), "user_id", "left")
           .join(cut_lineage(business_names), "business_id", "left"))
    if truth is not None:
        last = cut_lineage(truth.groupBy("user_id", "business_id").agg(
            F.max_by("stars", "ord").alias("actual_rating")))
        out = out.join(last, ["user_id", "business_id"], "left")
    else:
        out = out.withColumn("actual_rating", F.lit(None).cast("double"))
    return out.select(
        "user_id", F.coalesce("user_name", F.lit("N/A")).alias("user_name"),
        "business_id", F.coalesce("business_name", F.lit("N/A")).alias("business_name"),
        F.col("prediction").alias("predicted_rating"), "actual_rating",
        F.current_timestamp().alias("timestamp"))


def rejected_stream(requests: DataFrame) -> DataFrame:
    """Requests with a missing id, each with its reason."""
    return rejected(requests)


def start(scored: DataFrame, checkpoint: str, path: str | None = None, sink: str = "parquet",
          name: str = "scored_pairs") -> StreamingQuery:
    """Start the query (append mode).  ``checkpoint`` must be a shared folder
    so the query resumes after a driver or executor loss.  The ``memory`` sink
    gathers every row in the driver and is for small trials only."""
    if sink != "memory" and not path:
        raise ValueError("a file sink needs a path")
    w = scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    return w.format(sink).option("path", path).start()
