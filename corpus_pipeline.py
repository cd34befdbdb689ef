"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on everything the one before
kept.  All but the last return the columns of ``documents``; ``n_chars`` follows
the text.  Null texts pass as empty ones, repeated rows and null ids as the
operators say, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekko.llm import packing, pii, simhash, suffix_array, toxicity
from rekko.llm.common import stored, table
from rekko.llm.queries import BYTES, RANKS, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; none does where it could learn nothing."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if model.weights is None:
        return docs
    return docs.filter(toxicity.score_column(model) < 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.keep_one(docs, words=3, max_bits=3)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in 50-byte strings that also start in a document with a smaller id go."""
    return counted(suffix_array.dedup_bytes(docs, length=50, whole_rows=True))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    return counted(docs.withColumn("text", pii.redacted_column()))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens with their ids, one row for each."""
    return packing.pack(docs, tokenizer(BYTES), tokenizer(RANKS), max_length=1024, end_id=0)


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("suffix_array", drop_repeated_bytes),
          ("pii", redact_personal_data), ("packing", pack_sequences)]

# Byte-level BPE ids cannot be computed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
