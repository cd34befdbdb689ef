"""Adapters from the TPC-H-style parquet tables to the engine's inputs.

Roles (our own mapping, used by tests, queries and the benchmark):

* user = customer (``o_custkey``), item = supplier (``l_suppkey``) for
  collaborative filtering, or part (``l_partkey``);
* one rating per lineitem: ``stars = 1 + CAST(l_quantity AS INT) % 5``;
* file order ``ord`` = (l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity) as the digits of one number; the last field only breaks ties
  between otherwise equal keys, so rows that tie on all five also have the
  same rating;
* train = orders dated before ``TRAIN_CUTOFF``, validation = the rest;
* photos = ``events`` rows, with ``events.user_id`` read as a business id;
* business / user JSON lines are generated from ``part`` / ``supplier`` /
  ``customer`` columns by :mod:`rekko.sources.synth` and parsed back with
  the same code that reads real JSON-lines files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekko.schema import RATINGS, RatingSchema, order_key

TRAIN_CUTOFF = _dt.datetime(2000, 1, 1)
SPLITS = ("all", "train", "validation")
ITEM_COLUMNS = {"supplier": "l_suppkey", "part": "l_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one parquet table, projecting to ``columns`` so only they are scanned."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ratings(spark: SparkSession, sf_dir: str, item: str = "supplier",
            split: str = "all", schema: RatingSchema = RATINGS) -> DataFrame:
    """Long-form ratings ``(user, item, stars, ord)`` from lineitem ⋈ orders.

    The split predicate is on ``o_orderdate`` and is pushed into the orders
    scan; lineitem is joined on its key (sort-merge at scale, both sides
    shuffled once on ``orderkey``).
    """
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    item_col = ITEM_COLUMNS[item]
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    if split == "train":
        orders = orders.filter(F.col("o_orderdate") < F.lit(TRAIN_CUTOFF))
    elif split == "validation":
        orders = orders.filter(F.col("o_orderdate") >= F.lit(TRAIN_CUTOFF))
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        F.col("o_custkey").alias(schema.user),
        F.col(item_col).alias(schema.item),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("double").alias(schema.stars),
        order_key(("l_orderkey", 12), ("l_linenumber", 2), ("l_partkey", 11), ("l_suppkey", 10),
                  ("l_quantity", 3)).alias(schema.order),
    )


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(s_suppkey, s_name, s_nationkey, city, state)``: city = nation, state = region.

    nation and region are fixed 25- and 5-row tables, so broadcasting them is
    bounded whatever the scale factor.
    """
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    places = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
    return (sup.join(F.broadcast(places), sup["s_nationkey"] == places["n_nationkey"], "left")
            .select("s_suppkey", "s_name", "s_nationkey",
                    F.col("n_name").alias("city"), F.col("r_name").alias("state")))


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photo rows ``(business_id)``: one per event, keyed by ``events.user_id``."""
    return table(spark, sf_dir, "events", "user_id").select(
        F.col("user_id").alias("business_id"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer id, as ``user_id``: the users to recommend for."""
    return table(spark, sf_dir, "customer", "c_custkey").select(
        F.col("c_custkey").alias("user_id"))
