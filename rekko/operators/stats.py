"""Rating statistics: counts, means, last-wins dedup, per-key lists.

Everything is a keyed aggregate (partial + final hash aggregate, one shuffle
on the key).  Nested "key -> list/map" shapes of the original are kept in
long form: collecting one hot key's rows into a single list or map would put
an unbounded group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekko.schema import RATINGS, RatingSchema


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def item_means(r: DataFrame, s: RatingSchema = RATINGS, digits: int | None = None) -> DataFrame:
    """Mean rating and count per item over all rows (duplicates count)."""
    return r.groupBy(s.item).agg(
        _round(F.avg(s.stars), digits).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"))


def user_means(r: DataFrame, s: RatingSchema = RATINGS, digits: int | None = None) -> DataFrame:
    """Mean rating and count per user."""
    return r.groupBy(s.user).agg(
        _round(F.avg(s.stars), digits).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"))


def global_mean(r: DataFrame, s: RatingSchema = RATINGS, digits: int | None = None) -> DataFrame:
    """One row ``(avg_rating, n_ratings)``; an empty input gives 0.0."""
    return r.agg(
        _round(F.coalesce(F.avg(s.stars), F.lit(0.0)), digits).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"))


def dedup_last(r: DataFrame, s: RatingSchema = RATINGS) -> DataFrame:
    """One row per (user, item); the rating of the last row in file order.

    ``max_by`` over a fixed-width order key is a hash aggregate, combined
    map-side before the shuffle on (user, item); ``first_ord`` (the first occurrence) is kept
    for seed ordering in candidate generation, ``sum_stars`` / ``n_rows``
    let item means over all rows be rebuilt without another scan.
    """
    return r.groupBy(s.user, s.item).agg(
        F.max_by(s.stars, s.order).alias(s.stars),
        F.min(s.order).alias("first_ord"),
        F.sum(s.stars).alias("sum_stars"),
        F.count(F.lit(1)).alias("n_rows"))


def counts_with_names(r: DataFrame, key: str, names: DataFrame, name_col: str,
                      n: int = 5) -> DataFrame:
    """G13 + J4: top-``n`` keys by number of ratings, with their name.

    ``names`` is ``(key, name_col)``; a key without a name gets null, as in
    the exported reports.  The limit is the feature (a top-n report): Spark
    plans it as TakeOrderedAndProject, a per-partition top-n then a merge.
    """
    counts = r.groupBy(key).agg(F.count(F.lit(1)).alias("rating_count"))
    top = counts.orderBy(F.desc("rating_count"), F.asc(key)).limit(n)
    return (top.join(names.select(key, F.col(name_col).alias("name")), key, "left")
            .select(key, "rating_count", "name"))


def rated_with_names(r: DataFrame, key: str, other: str, names: DataFrame,
                     name_col: str, out_name: str) -> DataFrame:
    """Every (key, other) rating row with the other side's name.

    Duplicates are kept (the original lists keep them); a missing name is
    ``'N/A'``.
    """
    named = names.select(F.col(names.columns[0]).alias(other), F.col(name_col).alias(out_name))
    return (r.select(key, other).join(named, other, "left")
            .select(key, other, F.coalesce(F.col(out_name), F.lit("N/A")).alias(out_name)))


def top_by_mean(r: DataFrame, s: RatingSchema = RATINGS, n: int = 300,
                digits: int | None = None) -> DataFrame:
    """L2: the ``n`` items with the highest mean rating (no minimum support).

    Ties are broken by item id.  This is the cold-start pool; it is at most
    ``n`` rows whatever the input size.
    """
    means = item_means(r, s, digits)
    w = Window.orderBy(F.desc("avg_rating"), F.asc(s.item))
    # A global top-n: Spark plans orderBy+limit as TakeOrderedAndProject
    # (per-partition top-n, then a merge of n rows per partition).
    top = means.orderBy(F.desc("avg_rating"), F.asc(s.item)).limit(n)
    return top.withColumn("pool_rank", F.row_number().over(w).cast("long"))


def first_per_user(sample: DataFrame, s: RatingSchema = RATINGS, n: int = 100) -> DataFrame:
    """G14 + L4: among the first ``n`` rows in file order, each user's first item.

    The limit is the feature (a form pre-fill sample).  Output rows
    ``(user, item)``; the distinct items of it are U4.
    """
    first = sample.orderBy(s.order).limit(n)
    return first.groupBy(s.user).agg(
        F.min_by(s.item, s.order).alias(s.item))


def photo_counts(photos: DataFrame, businesses: DataFrame, key: str = "business_id") -> DataFrame:
    """G1 + J1: photos per business, 0 when a business has none."""
    counts = photos.groupBy(key).agg(F.count(F.lit(1)).alias("photo_count"))
    return (businesses.select(key).join(counts, key, "left")
            .select(key, F.coalesce(F.col("photo_count"), F.lit(0)).cast("long").alias("photo_count")))
