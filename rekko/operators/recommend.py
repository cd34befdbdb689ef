"""Recommendations and cross-user predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekko.operators.candidates import candidates as make_candidates
from rekko.operators.scoring import observed
from rekko.operators.stats import dedup_last
from rekko.schema import RATINGS, RatingSchema


def recommend(users: DataFrame, train: DataFrame, topk: DataFrame, scorer,
              user_names: DataFrame, places: DataFrame, k: int = 10,
              per_item_k: int = 20, max_pool: int = 300,
              s: RatingSchema = RATINGS, counts: Observation | None = None,
              kept: list[DataFrame] | None = None) -> DataFrame:
    """Top-``k`` items per user by predicted rating, with names and place.

    ``places`` is ``(business_id, business_name, city, state)``.  Candidate
    pairs of all users are scored in one pass; failed scores (NULL) are
    dropped (F8); ``row_number() <= k`` per user is limited before the
    shuffle.  ``counts`` observes that pass: once the result has been computed it holds the numbers of
    ``candidates``, ``scored`` and ``rejected`` pairs.  A user without candidates gets no rows.  Not clipped.
    ``kept`` as in :func:`rekko.operators.candidates.warm_candidates`.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    cands = make_candidates(users, train, topk, s, per_item_k, max_pool, kept)
    return top_scored(cands, scorer, user_names, places, k, s, counts)


def top_scored(cands: DataFrame, scorer, user_names: DataFrame, places: DataFrame, k: int = 10,
               s: RatingSchema = RATINGS, counts: Observation | None = None) -> DataFrame:
    """The ranking part of :func:`recommend`, on candidate pairs that are given."""
    if k < 1:
        raise ValueError("k must be >= 1")
    scored = scorer.score(cands.select(s.user, s.item), s)
    if counts is not None:
        scored = observed(scored, counts)
    scored = scored.filter(F.col("prediction").isNotNull())
    w = Window.partitionBy(s.user).orderBy(F.desc("prediction"), F.asc(s.item))
    top = (scored.withColumn("rank", F.row_number().over(w))
           .filter(F.col("rank") <= k))
    return (top.join(user_names, s.user, "left").join(places, s.item, "left")
            .select(s.user, F.coalesce("user_name", F.lit("N/A")).alias("user_name"),
                    s.item, F.coalesce("business_name", F.lit("N/A")).alias("business_name"),
                    F.coalesce("city", F.lit("N/A")).alias("city"),
                    F.coalesce("state", F.lit("N/A")).alias("state"),
                    F.col("prediction").alias("predicted_rating"),
                    F.col("rank").cast("long").alias("rank")))


def target_on_reference(requests: DataFrame, train: DataFrame, scorer,
                        business_names: DataFrame, s: RatingSchema = RATINGS) -> DataFrame:
    """For each ``(target_id, reference_id)`` request, the target's
    predicted rating on every item the reference rated (one row per rating
    row, duplicates kept), with both users' true (last) ratings.

    Output ``target_id, reference_id, business_id, business_name,
    predicted_for_target, ref_user_true, target_true``, sorted by request
    then prediction (desc).
    """
    ref_rows = train.select(F.col(s.user).alias("reference_id"), s.item)
    pairs = requests.select("target_id", "reference_id").join(ref_rows, "reference_id")
    # every row is scored where it is: no distinct pairs, no join back.  A row without an id has no score
    whole = F.col(s.user).isNotNull() & F.col(s.item).isNotNull()
    scored = scorer.score(pairs.select(F.col("target_id").alias(s.user), s.item, "reference_id"), s).select(
        F.col(s.user).alias("target_id"), "reference_id", s.item,
        F.when(whole, F.col("prediction")).alias("predicted_for_target"))
    last = dedup_last(train, s).select(s.user, s.item, s.stars)
    ref_true = last.select(F.col(s.user).alias("reference_id"), s.item,
                           F.col(s.stars).alias("ref_user_true"))
    tgt_true = last.select(F.col(s.user).alias("target_id"), s.item,
                           F.col(s.stars).alias("target_true"))
    out = (scored.join(ref_true, ["reference_id", s.item], "left")
           .join(tgt_true, ["target_id", s.item], "left")
           .join(business_names, s.item, "left"))
    # L3: a global sort (range-partitioned, so one big request is spread
    # over several tasks) rather than a window over each request.
    return out.select(
        "target_id", "reference_id", s.item,
        F.coalesce("business_name", F.lit("N/A")).alias("business_name"),
        "predicted_for_target", "ref_user_true", "target_true",
    ).orderBy("target_id", "reference_id", F.desc("predicted_for_target"), s.item)


def recommend_from_artifacts(spark, art_dir: str, users: DataFrame, scorer, k: int = 10,
                             s: RatingSchema = RATINGS) -> DataFrame | None:
    """M14 served from saved artifacts (S8): ratings, top-k table and names, all of one version.

    Returns None when the newest version lacks one of them, the case in
    which the original turns the recommendation feature off.
    """
    from rekko.sources import artifacts
    version = artifacts.open_version(spark, art_dir)
    tables = {n: version.load(n) for n in ("item_topk", "ratings", "user_dim", "business_dim")} if version else {}
    if not tables or any(t is None for t in tables.values()):
        return None
    topk, ratings, user_dim, business_dim = tables.values()
    user_names = user_dim.select(s.user, F.col("name").alias("user_name"))
    places = business_dim.select(s.item, F.col("name").alias("business_name"), "city", "state")
    return recommend(users, ratings, topk, scorer, user_names, places, k=k, s=s)
