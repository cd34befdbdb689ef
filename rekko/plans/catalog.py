"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the library on the TPC-H-style tables with the role mapping of
:mod:`rekko.sources.tables`, over the whole training or validation side.  The matching
DuckDB statements are in :mod:`rekko.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekko.operators import candidates as cand
from rekko.operators import similarity as sim
from rekko.operators import stats
from rekko.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

# What the queries persist, so that later ones find it again; see release().
_KEPT: list[DataFrame] = []


def release() -> None:
    """Unpersist everything the registered queries have persisted."""
    while _KEPT:
        _KEPT.pop().unpersist()


def _supplier_names(spark, sf_dir):
    return tables.table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        F.col("s_suppkey").alias("business_id"), F.col("s_name").alias("business_name"))


def _customer_names(spark, sf_dir):
    return tables.table(spark, sf_dir, "customer", "c_custkey", "c_name").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))


def _train(spark, sf_dir, item="supplier"):
    return tables.ratings(spark, sf_dir, item=item, split="train")


# ---------------------------------------------------------------- statistics

def q_top_items_by_mean(spark, sf_dir):
    return stats.top_by_mean(_train(spark, sf_dir, "part"), n=300)


def q_user_mean(spark, sf_dir):
    return stats.user_means(_train(spark, sf_dir))


def q_item_mean(spark, sf_dir):
    return stats.item_means(_train(spark, sf_dir))


def q_global_mean(spark, sf_dir):
    return stats.global_mean(_train(spark, sf_dir))


def q_rating_dedup_last(spark, sf_dir):
    return stats.dedup_last(_train(spark, sf_dir)).select(
        "user_id", "business_id", "stars", "n_rows")


def q_user_items(spark, sf_dir):
    return stats.rated_with_names(_train(spark, sf_dir), "user_id", "business_id",
                                  _supplier_names(spark, sf_dir), "business_name",
                                  "business_name")


def q_item_users(spark, sf_dir):
    return stats.rated_with_names(_train(spark, sf_dir), "business_id", "user_id",
                                  _customer_names(spark, sf_dir), "user_name", "user_name")


def q_photo_count(spark, sf_dir):
    parts = tables.table(spark, sf_dir, "part", "p_partkey").select(
        F.col("p_partkey").alias("business_id"))
    return stats.photo_counts(tables.photos(spark, sf_dir), parts)


def q_top_raters(spark, sf_dir):
    names = _customer_names(spark, sf_dir)
    return stats.counts_with_names(_train(spark, sf_dir), "user_id", names, "user_name")


def q_top_rated(spark, sf_dir):
    names = _supplier_names(spark, sf_dir)
    return stats.counts_with_names(_train(spark, sf_dir), "business_id", names, "business_name")


def q_first_item_sample(spark, sf_dir):
    val = tables.ratings(spark, sf_dir, split="validation")
    return stats.first_per_user(val, n=100)


# ---------------------------------------------------------------- similarity

def q_co_rating_sums(spark, sf_dir):
    train = _train(spark, sf_dir)
    sums = sim.unscaled_sums(sim.co_rating_sums(train, kept=_KEPT))
    return sums.select(F.col("a").alias("business_id"), F.col("b").alias("other_id"),
                       "sxy", "sxx", "syy", F.col("n").alias("co_users"))


def q_item_similarity(spark, sf_dir):
    sums = sim.co_rating_sums(_train(spark, sf_dir), min_raters=20, min_pair_count=20, kept=_KEPT)
    return sim.pair_similarity(sums, min_cousers=20).select(
        F.col("a").alias("business_id"), F.col("b").alias("other_id"),
        "sim", "corr", "co_users")


def _topk(spark, sf_dir):
    """The top-k table, persisted lazily with the ratings behind it: at most 50 rows an item,
    read by the candidate and recommendation queries.  release() frees both."""
    topk = sim.item_topk(_train(spark, sf_dir), topk=50, min_cousers=20, kept=_KEPT, with_order=True).persist(
        StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(topk)
    return topk


def q_item_topk(spark, sf_dir):
    return _topk(spark, sf_dir)


# ---------------------------------------------------------------- candidates

def _candidates(spark, sf_dir, max_pool):
    train = _train(spark, sf_dir)
    topk = _topk(spark, sf_dir)
    return cand.candidates(tables.customers(spark, sf_dir), train, topk,
                           per_item_k=20, max_pool=max_pool, kept=_KEPT)


def q_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir, 300)


def q_candidates_capped(spark, sf_dir):
    return _candidates(spark, sf_dir, 15)


QUERIES: dict[str, Query] = {
    "top_items_by_mean": q_top_items_by_mean,
    "user_mean": q_user_mean,
    "item_mean": q_item_mean,
    "global_mean": q_global_mean,
    "rating_dedup_last": q_rating_dedup_last,
    "user_items": q_user_items,
    "item_users": q_item_users,
    "photo_count": q_photo_count,
    "top_raters": q_top_raters,
    "top_rated": q_top_rated,
    "first_item_sample": q_first_item_sample,
    "co_rating_sums": q_co_rating_sums,
    "item_similarity": q_item_similarity,
    "item_topk": q_item_topk,
    "candidates": q_candidates,
    "candidates_capped": q_candidates_capped,
}


# ------------------------------------------------------- sources and features

def _spread(lines):
    """Lines dealt evenly to all cores: a small file is read by one task, and parsing costs far more than reading."""
    return lines.repartition(lines.sparkSession.sparkContext.defaultParallelism)


def _business(spark, sf_dir, domain="supplier"):
    """Business rows parsed from JSON generated out of ``domain``, with photos."""
    from rekko.operators.features import with_photos
    from rekko.sources.files import parse_business
    from rekko.sources.synth import business_json
    if domain == "supplier":
        src = tables.supplier_places(spark, sf_dir)
        lines = business_json(src, "s_suppkey", "s_nationkey", "s_name", "city", "state")
    else:
        src = tables.table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
        lines = business_json(src, "p_partkey", "p_size", "p_name", "p_brand", "p_type")
    return with_photos(parse_business(_spread(lines), id_type="bigint"), tables.photos(spark, sf_dir))


def _users(spark, sf_dir):
    from rekko.sources.files import parse_users
    from rekko.sources.synth import user_json
    cust = tables.table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                        "c_acctbal", "c_mktsegment")
    return parse_users(_spread(user_json(cust)), id_type="bigint")


def _features(spark, sf_dir, split):
    from rekko.operators.features import feature_table
    r = tables.ratings(spark, sf_dir, split=split)
    pairs = r.select("user_id", "business_id", F.col("stars").alias("label"))
    return feature_table(pairs, _users(spark, sf_dir), _business(spark, sf_dir), keep=("label",))


def q_business_features(spark, sf_dir):
    from rekko.operators.features import BUSINESS_FEATURES
    b = _business(spark, sf_dir, "part")
    return b.select("business_id", "name", "city", "state", *BUSINESS_FEATURES)


def q_user_features(spark, sf_dir):
    return _users(spark, sf_dir)


def q_feature_table(spark, sf_dir):
    return _features(spark, sf_dir, "train")


def q_onehot_levels(spark, sf_dir):
    from rekko.operators import encoding
    return encoding.level_frame(_features(spark, sf_dir, "train"))


def q_onehot_fitted(spark, sf_dir):
    from rekko.operators import encoding
    levels = encoding.fit(_features(spark, sf_dir, "train"))
    x = encoding.apply(_features(spark, sf_dir, "validation"), levels)
    dummies = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v"))
                        for f in levels.features])
    return (x.select("user_id", "business_id", F.explode(dummies).alias("d"))
            .filter(F.col("d.v") == 1).select("user_id", "business_id", "d.feature"))


# ------------------------------------------------------ scoring and reports

def _bias(spark, sf_dir):
    from rekko.operators.scoring import BiasScorer
    return BiasScorer.fit(_train(spark, sf_dir))


def _results(spark, sf_dir):
    """Validation rows scored in batch (clipped), with names (null if unknown)."""
    from rekko.operators.scoring import clip
    val = tables.ratings(spark, sf_dir, split="validation")
    scored = clip(_bias(spark, sf_dir).score(val.select("user_id", "business_id", "stars", "ord")))
    return (scored.join(_customer_names(spark, sf_dir), "user_id", "left")
            .join(_supplier_names(spark, sf_dir), "business_id", "left")
            .select("user_id", "business_id", F.col("prediction").alias("pred_rating"),
                    F.col("stars").alias("true_rating"), "user_name", "business_name", "ord"))


def q_batch_predictions(spark, sf_dir):
    return _results(spark, sf_dir).select("user_id", "business_id",
                                          F.col("pred_rating").alias("prediction"))


def q_rmse(spark, sf_dir):
    from rekko.operators.evaluate import rmse
    out = rmse(_results(spark, sf_dir), "pred_rating", "true_rating")
    return out.select(F.round("rmse", 9).alias("rmse"), "n")


def q_error_histogram(spark, sf_dir):
    from rekko.operators.evaluate import error_histogram
    return error_histogram(_results(spark, sf_dir), "pred_rating", "true_rating")


def q_high_error(spark, sf_dir):
    from rekko.operators.evaluate import high_errors
    return high_errors(_results(spark, sf_dir), "pred_rating", "true_rating")


def q_top_predicted(spark, sf_dir):
    from rekko.operators.reports import top_predicted
    return top_predicted(_results(spark, sf_dir))


def q_low_error_sample(spark, sf_dir):
    from rekko.operators.reports import low_error_sample
    return low_error_sample(_results(spark, sf_dir), order="ord")


def q_score_pairs(spark, sf_dir):
    from rekko.operators.scoring import score_pairs
    val = tables.ratings(spark, sf_dir, split="validation")
    return score_pairs(val, _bias(spark, sf_dir), _customer_names(spark, sf_dir),
                       _supplier_names(spark, sf_dir), truth=val)


def _places(spark, sf_dir):
    return tables.supplier_places(spark, sf_dir).select(
        F.col("s_suppkey").alias("business_id"), F.col("s_name").alias("business_name"),
        "city", "state")


def q_recommend(spark, sf_dir):
    from rekko.operators.recommend import recommend
    train = _train(spark, sf_dir)
    topk = _topk(spark, sf_dir)
    return recommend(tables.customers(spark, sf_dir), train, topk, _bias(spark, sf_dir),
                     _customer_names(spark, sf_dir), _places(spark, sf_dir), k=10, kept=_KEPT)


def q_target_on_reference(spark, sf_dir):
    from rekko.operators.recommend import target_on_reference
    cust = tables.customers(spark, sf_dir)
    requests = (cust.select(F.col("user_id").alias("target_id"))
                .join(cust.select(F.col("user_id").alias("reference_id")),
                      F.col("reference_id") == F.col("target_id") + 1))
    return target_on_reference(requests, _train(spark, sf_dir), _bias(spark, sf_dir),
                               _supplier_names(spark, sf_dir))


QUERIES.update({
    "business_features": q_business_features,
    "user_features": q_user_features,
    "feature_table": q_feature_table,
    "onehot_levels": q_onehot_levels,
    "onehot_fitted": q_onehot_fitted,
    "batch_predictions": q_batch_predictions,
    "rmse": q_rmse,
    "error_histogram": q_error_histogram,
    "high_error": q_high_error,
    "top_predicted": q_top_predicted,
    "low_error_sample": q_low_error_sample,
    "score_pairs": q_score_pairs,
    "recommend": q_recommend,
    "target_on_reference": q_target_on_reference,
})


# ------------------------------------------------------------------- model

def _learnable(spark, sf_dir, split):
    """Part ratings with a label that follows the part's size (the stars carry no signal)."""
    r = tables.ratings(spark, sf_dir, item="part", split=split)
    size = tables.table(spark, sf_dir, "part", "p_partkey", "p_size")
    label = F.least(F.lit(5.0), F.greatest(F.lit(1.0), 1 + F.col("p_size") / 10 + (F.col("stars") % 3 - 1)))
    return (r.join(size, F.col("business_id") == F.col("p_partkey"))
            .select("user_id", "business_id", label.cast("double").alias("label")))


def _keep(df):
    """The table persisted lazily; release() frees it."""
    _KEPT.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return _KEPT[-1]


def _fitted_model(spark, sf_dir, train, val, domain):
    """The rating model at the library's defaults: 300 rounds, patience 50."""
    from rekko.operators import model as gbt
    from rekko.operators.features import FeaturePipeline
    # parsed once, for the levels, the training and validation rows and the scores
    fp = FeaturePipeline(_keep(_users(spark, sf_dir)), _keep(_business(spark, sf_dir, domain))).fit(
        train.select("user_id", "business_id"))
    return gbt.train(fp.transform(train, ("label",)), fp.transform(val, ("label",)), fp.columns, "label"), fp


def q_train_predict(spark, sf_dir):
    """M6-M8: the trained model's predictions for the validation pairs, as what SQL can check:
    each pair is scored, no score is above the cap, and the model beats the training mean."""
    from rekko.operators import model as gbt
    train, val = (_keep(_learnable(spark, sf_dir, split)) for split in ("train", "validation"))
    m, fp = _fitted_model(spark, sf_dir, train, val, "part")
    pred = gbt.predict(m, fp.transform(val, ("label",)), clip=True)
    mean = train.agg(F.avg("label").alias("mean"))
    err = F.col("prediction") - F.col("label")
    # one row, so the broadcast is bounded
    beats = (pred.crossJoin(F.broadcast(mean))
             .agg((F.avg(err * err) < 0.8 * F.avg((F.col("mean") - F.col("label")) ** 2)).alias("beats_mean")))
    return pred.crossJoin(F.broadcast(beats)).select(
        "user_id", "business_id", F.col("prediction").isNotNull().alias("scored"),
        (F.col("prediction") <= 5.0).alias("within_cap"), "beats_mean")


def q_sample_items(spark, sf_dir):
    """U4: the distinct items of the first-rows sample."""
    return q_first_item_sample(spark, sf_dir).select("business_id").distinct()


def q_recommend_model(spark, sf_dir):
    """M14 with the boosted-tree scorer, as what SQL can check: for each user the number of
    recommendations, that all are candidates of the user, ranked by falling prediction."""
    from rekko.operators.recommend import top_scored
    from rekko.operators.scoring import ModelScorer
    train, val = (_keep(tables.ratings(spark, sf_dir, split=x).select("user_id", "business_id", F.col("stars").alias("label")))
                  for x in ("train", "validation"))
    m, fp = _fitted_model(spark, sf_dir, train, val, "supplier")
    ratings = _train(spark, sf_dir)
    topk = _topk(spark, sf_dir)
    users = tables.customers(spark, sf_dir)
    # the candidates are computed once, for scoring and for the check
    pool = cand.candidates(users, ratings, topk, kept=_KEPT).select("user_id", "business_id").persist(
        StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(pool)
    top = top_scored(pool, ModelScorer(m, fp), _customer_names(spark, sf_dir), _places(spark, sf_dir), k=10)
    pool = pool.select("*", F.lit(True).alias("offered"))
    rows = F.sort_array(F.collect_list(F.struct("rank", "predicted_rating")))
    return (top.join(pool, ["user_id", "business_id"], "left").groupBy("user_id")
            .agg(F.count_distinct("business_id").alias("n_items"),
                 F.every(F.coalesce("offered", F.lit(False))).alias("all_offered"), rows.alias("rows"))
            .select("user_id", "n_items", "all_offered",
                    (F.transform("rows", lambda r: r["predicted_rating"])
                     == F.sort_array(F.transform("rows", lambda r: r["predicted_rating"]), asc=False))
                    .alias("ordered")))


def q_item_rating_map(spark, sf_dir):
    """G5 in long form: item -> (user, last rating) rows."""
    return stats.dedup_last(_train(spark, sf_dir)).select("business_id", "user_id", "stars")


def q_cold_start_pool(spark, sf_dir):
    """L2 on the recommendation items: the list every user without ratings gets."""
    return stats.top_by_mean(_train(spark, sf_dir), n=300)


# ------------------------------------ rules that the plain tables never trigger

UNKNOWN = 1_000_000_000     # added to a key, it leaves the dimension tables


def _with_unknown(r):
    """Every third user and every fifth item replaced by a key no table has."""
    return (r.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.col("user_id") + UNKNOWN)
                         .otherwise(F.col("user_id")))
            .withColumn("business_id", F.when(F.col("business_id") % 5 == 0, F.col("business_id") + UNKNOWN)
                        .otherwise(F.col("business_id"))))


def q_feature_table_unknown(spark, sf_dir):
    """Features of pairs whose user or item is unknown."""
    from rekko.operators.features import feature_table
    r = _with_unknown(_train(spark, sf_dir)).select("user_id", "business_id", F.col("stars").alias("label"))
    return feature_table(r, _users(spark, sf_dir), _business(spark, sf_dir), keep=("label",))


def _with_hot_item(r):
    """Two of five ratings are of one item."""
    return r.withColumn("business_id", F.when(F.col("user_id") % 5 < 2, F.lit(1)).otherwise(F.col("business_id")))


def q_feature_table_hot(spark, sf_dir):
    """An item with 40 % of the pairs, joined with salts."""
    from rekko.operators.features import feature_table
    from rekko.operators.hot_join import SHARE
    r = _with_hot_item(_train(spark, sf_dir)).select("user_id", "business_id", F.col("stars").alias("label"))
    return feature_table(r, _users(spark, sf_dir), _business(spark, sf_dir), keep=("label",), hot_share=SHARE)


def q_part_similarity(spark, sf_dir):
    """on parts most pairs have too few co-raters and some have no variance."""
    sums = sim.co_rating_sums(_train(spark, sf_dir, "part"), min_raters=2, min_pair_count=2, kept=_KEPT)
    return sim.pair_similarity(sums, min_cousers=2).select(
        F.col("a").alias("business_id"), F.col("b").alias("other_id"), "sim", "corr", "co_users")


def q_part_candidates(spark, sf_dir):
    """On parts the pools reach their cap of 300."""
    train = _train(spark, sf_dir, "part")
    topk = sim.item_topk(train, topk=50, min_cousers=2, kept=_KEPT, with_order=True)
    return cand.warm_candidates(train, topk, per_item_k=20, max_pool=300, kept=_KEPT).select("user_id", "business_id")


def q_candidates_cold(spark, sf_dir):
    """Every tenth customer's ratings are left out of the training side."""
    train = _train(spark, sf_dir).filter(F.col("user_id") % 10 != 0)
    return cand.cold_candidates(tables.customers(spark, sf_dir), train, max_pool=300)


def _requests(spark, sf_dir):
    """Validation pairs, some with a missing user or item id."""
    val = tables.ratings(spark, sf_dir, split="validation")
    return val.select(F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
                      F.when(F.col("business_id") % 11 != 0, F.col("business_id")).alias("business_id"))


def q_score_pairs_rejects(spark, sf_dir):
    """F8: requests without a score, with the reason."""
    from rekko.operators.scoring import score_pairs_rejects
    return score_pairs_rejects(_requests(spark, sf_dir), _bias(spark, sf_dir))


def q_score_pairs_unknown(spark, sf_dir):
    """Unknown users and items have no name and no true rating."""
    from rekko.operators.scoring import score_pairs
    val = tables.ratings(spark, sf_dir, split="validation")
    return score_pairs(_with_unknown(val), _bias(spark, sf_dir), _customer_names(spark, sf_dir),
                       _supplier_names(spark, sf_dir), truth=val)


def q_onehot_single_row(spark, sf_dir):
    """M4 as the original serves single rows: every dummy is 0."""
    from rekko.operators import encoding
    levels = encoding.fit(_features(spark, sf_dir, "train"))
    x = encoding.apply(_features(spark, sf_dir, "validation"), levels, mode="single_row")
    ones = sum((F.col(f) for f in levels.features), F.lit(0))
    return x.select("user_id", "business_id", F.lit(len(levels.features)).cast("long").alias("dummies"),
                    ones.cast("long").alias("ones"))


def q_clip(spark, sf_dir):
    """P12 on ratings stretched beyond the cap."""
    from rekko.operators.scoring import clip
    r = _train(spark, sf_dir).select("user_id", "business_id", (F.col("stars") * 1.25).alias("prediction"))
    return clip(r)


# ------------------------------------------------------ files, line by line

def q_ratings_csv(spark, sf_dir):
    """Rating files with headers of several layouts, trimmed."""
    from rekko.sources import files, synth
    lines = synth.rating_lines(_train(spark, sf_dir))
    return files.parse_ratings(lines, trim=True).select("user_id", "business_id", "stars")


def q_ratings_csv_headerless(spark, sf_dir):
    """A file without a header among files with one; blanks around fields stay."""
    from rekko.sources import files, synth
    lines = synth.rating_lines(_train(spark, sf_dir), headers=False)
    return files.parse_ratings(lines, trim=False, headers="found").select("user_id", "business_id", "stars")


def q_truth_csv(spark, sf_dir):
    """The true rating of each validation pair, the last one in file order."""
    from rekko.sources import files, synth
    lines = synth.rating_lines(tables.ratings(spark, sf_dir, split="validation"))
    return stats.dedup_last(files.parse_ratings(lines)).select("user_id", "business_id", "stars")


def q_photo_json(spark, sf_dir):
    """Photos of each business from JSON lines."""
    from rekko.sources import files, synth
    found = files.parse_photos(synth.photo_json(tables.photos(spark, sf_dir)), "bigint")
    return found.groupBy("business_id").agg(F.count(F.lit(1)).alias("photos"))


QUERIES.update({
    "ratings_csv": q_ratings_csv,
    "ratings_csv_headerless": q_ratings_csv_headerless,
    "truth_csv": q_truth_csv,
    "photo_json": q_photo_json,
    "train_predict": q_train_predict,
    "item_rating_map": q_item_rating_map,
    "cold_start_pool": q_cold_start_pool,
    "sample_items": q_sample_items,
    "recommend_model": q_recommend_model,
    "feature_table_unknown": q_feature_table_unknown,
    "feature_table_hot": q_feature_table_hot,
    "part_similarity": q_part_similarity,
    "part_candidates": q_part_candidates,
    "candidates_cold": q_candidates_cold,
    "score_pairs_rejects": q_score_pairs_rejects,
    "score_pairs_unknown": q_score_pairs_unknown,
    "onehot_single_row": q_onehot_single_row,
    "clip": q_clip,
})
