"""The whole batch job (M20): features -> model -> scores -> reports ->
metrics -> similarities -> artifacts.

Runs from JSON/CSV files (:func:`inputs_from_files`) or from the parquet
tables (:func:`inputs_from_tables`).  The driver only receives the one-hot
level table, the per-round validation errors and the final metrics; every
other step is a distributed job writing its result to ``out_dir``.

``spark-submit -m rekko.plans.train_eval <data_folder> <out_dir>`` runs it
on files.
"""

from __future__ import annotations

import os
import sys
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rekko.operators import evaluate, reports
from rekko.operators import model as gbt
from rekko.operators import similarity as sim
from rekko.operators.features import FeaturePipeline, with_photos
from rekko.operators.scoring import observed
from rekko.operators.stats import counts_with_names, global_mean, item_means, user_means
from rekko.session import cut_lineage
from rekko.sinks.writers import write_csv
from rekko.sources import artifacts, files, tables


@dataclass
class Inputs:
    train: DataFrame        # (user_id, business_id, stars, ord)
    validation: DataFrame   # (user_id, business_id, stars, ord)
    users: DataFrame        # user_id, name, 5 user features
    businesses: DataFrame   # business_id, name, city, state, business features


def inputs_from_files(spark: SparkSession, paths: files.Paths) -> Inputs:
    biz = with_photos(files.read_business(spark, paths.resolve("business")),
                      files.read_photos(spark, paths.resolve("photo")))
    return Inputs(
        train=files.read_ratings_csv(spark, paths.resolve("train"), trim=True),
        validation=files.read_ratings_csv(spark, paths.resolve("validation"), trim=False),
        users=files.read_users(spark, paths.resolve("user")),
        businesses=biz)


def inputs_from_tables(spark: SparkSession, sf_dir: str) -> Inputs:
    """Parquet tables with the role mapping of :mod:`rekko.sources.tables`."""
    from rekko.plans.catalog import _business, _users
    return Inputs(
        train=tables.ratings(spark, sf_dir, split="train"),
        validation=tables.ratings(spark, sf_dir, split="validation"),
        users=_users(spark, sf_dir),
        businesses=_business(spark, sf_dir, "supplier"))


def run(spark: SparkSession, inputs: Inputs, out_dir: str, train_model: bool = True,
        model_params: dict | None = None, patience: int | None = gbt.EARLY_STOPPING_ROUNDS,
        topk: int = 50, min_cousers: int = 20, model_dir: str | None = None) -> dict:
    """Run every step; ``model_dir`` defaults to ``$MODEL_PATH`` or
    ``{out_dir}/model`` (S10)."""
    t0 = time.time()
    phase = {}
    model_dir = model_dir or os.environ.get("MODEL_PATH") or os.path.join(out_dir, "model")
    art_dir = os.path.join(out_dir, "artifacts")

    # The training ratings feed features, statistics, similarities and
    # artifacts: read and parse them once (spilling to disk).
    kept = [inputs.train.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        return _run(spark, Inputs(kept[0], inputs.validation, inputs.users, inputs.businesses), out_dir, kept,
                    phase, t0, model_dir, art_dir, train_model, model_params, patience, topk, min_cousers)
    finally:
        for df in kept:
            df.unpersist()


def _run(spark, inputs, out_dir, kept, phase, t0, model_dir, art_dir, train_model, model_params, patience,
         topk, min_cousers) -> dict:
    """The steps; what they persist goes to ``kept``."""

    # 1) features (M1, M2) and one-hot layout (M3, M4) as one pipeline (M5)
    tr = inputs.train.select("user_id", "business_id", F.col("stars").alias("label"))
    va = inputs.validation.select("user_id", "business_id", F.col("stars").alias("label"), "ord")
    fp = FeaturePipeline(inputs.users, inputs.businesses).fit(tr.select("user_id", "business_id"))
    levels = fp.levels
    x_train = fp.transform(tr, ("label",))
    # Read by the error curve and by scoring: keep it (spill to disk).
    x_val = fp.transform(va, ("label", "ord")).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(x_val)
    phase["features"] = time.time() - t0

    # 2) model (M6, M7) or a saved one
    t1 = time.time()
    if train_model:
        model = gbt.train(x_train, x_val, fp.columns, "label", model_params, patience)
        gbt.save(model, model_dir)
    else:
        model = gbt.load(model_dir)
        if model is None:
            raise FileNotFoundError(f"no saved model at {model_dir}")
    phase["train"] = time.time() - t1

    # 3) batch predictions, clipped (M8, K1); cut lineage before reuse
    t2 = time.time()
    counts = Observation("scores")
    pred = cut_lineage(observed(gbt.predict(model, x_val, clip=True), counts))
    write_csv(pred.select("user_id", "business_id", "prediction"),
              os.path.join(out_dir, "predictions"), order_by=["ord"])
    names_u = inputs.users.select("user_id", F.col("name").alias("user_name"))
    names_b = inputs.businesses.select("business_id", F.col("name").alias("business_name"))
    results = (pred.join(names_u, "user_id", "left").join(names_b, "business_id", "left")
               .select("user_id", "business_id", F.col("prediction").alias("pred_rating"),
                       F.col("label").alias("true_rating"), "user_name", "business_name", "ord"))
    write_csv(reports.top_predicted(results), os.path.join(out_dir, "top_predicted_10"),
              order_by=[F.desc("pred_rating"), "user_id", "business_id"])
    low = reports.low_error_sample(results, order="ord")
    # the report keeps the 8 columns of the original file, in interval order
    write_csv(low.orderBy("interval_pos", "rank_in_interval")
              .select(*reports.RESULT_COLUMNS, "error", "interval"),
              os.path.join(out_dir, "low_error_demo"))
    phase["predict"] = time.time() - t2

    # 4) evaluation (M9): a handful of numbers come back to the driver
    g = global_mean(inputs.train).first()["avg_rating"]
    hist = {r["bucket"]: int(r["count"]) for r in
            evaluate.error_histogram(results, "pred_rating", "true_rating").collect()}
    write_csv(evaluate.high_errors(results, "pred_rating", "true_rating"),
              os.path.join(out_dir, "high_error_cases"), order_by=[F.desc("error"), "user_id", "business_id"])
    # RMSE, the constant-mean RMSE and the high-error count in one pass
    scored = results.filter(F.col("true_rating").isNotNull() & F.col("pred_rating").isNotNull())
    err = F.col("pred_rating") - F.col("true_rating")
    unread = inputs.train.filter(F.col("stars").isNull()).count()
    m = scored.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"),
                   F.sqrt(F.avg((F.lit(g) - F.col("true_rating")) ** 2)).alias("baseline"),
                   F.count_if(F.abs(err) >= 3.0).alias("n_high")).first()
    baseline, n_high = m["baseline"], m["n_high"]

    # 5) similarities and artifacts
    t3 = time.time()
    topk_df = cut_lineage(sim.item_topk(inputs.train, topk=topk, min_cousers=min_cousers, kept=kept))
    artifacts.save(spark, art_dir, {
        "ratings": inputs.train,
        "item_stats": item_means(inputs.train),
        "user_stats": user_means(inputs.train),
        "global_stats": global_mean(inputs.train),
        "business_dim": inputs.businesses.select("business_id", "name", "city", "state"),
        "user_dim": inputs.users.select("user_id", "name"),
        "item_topk": topk_df,
        "onehot_levels": levels.to_frame(spark),
    }, model)
    phase["similarity"] = time.time() - t3

    # 6) most active users / most rated businesses (K6)
    write_csv(counts_with_names(inputs.train, "user_id", inputs.users, "name"),
              os.path.join(out_dir, "top5_users"), order_by=[F.desc("rating_count"), "user_id"])
    write_csv(counts_with_names(inputs.train, "business_id", inputs.businesses, "name"),
              os.path.join(out_dir, "top5_businesses"),
              order_by=[F.desc("rating_count"), "business_id"])
    return {"rmse": m["rmse"], "n_validation": m["n"], "constant_mean_rmse": baseline,
            "error_distribution": hist, "high_error_cases": n_high,
            "scores": counts.get, "ratings_without_stars": unread, "rounds": model.rounds, "phase_seconds": phase, "runtime": time.time() - t0}


def main(argv: list[str]) -> None:
    from rekko.session import get_spark
    data_folder = argv[1] if len(argv) > 1 else os.environ.get("DATA_FOLDER", "data")
    out_dir = argv[2] if len(argv) > 2 else "output"
    spark = get_spark()
    metrics = run(spark, inputs_from_files(spark, files.Paths(data_folder)), out_dir)
    print(f"RMSE: {metrics['rmse']:.6f}  runtime: {metrics['runtime']:.2f}s")


if __name__ == "__main__":
    main(sys.argv)
