"""End-to-end batch job on JSON/CSV files, artifacts round trip, streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from datapaths import SF001
from rekko.operators import model as gbt
from rekko.operators.scoring import BiasScorer
from rekko.plans import train_eval
from rekko.sources import artifacts, files, synth, tables
from rekko.streaming import scoring as stream


@pytest.fixture(scope="module")
def data_folder(spark, tmp_path_factory):
    """Write the sf0.001 tables out as the original's file layout."""
    d = tmp_path_factory.mktemp("data")
    places = tables.supplier_places(spark, SF001)
    biz = synth.business_json(places, "s_suppkey", "s_nationkey", "s_name", "city", "state")
    cust = tables.table(spark, SF001, "customer", "c_custkey", "c_name", "c_nationkey",
                        "c_acctbal", "c_mktsegment")
    for name, df in (("business.json", biz), ("user.json", synth.user_json(cust))):
        lines = [r["value"] for r in df.collect()]
        (d / name).write_text("\n".join(lines) + "\n")
    photos = [json.dumps({"business_id": str(r["business_id"]), "photo_id": i})
              for i, r in enumerate(tables.photos(spark, SF001).collect())]
    (d / "photo.json").write_text("\n".join(photos) + "\n")
    for split, fname in (("train", "train.csv"), ("validation", "validation.csv")):
        rows = tables.ratings(spark, SF001, split=split).orderBy("ord").collect()
        text = ["user_id,business_id,stars"] + [
            f"{r['user_id']},{r['business_id']},{r['stars']}" for r in rows]
        (d / fname).write_text("\n".join(text) + "\n")
    return str(d)


def test_batch_job_on_files(spark, data_folder, tmp_path):
    out = str(tmp_path / "out")
    inputs = train_eval.inputs_from_files(spark, files.Paths(data_folder))
    m = train_eval.run(spark, inputs, out, model_params={"maxIter": 3, "maxDepth": 3},
                       patience=2, min_cousers=5)
    assert m["n_validation"] > 0 and m["rmse"] > 0
    assert m["scores"] == {"candidates": m["n_validation"], "scored": m["n_validation"], "rejected": 0}
    assert m["ratings_without_stars"] == 0
    # nothing stays in executor storage
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    high = spark.read.option("header", True).csv(os.path.join(out, "high_error_cases"))
    assert high.count() == m["high_error_cases"]
    assert sum(m["error_distribution"].values()) == m["n_validation"]
    preds = spark.read.option("header", True).csv(os.path.join(out, "predictions"))
    assert preds.count() == m["n_validation"]
    assert preds.agg(F.max(F.col("prediction").cast("double"))).first()[0] <= 5.0
    top = spark.read.option("header", True).csv(os.path.join(out, "top_predicted_10"))
    assert top.columns == ["user_id", "business_id", "pred_rating", "true_rating",
                           "user_name", "business_name"] and top.count() == 10
    low = spark.read.option("header", True).csv(os.path.join(out, "low_error_demo"))
    assert low.columns == ["user_id", "business_id", "pred_rating", "true_rating",
                           "user_name", "business_name", "error", "interval"]
    top5 = spark.read.option("header", True).csv(os.path.join(out, "top5_users"))
    assert top5.columns == ["user_id", "rating_count", "name"] and top5.count() == 5
    counts = [int(r["rating_count"]) for r in top5.collect()]
    assert counts == sorted(counts, reverse=True)
    assert spark.read.option("header", True).csv(
        os.path.join(out, "top5_businesses")).count() == 5
    art = os.path.join(out, "artifacts")
    tk = artifacts.load(spark, art, "item_topk")
    assert tk is not None and tk.count() > 0
    assert artifacts.load(spark, str(tmp_path / "nope"), "item_topk") is None
    from rekko.operators.recommend import recommend_from_artifacts
    train = files.read_ratings_csv(spark, os.path.join(data_folder, "train.csv"))
    users = train.select("user_id").distinct()
    recs = recommend_from_artifacts(spark, art, users, BiasScorer.fit(train), k=3)
    assert recs is not None and recs.count() > 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 3
    assert recommend_from_artifacts(spark, str(tmp_path / "nope"), users,
                                    BiasScorer.fit(train)) is None
    model = gbt.load(os.path.join(out, "model"))
    assert model is not None and model.feature_columns
    assert artifacts.open_version(spark, art).load_model().rounds == model.rounds
    # loaded model scores the same rows
    m2 = train_eval.run(spark, inputs, out, train_model=False, min_cousers=5)
    assert m2["rmse"] == pytest.approx(m["rmse"])


def test_a_job_killed_between_two_tables_leaves_the_old_version(spark, tmp_path):
    art = str(tmp_path / "art")
    assert artifacts.open_version(spark, art) is None
    old = {"item_stats": spark.range(3).withColumnRenamed("id", "n"), "user_stats": spark.range(4)}
    artifacts.save(spark, art, old)
    reader = artifacts.open_version(spark, art)
    broken = spark.range(5).selectExpr("CASE WHEN id < 9 THEN raise_error('killed') END AS id")
    with pytest.raises(Exception, match="killed"):
        artifacts.save(spark, art, {"item_stats": spark.range(7), "user_stats": broken})
    assert artifacts.open_version(spark, art) == reader
    assert artifacts.load(spark, art, "item_stats").count() == 3
    new = artifacts.save(spark, art, {"item_stats": spark.range(8)})
    assert new.name > reader.name and artifacts.load(spark, art, "item_stats").count() == 8
    # a reader stays on the version it opened; a table the new one lacks is not taken from the old one
    assert reader.load("item_stats").count() == 3 and reader.load("user_stats").count() == 4
    assert artifacts.load(spark, art, "user_stats") is None and reader.load_model() is None
    with pytest.raises(ValueError):
        reader.load("other")


def test_streaming_scoring(spark, data_folder, tmp_path):
    train = files.read_ratings_csv(spark, os.path.join(data_folder, "train.csv"))
    val = files.read_ratings_csv(spark, os.path.join(data_folder, "validation.csv"), trim=False)
    users = files.read_users(spark, os.path.join(data_folder, "user.json"))
    biz = files.read_business(spark, os.path.join(data_folder, "business.json"))
    req_dir = tmp_path / "requests"
    req_dir.mkdir()
    pairs = [(r["user_id"], r["business_id"]) for r in val.limit(20).collect()]
    (req_dir / "batch1.csv").write_text(
        "user_id,business_id\n" + "\n".join(f"{u},{b}" for u, b in pairs) + "\nghost,nowhere\n")
    q = stream.start(
        stream.scored_stream(stream.request_stream(spark, str(req_dir)), BiasScorer.fit(train),
                             users.select("user_id", F.col("name").alias("user_name")),
                             biz.select("business_id", F.col("name").alias("business_name")),
                             truth=val),
        checkpoint=str(tmp_path / "ckpt"), sink="memory", name="scored_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.sql("SELECT * FROM scored_test").collect()
    assert len(rows) == 21
    ghost = [r for r in rows if r["user_id"] == "ghost"][0]
    assert ghost["user_name"] == "N/A" and ghost["actual_rating"] is None
    assert all(r["predicted_rating"] is not None for r in rows)
    assert sum(r["actual_rating"] is not None for r in rows) == 20


def test_streaming_with_model_scorer(spark, data_folder, tmp_path):
    from rekko.operators.features import FeaturePipeline, with_photos
    from rekko.operators.scoring import ModelScorer
    train = files.read_ratings_csv(spark, os.path.join(data_folder, "train.csv"))
    users = files.read_users(spark, os.path.join(data_folder, "user.json"))
    biz = with_photos(files.read_business(spark, os.path.join(data_folder, "business.json")),
                      files.read_photos(spark, os.path.join(data_folder, "photo.json")))
    pairs = train.select("user_id", "business_id", F.col("stars").alias("label"))
    fp = FeaturePipeline(users, biz).fit(pairs.select("user_id", "business_id"))
    model = gbt.train(fp.transform(pairs, ("label",)), None, fp.columns, "label",
                      {"maxIter": 2, "maxDepth": 3})
    scorer = ModelScorer(model, fp)
    batch = scorer.score(train.select("user_id", "business_id").limit(5)).collect()
    req_dir = tmp_path / "req"
    req_dir.mkdir()
    (req_dir / "a.csv").write_text("user_id,business_id\n" + "\n".join(
        f"{r['user_id']},{r['business_id']}" for r in batch) + "\n")
    q = stream.start(stream.scored_stream(
        stream.request_stream(spark, str(req_dir)), scorer,
        users.select("user_id", F.col("name").alias("user_name")),
        biz.select("business_id", F.col("name").alias("business_name"))),
        checkpoint=str(tmp_path / "ck"), sink="memory", name="scored_model")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r["user_id"], r["business_id"]): r["predicted_rating"]
           for r in spark.sql("SELECT * FROM scored_model").collect()}
    want = {(r["user_id"], r["business_id"]): r["prediction"] for r in batch}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)
