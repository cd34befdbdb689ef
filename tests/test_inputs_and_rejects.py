"""Files by header, file order over several files, rejects, level bound, artifact views, order key."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from datapaths import SF001
from rekko.operators import encoding, stats
from rekko.operators.scoring import BiasScorer, rejected, score_pairs, score_pairs_rejects
from rekko.schema import order_key
from rekko.sources import artifacts, files, tables


def test_header_names_decide_the_columns(spark, write_lines):
    path = write_lines("t.csv", ["stars,business_id,user_id,note", "4.0,b1,u1,x", "stars,business_id,user_id,note",
                                 "bad,b2,u2,y"])
    rows = files.read_ratings_csv(spark, path).orderBy("ord").collect()
    assert [(r["user_id"], r["business_id"], r["stars"]) for r in rows] == [("u1", "b1", 4.0), ("u2", "b2", None)]


def test_other_header_is_read_by_position(spark, write_lines):
    path = write_lines("t.csv", ["user,item,rating", "u1,b1,3", "user,item,rating", "u2,b2,5"])
    rows = files.read_ratings_csv(spark, path).orderBy("ord").collect()
    assert [(r["user_id"], r["business_id"], r["stars"]) for r in rows] == [("u1", "b1", 3.0), ("u2", "b2", 5.0)]


def test_file_order_over_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(5):
        (folder / f"part {i}.csv").write_text(
            "user_id,business_id,stars\n" + "".join(f"u{i},b{j},{j % 5 + 1}\n" for j in range(20)))
    rows = files.read_ratings_csv(spark, str(folder)).orderBy("ord").collect()
    assert [(r["user_id"], r["business_id"]) for r in rows] == [(f"u{i}", f"b{j}") for i in range(5) for j in range(20)]
    assert dict(files.read_ratings_csv(spark, str(folder)).dtypes)["ord"] == "decimal(38,0)"


def test_order_key_sorts_like_its_fields(spark):
    df = spark.createDataFrame([(2, 0), (1, 99), (1, 5), (10, 1)], "a long, b long")
    rows = df.withColumn("ord", order_key(("a", 12), (F.col("b"), 2))).orderBy("ord").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, 5), (1, 99), (2, 0), (10, 1)]
    with pytest.raises(ValueError):
        order_key(("a", 30), ("b", 9))
    with pytest.raises(Exception):
        df.select(order_key(("a", 12), ("b", 1))).collect()


def test_last_wins_is_a_hash_aggregate(spark):
    plan = stats.dedup_last(tables.ratings(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_scored_and_rejected_rows_add_up(spark):
    train = tables.ratings(spark, SF001, split="train")
    scorer = BiasScorer.fit(train)
    requests = train.select("user_id", "business_id").limit(50).unionByName(spark.createDataFrame(
        [(None, 1), (1, None), (None, None), (10 ** 9, 10 ** 9)], "user_id long, business_id long"))
    names = spark.createDataFrame([], "user_id long, user_name string")
    items = spark.createDataFrame([], "business_id long, business_name string")
    scored = score_pairs(requests, scorer, names, items)
    rejects = score_pairs_rejects(requests, scorer)
    assert scored.count() + rejects.count() == requests.count() and rejects.count() == 3
    assert {r["reason"] for r in rejected(requests).collect()} == {"no user id", "no item id", "no user and item id"}


class NoScoreForOdd:
    """A scorer that fails for odd items."""

    def score(self, pairs, s=None):
        return pairs.withColumn("prediction", F.when(F.col("business_id") % 2 == 0, F.lit(3.0)))


def test_failed_scores_are_counted_in_the_same_pass(spark):
    from rekko.operators import candidates, recommend
    train = tables.ratings(spark, SF001, item="part")
    topk = train.select("business_id").distinct().select(
        "business_id", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("rank")).withColumn(
        "other_id", F.pmod(F.col("business_id") * 7 + F.col("rank"), F.lit(200)))
    users = train.select("user_id").distinct()
    names = spark.createDataFrame([], "user_id long, user_name string")
    places = spark.createDataFrame([], "business_id long, business_name string, city string, state string")
    counts = Observation("scores")
    top = recommend.recommend(users, train, topk, NoScoreForOdd(), names, places, k=3, counts=counts)
    assert {r["business_id"] % 2 for r in top.collect()} == {0}
    pool = candidates.candidates(users, train, topk).collect()
    odd = sum(r["business_id"] % 2 for r in pool)
    assert counts.get == {"candidates": len(pool), "scored": len(pool) - odd, "rejected": odd} and odd
    requests = train.select("user_id", "business_id")
    reasons = score_pairs_rejects(requests, NoScoreForOdd()).groupBy("reason").count().collect()
    assert [r["reason"] for r in reasons] == ["no prediction"]
    counts = Observation("requests")
    items = spark.createDataFrame([], "business_id long, business_name string")
    n = len(score_pairs(requests, NoScoreForOdd(), names, items, counts=counts).collect())
    assert counts.get == {"candidates": requests.count(), "scored": n, "rejected": reasons[0]["count"]}


def test_each_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("stars,user_id,business_id\n4,u1,b1\n")
    (folder / "b.csv").write_text("user_id,business_id,stars\nu2,b2,5\n\nuser_id,business_id,stars\nu3,,x\n")
    (folder / "c.csv").write_text("u4,b4,1\nu5,b5\n")
    got = files.read_pairs_with_fallback(spark, str(folder)).orderBy("ord").collect()
    assert [tuple(r)[:3] for r in got] == [("u1", "b1", 4.0), ("u2", "b2", 5.0), ("u3", None, None),
                                           ("u4", "b4", 1.0), ("u5", "b5", None)]
    first = files.read_ratings_csv(spark, str(folder)).orderBy("ord").collect()
    assert [r["user_id"] for r in first] == ["u1", "u2", "u3", "u5"]
    with pytest.raises(ValueError):
        files.parse_ratings(spark.createDataFrame([], "value string, file string, ord long"), headers="no")


def test_level_bound_holds_in_both_forms(spark):
    from rekko.schema import CATEGORICAL_FEATURES
    df = spark.range(20).select(*[F.col("id").cast("string").alias(c) for c in CATEGORICAL_FEATURES])
    with pytest.raises(ValueError, match="categorical levels"):
        encoding.fit(df, max_levels=50)
    with pytest.raises(Exception, match="categorical levels"):
        encoding.level_frame(df, max_levels=50).collect()


def test_artifact_views(spark):
    r = spark.createDataFrame([("u", "a", 1.0, 3), ("u", "a", 5.0, 7), ("u", "b", 2.0, 1), ("v", "a", 4.0, 2)],
                              "user_id string, business_id string, stars double, ord long")
    assert [x["business_id"] for x in artifacts.user_items(r).filter("user_id = 'u'").orderBy("first_ord").collect()] \
        == ["b", "a"]
    assert {tuple(x) for x in artifacts.item_users(r).collect()} == {("a", "u"), ("b", "u"), ("a", "v")}
    assert {tuple(x) for x in artifacts.item_ratings(r).collect()} == {("a", "u", 5.0), ("b", "u", 2.0), ("a", "v", 4.0)}


def test_reading_json_leaves_the_session_as_it_was(spark):
    from rekko.functions.business import business_frame
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key, None)
    df = business_frame(spark.createDataFrame([('{"business_id": "x", "stars": 1.0, "stars": 2.0, "review_count": 1, '
                                                '"is_open": 1}',)], "value string"))
    assert spark.conf.get(key, None) == before
    assert df.first()["bus_stars"] == 2.0


def test_repeated_keys_and_odd_attributes(spark):
    from rekko.functions.business import business_frame
    rows = ['{"business_id": "x", "hours": {"Mon": "9", "Mon": "8", "Tue": "9"}, "attributes": {"HasTV": "a", "HasTV": "b"}}',
            '{"business_id": "y", "attributes": "text", "hours": null, "stars": 3.5}',
            '{"business_id": 7, "attributes": [1], "name": "hours"}', 'no json']
    got = business_frame(spark.createDataFrame([(r,) for r in rows], "value string")).select(
        "business_id", "operation_days", "wifi", "bus_stars", "name").collect()
    assert [tuple(r) for r in got] == [("x", 2, "b", None, ""), ("y", 7, None, 3.5, ""), ("7", 7, None, None, "hours"),
                                       (None, 7, None, None, "")]
