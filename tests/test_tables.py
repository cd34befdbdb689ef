"""The TPC-H-style adapter: ratings, split, places, photos."""

from pyspark.sql import functions as F

from datapaths import SF001
from rekko.operators import stats
from rekko.sources import tables


def test_split_partitions_all_ratings(spark):
    all_ = tables.ratings(spark, SF001, split="all")
    tr = tables.ratings(spark, SF001, split="train")
    va = tables.ratings(spark, SF001, split="validation")
    n_all, n_tr, n_va = all_.count(), tr.count(), va.count()
    assert n_tr + n_va == n_all and n_tr > 0 and n_va > 0
    assert tr.join(va, ["ord"]).count() == 0
    assert all_.agg(F.min("stars"), F.max("stars")).first() == (1.0, 5.0)
    assert all_.select("ord").distinct().count() == n_all      # file order is a total order


def test_places_and_photos(spark):
    places = tables.supplier_places(spark, SF001)
    sup = tables.table(spark, SF001, "supplier", "s_suppkey")
    assert places.count() == sup.count()
    assert places.filter(F.col("city").isNull() | F.col("state").isNull()).count() == 0
    photos = tables.photos(spark, SF001)
    assert photos.count() == tables.table(spark, SF001, "events", "event_id").count()


def test_first_rows_sample_uses_file_order(spark):
    va = tables.ratings(spark, SF001, split="validation")
    sample = stats.first_per_user(va, n=10).collect()
    first10 = va.orderBy("ord").limit(10).collect()
    want = {}
    for r in first10:
        want.setdefault(r["user_id"], r["business_id"])
    assert {r["user_id"]: r["business_id"] for r in sample} == want
