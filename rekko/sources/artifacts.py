"""Collaborative-filtering artifacts in long form (K4 and K5 write, S8 and S9 read).

Tables of one version lie in one folder, ``v-<number>-<unique part>``:

* ``ratings``       (user, item, stars, ord)      - lists / maps are views of it
* ``item_stats``    (item, avg_rating, n_ratings)
* ``user_stats``    (user, avg_rating, n_ratings)
* ``global_stats``  (avg_rating, n_ratings)
* ``business_dim``  (business_id, name, city, state)
* ``user_dim``      (user_id, name)
* ``item_topk``     (item, other_id, sim, corr, co_users, rank), sorted by item
  within files, so readers can prune row groups
* ``onehot_levels`` (column, level, position, feature)
* ``model``         the saved rating model

A version is published by one more row in the table ``versions``, after all its tables are
written: one file appended by one committed job.  Until then readers do not see it, so a
writer that dies halfway leaves them on the version before.  A reader opens the newest version once
(:func:`open_version`) and reads everything from there, whatever is published meanwhile.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekko.sinks.writers import write_table

NAMES = ("ratings", "item_stats", "user_stats", "global_stats", "business_dim",
         "user_dim", "item_topk", "onehot_levels")


VERSIONS = "version string, tables array<string>"


@dataclass(frozen=True)
class Version:
    """One version of the artifacts, open for reading or (before it is published) for writing."""

    spark: SparkSession
    art_dir: str
    name: str
    tables: tuple[str, ...] = ()

    def path(self, name: str) -> str:
        return os.path.join(self.art_dir, self.name, name)

    def load(self, name: str) -> DataFrame | None:
        """One table, or None when this version has none of that name (the
        feature that needs it is then unavailable)."""
        if name not in NAMES:
            raise ValueError(f"unknown artifact table: {name}")
        return self.spark.read.parquet(self.path(name)) if name in self.tables else None

    def load_model(self):
        """The rating model of this version, or None."""
        from rekko.operators import model
        return model.load(self.path("model")) if "model" in self.tables else None


def open_version(spark: SparkSession, art_dir: str) -> Version | None:
    """The newest published version, or None when there is none."""
    path = os.path.join(art_dir, "versions")
    if not exists(spark, path):
        return None
    newest = spark.read.schema(VERSIONS).parquet(path).orderBy(F.desc("version")).limit(1).collect()
    return Version(spark, art_dir, newest[0]["version"], tuple(newest[0]["tables"])) if newest else None


def save(spark: SparkSession, art_dir: str, tables: dict[str, DataFrame], model=None) -> Version:
    """Write a new version with these tables (and the model), and publish it when all are there."""
    unknown = set(tables) - set(NAMES)
    if unknown:
        raise ValueError(f"unknown artifact tables: {sorted(unknown)}")
    before = open_version(spark, art_dir)
    number = int(before.name.split("-")[1]) + 1 if before else 1
    new = Version(spark, art_dir, f"v-{number:08d}-{uuid.uuid4().hex}", (*tables, *(["model"] if model else [])))
    for name, df in tables.items():
        if name == "item_topk":
            df = df.sortWithinPartitions(df.columns[0])
        write_table(df, new.path(name))
    if model is not None:
        from rekko.operators.model import save as save_model
        save_model(model, new.path("model"))
    (spark.createDataFrame([(new.name, list(new.tables))], VERSIONS).coalesce(1)
     .write.mode("append").parquet(os.path.join(art_dir, "versions")))
    return new


def load(spark: SparkSession, art_dir: str, name: str) -> DataFrame | None:
    """One table of the newest version; to read several, open a version and load them from it."""
    if name not in NAMES:
        raise ValueError(f"unknown artifact table: {name}")
    version = open_version(spark, art_dir)
    return version.load(name) if version else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other trouble with it is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def user_items(ratings: DataFrame) -> DataFrame:
    """View of ``ratings``: the items of each user, in order, one row for each (user, item)."""
    return ratings.groupBy("user_id", "business_id").agg(F.min("ord").alias("first_ord"))


def item_users(ratings: DataFrame) -> DataFrame:
    """View of ``ratings``: the users of each item, one row for each."""
    return ratings.select("business_id", "user_id").distinct()


def item_ratings(ratings: DataFrame) -> DataFrame:
    """View of ``ratings``: the last rating of each user of an item."""
    return ratings.groupBy("business_id", "user_id").agg(F.max_by("stars", "ord").alias("stars"))
