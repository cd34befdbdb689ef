"""Scoring (user, business) pairs with a pluggable scorer.

Two scorers share one interface, ``score(pairs) -> pairs + prediction``:

* :class:`ModelScorer` - the boosted-tree model over the feature table;
* :class:`BiasScorer` - user mean + item mean - global mean from the
  training ratings.  It needs no model and can be written in SQL, so it is
  the scorer the oracle checks use; the original predicts with the model.

Requests are a DataFrame of pairs, not one call per pair: every pair of a
batch goes through one plan and one ``transform``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rekko.operators import model as gbt
from rekko.operators.features import FeaturePipeline
from rekko.operators.stats import global_mean, item_means, user_means
from rekko.schema import RATINGS, RatingSchema
from rekko.session import cut_lineage


def clip(df: DataFrame, col: str = "prediction", upper: float = 5.0) -> DataFrame:
    """Cap at ``upper``, no lower bound."""
    return df.withColumn(col, F.least(F.col(col), F.lit(upper)))


@dataclass
class BiasScorer:
    """prediction = g + (user mean - g) + (item mean - g); an unknown user or
    item contributes 0 for its part."""

    user_means: DataFrame
    item_means: DataFrame
    global_avg: float

    @classmethod
    def fit(cls, train: DataFrame, s: RatingSchema = RATINGS) -> "BiasScorer":
        # The global mean is one number; it is brought to the driver once.
        g = global_mean(train, s).first()["avg_rating"]
        um = user_means(train, s).select(s.user, F.col("avg_rating").alias("_um"))
        im = item_means(train, s).select(s.item, F.col("avg_rating").alias("_im"))
        return cls(um, im, float(g))

    def materialized(self) -> "BiasScorer":
        """Same scorer over checkpointed tables (static sides of a stream)."""
        return BiasScorer(cut_lineage(self.user_means), cut_lineage(self.item_means),
                          self.global_avg)

    def score(self, pairs: DataFrame, s: RatingSchema = RATINGS) -> DataFrame:
        g = F.lit(self.global_avg)
        j = pairs.join(self.user_means, s.user, "left").join(self.item_means, s.item, "left")
        pred = g + F.coalesce(F.col("_um") - g, F.lit(0.0)) + F.coalesce(F.col("_im") - g, F.lit(0.0))
        return j.withColumn("prediction", pred).drop("_um", "_im")


@dataclass
class ModelScorer:
    """The rating model over a fitted :class:`FeaturePipeline`."""

    model: gbt.TrainedModel
    features: FeaturePipeline

    def materialized(self) -> "ModelScorer":
        """Same scorer over checkpointed tables (static sides of a stream)."""
        fp = self.features
        return ModelScorer(self.model, FeaturePipeline(
            cut_lineage(fp.users), cut_lineage(fp.businesses), fp.levels, fp.mode))

    def score(self, pairs: DataFrame, s: RatingSchema = RATINGS) -> DataFrame:
        extra = tuple(c for c in pairs.columns if c not in (s.user, s.item))
        x = self.features.transform(pairs, keep=extra)
        return gbt.predict(self.model, x, clip=False).select(
            s.user, s.item, *extra, "prediction")


def display_round(df: DataFrame, cols: tuple[str, ...] = ("predicted_rating", "actual_rating"),
                  digits: int = 2) -> DataFrame:
    """Ratings rounded for display (half-up on the decimal value)."""
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def observed(scored: DataFrame, counts: Observation) -> DataFrame:
    """F8: the same rows; the pass that computes them counts ``candidates``, ``scored`` and ``rejected`` rows
    (with and without a prediction) into ``counts``."""
    failed = F.col("prediction").isNull()
    return scored.observe(counts, F.count(F.lit(1)).alias("candidates"), F.count_if(~failed).alias("scored"),
                          F.count_if(failed).alias("rejected"))


def rejected(requests: DataFrame, s: RatingSchema = RATINGS) -> DataFrame:
    """Requests that cannot be scored, with the reason: a missing user or item id."""
    no_user, no_item = F.col(s.user).isNull(), F.col(s.item).isNull()
    return (requests.filter(no_user | no_item)
            .select(s.user, s.item, F.when(no_user & no_item, "no user and item id")
                    .when(no_user, "no user id").otherwise("no item id").alias("reason")))


def score_pairs_rejects(requests: DataFrame, scorer, s: RatingSchema = RATINGS) -> DataFrame:
    """F8: requests without a score: ``(user, item, reason)``; the others are what
    :func:`score_pairs` returns, so scored and rejected rows add up to the requests."""
    whole = requests.filter(F.col(s.user).isNotNull() & F.col(s.item).isNotNull())
    failed = (scorer.score(whole.select(s.user, s.item), s).filter(F.col("prediction").isNull())
              .select(s.user, s.item, F.lit("no prediction").alias("reason")))
    return rejected(requests, s).unionByName(failed)


def score_pairs(requests: DataFrame, scorer, user_names: DataFrame, business_names: DataFrame,
                truth: DataFrame | None = None, s: RatingSchema = RATINGS,
                counts: Observation | None = None) -> DataFrame:
    """``(user_id, user_name, business_id, business_name,
    predicted_rating, actual_rating)`` for every requested pair.

    ``truth`` is ``(user, item, stars, ord)``; the actual rating is the last
    one in file order (J12), NULL when absent.  Not clipped (single-pair
    path of the original).  Requests without an id or a prediction are in
    :func:`score_pairs_rejects`; ``counts`` observes how many had a prediction.
    """
    whole = requests.filter(F.col(s.user).isNotNull() & F.col(s.item).isNotNull())
    scored = scorer.score(whole.select(s.user, s.item), s)
    if counts is not None:
        scored = observed(scored, counts)
    scored = scored.filter(F.col("prediction").isNotNull())
    out = (scored.join(user_names, s.user, "left").join(business_names, s.item, "left"))
    if truth is not None:
        last = truth.groupBy(s.user, s.item).agg(F.max_by(s.stars, s.order).alias("actual_rating"))
        out = out.join(last, [s.user, s.item], "left")
    else:
        out = out.withColumn("actual_rating", F.lit(None).cast("double"))
    return out.select(
        s.user, F.coalesce("user_name", F.lit("N/A")).alias("user_name"),
        s.item, F.coalesce("business_name", F.lit("N/A")).alias("business_name"),
        F.col("prediction").alias("predicted_rating"), "actual_rating")
