"""Column names and source schemas shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RatingSchema:
    """Names of the columns of a long-form ratings DataFrame.

    ``order`` is any orderable column giving file order (see :func:`order_key`);
    "last duplicate wins" and "first seed first" are defined by it.
    """

    user: str = "user_id"
    item: str = "business_id"
    stars: str = "stars"
    order: str = "ord"


RATINGS = RatingSchema()

# Fixed feature layout of the rating model: 19 base columns, then 3
# interaction columns; the 9 categorical ones are one-hot encoded.
BASE_FEATURES = [
    "user_avg_star", "user_review_cnt", "user_useful", "user_funny", "user_cool",
    "bus_stars", "review_count_bus", "photo_count", "operation_days",
    "price_range", "credit_card", "is_open", "validated", "noise_level",
    "delivery", "takeout", "wifi", "table_service", "wheelchair_accessible",
]
INTERACTION_FEATURES = [
    "user_bus_rating_diff", "user_bus_rating_ratio", "user_activity_ratio",
]
CATEGORICAL_FEATURES = [
    "credit_card", "is_open", "validated", "noise_level",
    "delivery", "takeout", "wifi", "table_service", "wheelchair_accessible",
]
NUMERIC_FEATURES = [c for c in BASE_FEATURES + INTERACTION_FEATURES
                    if c not in CATEGORICAL_FEATURES]

# Business attribute keys read from the ``attributes`` object (fixed values:
# note that the wifi feature is read from the TV key, as in the original).
ATTRIBUTE_KEYS = {
    "price_range": "RestaurantsPriceRange2",
    "credit_card": "BusinessAcceptsCreditCards",
    "noise_level": "NoiseLevel",
    "delivery": "RestaurantsDelivery",
    "takeout": "RestaurantsTakeOut",
    "wifi": "HasTV",
    "parking": "BusinessParking",
    "table_service": "RestaurantsTableService",
    "wheelchair_accessible": "WheelchairAccessible",
}

PHOTO_SCHEMA = T.StructType([T.StructField("business_id", T.StringType())])

RATING_CSV_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.StringType()),
])


def order_key(*fields: tuple) -> Column:
    """Fields of an order, each given with its number of digits, as one decimal of up to 38.

    One fixed-width number instead of a struct keeps "last wins" a hash
    aggregate.  A field with more digits than it was given fails the job.
    """
    if sum(digits for _, digits in fields) > 38:
        raise ValueError("an order key has at most 38 digits")
    key = F.lit(0).cast("decimal(38,0)")
    for field, digits in fields:
        value = F.col(field) if isinstance(field, str) else field
        shifted = key * F.lit(10 ** digits).cast("decimal(38,0)")
        key = (shifted + value.cast(f"decimal({digits},0)")).cast("decimal(38,0)")
    return key
