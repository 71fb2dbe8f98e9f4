"""Schemas of the raw files. Every raw column is read as text and typed by the cleaners."""

from __future__ import annotations

from pyspark.sql import types as T


def texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the input files.
BEHAVIOR = ("user_id", "item_id", "category_id", "behavior_type", "timestamp")
LISTINGS = (
    "id", "host_id", "host_name", "host_is_superhost", "host_listings_count",
    "neighbourhood_cleansed", "latitude", "longitude", "property_type", "room_type",
    "accommodates", "bedrooms", "beds", "price", "minimum_nights", "number_of_reviews",
    "number_of_reviews_ltm", "review_scores_rating", "availability_365",
    "estimated_revenue_l365d", "first_review", "last_review", "instant_bookable",
)
LISTING_REVIEWS = ("listing_id", "id", "date", "comments")
REVIEWS = (
    "business_id", "business_name", "Date", "Rating", "Content", "Eelite_status", "Reactions",
)
COMMENTS = ("comment_id", "comment_body")

RAW = {
    "behavior": BEHAVIOR,
    "listings": LISTINGS,
    "listing_reviews": LISTING_REVIEWS,
    "reviews": REVIEWS,
    "comments": COMMENTS,
}

# Cleaned tables whose folders alone would not tell the type of every column:
# the date of an event is text, though its folders look like dates.
CLEANED = {
    "behavior": "user_id LONG, item_id LONG, category_id LONG, behavior_type STRING, "
    "datetime TIMESTAMP_NTZ, date STRING, hour INT, weekday INT",
}
