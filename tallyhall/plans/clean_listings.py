"""Rental listings and their reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhall.functions.numbers import cut_right, to_double, to_long
from tallyhall.operators.ranking import exact_quantiles

# Host sizes, right-closed from 0.
HOST_SCALES = ((2, "个人(1-2)"), (10, "小型(3-10)"), (50, "专业(11-50)"), (10**6, "机构(50+)"))
CAP_QUANTILE = 0.99
# Whole texts are replaced byte by byte; translate() would look up every character.
PRICE_DIGITS = "replace(replace(price, '$', ''), ',', '')"

_LONGS = (
    "id", "host_id", "accommodates", "minimum_nights", "number_of_reviews",
    "number_of_reviews_ltm", "availability_365",
)
_DOUBLES = (
    "latitude", "longitude", "bedrooms", "beds", "review_scores_rating", "estimated_revenue_l365d",
    "host_listings_count",
)
_DATES = ("first_review", "last_review")
_REQUIRED = ("neighbourhood_cleansed", "room_type", "host_id")


def typed_listings(raw: DataFrame) -> DataFrame:
    """Every listing with its columns typed; '$1,234.00' becomes 1234.0."""
    typed = {c: to_long(c) for c in _LONGS}
    typed |= {c: to_double(c) for c in _DOUBLES}
    typed |= {c: F.expr(f"try_cast({c} AS date)") for c in _DATES}
    return raw.withColumns(typed | {"price": to_double(PRICE_DIGITS)})


def price_cap(raw: DataFrame) -> DataFrame:
    """One row: the 99th percentile of price over all priced listings.

    What is exploded is computed once a row, not again by the filter and by each use of the number.
    """
    digits = raw.select(F.explode(F.array(F.expr(PRICE_DIGITS))).alias("digits"))
    prices = digits.select(F.explode(F.array(to_double("digits"))).alias("price")).where("price > 0")
    return exact_quantiles(prices, "price", {"price_p99": CAP_QUANTILE})


def clean_listings(raw: DataFrame, cap: DataFrame | None = None) -> DataFrame:
    """Priced listings with capped price, occupancy and host size.

    The cap is taken before incomplete rows go. It joins as a scalar subquery,
    which vanishes from plans that do not use price_winsor. `cap` is price_cap(raw), if it is known already.
    """
    cap = price_cap(raw) if cap is None else cap
    priced = typed_listings(raw).where("price > 0")
    capped = priced.withColumn(
        "price_winsor", F.least(F.col("price"), cap.scalar())
    )
    return (
        capped.dropna(subset=list(_REQUIRED))
        .withColumn(
            "occupancy_ratio", F.round(F.lit(1) - F.col("availability_365") / F.lit(365), 4)
        )
        .withColumn("host_listings_count", F.coalesce("host_listings_count", F.lit(1.0)))
        .withColumn("host_scale", cut_right(F.col("host_listings_count"), 0, HOST_SCALES))
    )


def commented(raw: DataFrame) -> DataFrame:
    """Listing reviews that hold a comment."""
    said = (F.length("comments") > 0) & ~F.col("comments").isin("nan", "None")
    return raw.where(said)


def clean_listing_reviews(raw: DataFrame, with_text: bool = True) -> DataFrame:
    """One review per id, with its length; rows without a readable date go.

    Among copies of an id the smallest (listing, date, length, comment) stays.
    Leaving the comment out does not change which listing, date and length that
    is, so questions that need no text do not shuffle any.
    """
    fields = ["listing_id", "date", "review_len"] + (["comments"] if with_text else [])
    typed = commented(raw).select(
        to_long("id").alias("id"),
        F.struct(
            to_long("listing_id").alias("listing_id"),
            F.col("date").try_cast("date").alias("date"),
            F.length("comments").alias("review_len"),
            *([F.col("comments")] if with_text else []),
        ).alias("r"),
    )
    kept = typed.groupBy("id").agg(F.min("r").alias("r"))
    order = ["listing_id", "id", "date", *[f for f in ("comments", "review_len") if f in fields]]
    return kept.select("id", "r.*").dropna(subset=["date"]).select(*order)


def listings_summary(listings: DataFrame, reviews: DataFrame, cap: DataFrame) -> DataFrame:
    """One row over both cleaned tables and the price cap; each part is a scalar of its own."""
    parts = reviews.agg(F.struct(F.count("*").alias("n"), F.max("date").alias("latest")).alias("r"))
    return listings.agg(
        F.count("*").alias("listings"),
        F.countDistinct("neighbourhood_cleansed").alias("neighbourhoods"),
    ).select(
        "listings",
        parts.scalar()["n"].alias("reviews"),
        cap.scalar().alias("price_p99"),
        "neighbourhoods",
        parts.scalar()["latest"].cast("string").alias("review_date_max"),
    )
