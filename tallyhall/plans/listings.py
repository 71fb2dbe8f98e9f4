"""Questions over cleaned listings and listing reviews.

Listings come in under their analysis name: neighbourhood_cleansed is renamed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.functions.numbers import cut_left, cut_right, mean, ordinal, pct
from tallyhall.operators.ranking import tiles_from_counts, with_ntile
from tallyhall.operators.shares import share
from tallyhall.plans.clean_listings import HOST_SCALES
from tallyhall.session import saved

# Band labels in order.
NO_RATING = "无评分"
RATING_BANDS = ((4.0, "4.0以下"), (4.5, "4.0-4.5"), (4.8, "4.5-4.8"), (None, "4.8-5.0"))
RATING_ORDER = (NO_RATING, "4.0以下", "4.0-4.5", "4.5-4.8", "4.8-5.0")
REVIEW_BANDS = ((0, "0条"), (10, "1-10条"), (50, "11-50条"), (200, "51-200条"), (float("inf"), "200条以上"))
TOP_REVENUE, OTHER_REVENUE = "Top25%(高收入)", "其余75%"
SEASON_START = "2019-01-01"
# Months by which supply may precede demand.
LEADS = tuple(range(7))


def ab_neighbourhood(listings: DataFrame) -> DataFrame:
    return (
        listings.groupBy(F.col("neighbourhood").alias("区域"))
        .agg(
            F.count("*").alias("房源数"),
            mean(F.col("price_winsor")).alias("均价"),
            (mean(F.col("occupancy_ratio")) * 100).alias("供给紧张度pct"),
        )
        .orderBy(F.desc("房源数"), "区域")
    )


def ab_room_type(listings: DataFrame) -> DataFrame:
    rooms = listings.groupBy(F.col("room_type").alias("房型")).agg(
        F.count("*").alias("房源数"), mean(F.col("price_winsor")).alias("均价")
    )
    return share(rooms, "房源数", "供给占比pct").orderBy(F.desc("房源数"), "房型")


def ab_price_by_rating(listings: DataFrame) -> DataFrame:
    band = F.coalesce(cut_left(F.col("review_scores_rating"), RATING_BANDS), F.lit(NO_RATING))
    return listings.groupBy(band.alias("评分档")).agg(
        mean(F.col("price_winsor")).alias("均价"), F.count("*").alias("房源数")
    )


def ab_price_by_reviews(listings: DataFrame) -> DataFrame:
    band = cut_right(F.col("number_of_reviews"), -1, REVIEW_BANDS)
    return (
        listings.groupBy(band.alias("评论数档"))
        .agg(mean(F.col("price_winsor")).alias("均价"), F.count("*").alias("房源数"))
        .orderBy(ordinal(F.col("评论数档"), [label for _, label in REVIEW_BANDS]))
    )


def ab_host_scale(listings: DataFrame) -> DataFrame:
    """Hosts, listings and yearly revenue by host size; sizes outside all bands have no label."""
    scales = listings.groupBy(F.col("host_scale").alias("房东规模")).agg(
        F.countDistinct("host_id").alias("房东数"),
        F.count("*").alias("_listings"),
        mean(F.col("estimated_revenue_l365d")).alias("房均年化收入"),
    )
    order = ordinal(F.col("房东规模"), [label for _, label in HOST_SCALES])
    return (
        share(scales, "_listings", "房源占比pct")
        .orderBy(order)
        .select("房东规模", "房东数", "房源占比pct", "房均年化收入")
    )


def ab_host_concentration(listings: DataFrame) -> DataFrame:
    """Percentage of listings held by the top tenth of hosts."""
    per_host = listings.groupBy("host_id").agg(F.count("*").alias("listings"))
    tiles = tiles_from_counts(per_host, "listings", 10, descending=True)
    top = F.sum(F.when(F.col("tile") == 1, F.col("total")))
    return tiles.agg(pct(top, F.sum("total")).alias("头部10%房东房源占比pct"))


def ab_superhost_premium(listings: DataFrame) -> DataFrame:
    flag = F.coalesce((F.col("host_is_superhost") == "t").cast("int"), F.lit(0))
    return listings.groupBy(flag.alias("超级房东")).agg(
        mean(F.col("price_winsor")).alias("均价"),
        mean(F.col("estimated_revenue_l365d")).alias("年化预估收入"),
    )


def ab_top_revenue_profile(listings: DataFrame) -> DataFrame:
    """The top quarter by revenue against the rest; missing revenue counts as lowest."""
    narrow = listings.select(
        "id", "estimated_revenue_l365d", "price_winsor", "review_scores_rating", "accommodates"
    )
    tiled = with_ntile(saved(narrow), "id", "estimated_revenue_l365d", 4, "tile", descending=True)
    group = F.when(F.col("tile") == 1, TOP_REVENUE).otherwise(OTHER_REVENUE)
    return tiled.groupBy(group.alias("收入分层")).agg(
        mean(F.col("price_winsor")).alias("均价"),
        mean(F.col("review_scores_rating")).alias("平均评分"),
        mean(F.col("accommodates")).alias("平均可住人数"),
    )


def ab_review_month_of_year(reviews: DataFrame, since: str = SEASON_START) -> DataFrame:
    """Reviews per calendar month, averaged over the years that have that month."""
    per_month = (
        reviews.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy(F.year("date").alias("y"), F.month("date").alias("月份"))
        .agg(F.count("*").alias("n"))
    )
    return (
        per_month.groupBy("月份")
        .agg((F.sum("n").cast("double") / F.count("*")).alias("年均月评论量"))
        .orderBy("月份")
    )


# Asked for in prose only; the definition is this project's own.


def listing_review_activity(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews written per neighbourhood, counted per listing before the join."""
    per_listing = reviews.groupBy("listing_id").agg(F.count("*").alias("written"))
    joined = listings.join(per_listing, F.col("id") == F.col("listing_id"), "left")
    return joined.groupBy(F.col("neighbourhood").alias("区域")).agg(
        F.count("*").alias("房源数"),
        F.count_if(F.col("written").isNotNull()).alias("有评论房源数"),
        F.coalesce(F.sum("written"), F.lit(0)).cast("bigint").alias("评论总量"),
        pct(F.count_if(F.col("written").isNotNull()), F.count("*")).alias("有评论占比pct"),
    )


def season_lead(reviews: DataFrame, since: str = SEASON_START, lags: Sequence[int] = LEADS) -> DataFrame:
    """How new supply precedes demand: listings with their first review in a month, against reviews so many months later.

    A row per lag: months compared, and the correlation, null if either series does not vary. Months
    without reviews count as 0 from the first month since `since` to the last. A listing first reviewed earlier is not new.
    Sums are of whole numbers, so the result does not depend on their order. Series have a row per month of the calendar.
    """
    month = (F.year("date") * 12 + F.month("date")).alias("m")
    monthly = reviews.where("date IS NOT NULL AND listing_id IS NOT NULL").groupBy("listing_id", month).agg(F.count("*").alias("n"))
    firsts = monthly.groupBy("listing_id").agg(F.min("m").alias("m")).groupBy("m").agg(F.count("*").alias("fresh"))
    begin = int(since[:4]) * 12 + int(since[5:7])
    counts = saved(monthly.groupBy("m").agg(F.sum("n").alias("n")).join(firsts, "m", "left").where(F.col("m") >= begin))
    span = counts.agg(F.min("m").alias("a"), F.max("m").alias("z")).select(F.explode(F.sequence("a", "z")).alias("m"))
    series = saved(span.join(counts, "m", "left").select("m", F.coalesce("fresh", F.lit(0)).alias("x"), F.coalesce("n", F.lit(0)).alias("y")))
    shifted = series.select(F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag"), (F.col("m") + F.col("lag")).alias("then"), "x")
    pairs = shifted.join(series.select(F.col("m").alias("then"), "y"), "then")
    x, y = F.col("x").cast("decimal(14,0)"), F.col("y").cast("decimal(14,0)")
    products = {"c": F.lit(1), "sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}
    sums = pairs.groupBy("lag").agg(*[F.sum(v).alias(k) for k, v in products.items()])

    def spread(both: str, one: str, two: str) -> Column:
        return (F.col("c") * F.col(both) - F.col(one) * F.col(two)).cast("double")

    across = F.sqrt(spread("sxx", "sx", "sx")) * F.sqrt(spread("syy", "sy", "sy"))
    correlation = spread("sxy", "sx", "sy") / F.nullif(across, F.lit(0.0))
    return sums.select(F.col("lag").alias("提前月数"), F.col("c").alias("月份数"), correlation.alias("相关系数"))
