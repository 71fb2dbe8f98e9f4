"""Figures derived from result tables, which hold a few rows each.

The functions take the results of the named questions, freshly computed or
loaded from where they were saved.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhall.functions.numbers import ordinal, pct
from tallyhall.operators.ranking import exact_quantiles
from tallyhall.plans.behavior import STAGES
from tallyhall.plans.clean_listings import HOST_SCALES
from tallyhall.plans.listings import OTHER_REVENUE, RATING_ORDER, TOP_REVENUE

# Room types compared in the report.
ENTIRE, PRIVATE = "Entire home/apt", "Private room"

HEADLINE_INPUTS = (
    "tb_overview", "tb_funnel", "tb_intermediate_conv", "tb_repurchase", "tb_user_activity_tier",
    "tb_buyer_vs_nonbuyer", "tb_category_top_conv", "tb_daily", "ab_room_type", "ab_neighbourhood",
    "ab_host_scale", "ab_host_concentration", "ab_superhost_premium", "ab_top_revenue_profile",
    "yp_rating_dist", "rd_sentiment_dist", "rd_pain_points",
)


def _pick(value: str, when: Column) -> Column:
    """The value of the one row that satisfies a condition, as an aggregate."""
    return F.max(F.when(when, F.col(value)))


def funnel_rates(tb_funnel: DataFrame) -> DataFrame:
    """Each stage as a percentage of the first."""
    place = ordinal(F.col("漏斗层级"), [label for _, label in STAGES])
    first = F.first("用户数").over(Window.orderBy(place))
    return tb_funnel.withColumn("占首层pct", pct(F.col("用户数"), first))


def hourly_conversion(tb_hourly: DataFrame) -> DataFrame:
    rate = F.coalesce(pct(F.col("购买量"), F.col("pv量")), F.lit(0.0))
    return tb_hourly.withColumn("购买转化率pct", rate)


def category_quadrants(tb_category: DataFrame) -> DataFrame:
    """Categories against the median of views and of conversion (on the line counts as low).

    Reads the result three times: pass a saved one.
    """
    views = exact_quantiles(tb_category, "浏览量", {"m": 0.5}).scalar()
    conversion = exact_quantiles(tb_category, "购买转化率pct", {"m": 0.5}).scalar()
    seen, converts = F.col("浏览量") > views, F.col("购买转化率pct") > conversion
    quadrant = (
        F.when(seen & converts, "明星类目")
        .when(converts, "流量洼地")
        .when(seen, "优化详情页")
        .otherwise("低效类目")
    )
    return tb_category.withColumn("象限", quadrant)


def neighbourhood_top(ab_neighbourhood: DataFrame, top: int = 12) -> DataFrame:
    return ab_neighbourhood.orderBy(F.desc("房源数"), "区域").limit(top)


def room_type_major(ab_room_type: DataFrame, above: float = 0.01) -> DataFrame:
    """Room types with more than 1 % of the listings."""
    total = F.sum("房源数").over(Window.partitionBy())
    rows = ab_room_type.withColumn("_share", F.col("房源数") / total)
    return rows.where(F.col("_share") > above).drop("_share")


def rating_band_ordered(ab_price_by_rating: DataFrame) -> DataFrame:
    place = ordinal(F.col("评分档"), RATING_ORDER)
    return ab_price_by_rating.withColumn("序号", place).orderBy("序号")


def superhost_labels(ab_superhost_premium: DataFrame) -> DataFrame:
    name = F.when(F.col("超级房东") == 0, "普通房东").otherwise("超级房东")
    return ab_superhost_premium.withColumn("房东类型", name)


def topic_tone(rd_pain_points: DataFrame) -> DataFrame:
    has = lambda *words: reduce(Column.__or__, [F.contains("痛点主题", F.lit(w)) for w in words])
    tone = F.when(has("惊艳", "好用"), "praise").when(has("替代", "工作"), "neutral").otherwise("pain")
    return rd_pain_points.withColumn("基调", tone)


def pain_points_ranked(rd_pain_points: DataFrame) -> DataFrame:
    """Topics by mentions with their rank and whether they are among the four quoted ones."""
    w = Window.orderBy(F.desc("提及数"), "痛点主题")
    ranked = rd_pain_points.withColumn("名次", F.row_number().over(w))
    return ranked.withColumn("前四", F.col("名次") <= 4)


def superhost_ratio(ab_superhost_premium: DataFrame) -> DataFrame:
    """Price premium in percent and revenue ratio of superhosts over the others."""
    yes, no = F.col("超级房东") == 1, F.col("超级房东") == 0
    ratio = lambda c: F.try_divide(_pick(c, yes), _pick(c, no))
    return ab_superhost_premium.agg(
        ((ratio("均价") - 1) * 100).alias("溢价pct"), ratio("年化预估收入").alias("收入倍数")
    )


def low_star_share(yp_rating_dist: DataFrame) -> DataFrame:
    low = F.sum(F.when(F.col("星级").isin(1.0, 2.0), F.col("评论数")))
    return yp_rating_dist.agg(
        F.coalesce(pct(low, F.sum("评论数")), F.lit(0.0)).alias("低星占比pct")
    )


def day_span(behavior: DataFrame) -> DataFrame:
    """Days from the first to the last event, both included."""
    day = F.col("date").cast("date")
    return behavior.agg((F.datediff(F.max(day), F.min(day)) + 1).alias("天数"))


def room_price_multiple(
    ab_room_type: DataFrame, entire: str = ENTIRE, private: str = PRIVATE
) -> DataFrame:
    room = F.col("房型")
    return ab_room_type.agg(
        _pick("供给占比pct", room == entire).alias("整套占比pct"),
        _pick("供给占比pct", room == private).alias("单间占比pct"),
        F.try_divide(_pick("均价", room == entire), _pick("均价", room == private)).alias("均价倍数"),
    )


def headline_metrics(
    results: Mapping[str, DataFrame], entire: str = ENTIRE, private: str = PRIVATE
) -> DataFrame:
    """The report's key figures as (metric, value, label), from the named results.

    label names what a leading figure belongs to: the first topic, the largest neighbourhood.
    """
    stage, band = F.col("漏斗层级"), F.col("购买频次分层")
    buyers = F.col("用户群") == "购买用户"
    rows: dict[str, dict[str, Column]] = {
        "tb_overview": {
            "events": F.max("行为总量"),
            "active_users": F.max("活跃用户数"),
            "items": F.max("触达商品数"),
            "categories": F.max("触达类目数"),
        },
        "tb_funnel": {
            "funnel_fav_pct": pct(_pick("用户数", stage == "收藏fav"), _pick("用户数", stage == "浏览pv")),
            "funnel_cart_pct": pct(_pick("用户数", stage == "加购cart"), _pick("用户数", stage == "浏览pv")),
            "funnel_buy_pct": pct(_pick("用户数", stage == "购买buy"), _pick("用户数", stage == "浏览pv")),
        },
        "tb_intermediate_conv": {
            "fav_to_buy_pct": F.max("收藏转购买率pct"),
            "cart_to_buy_pct": F.max("加购转购买率pct"),
        },
        "tb_repurchase": {"single_buy_pct": _pick("占比pct", band.startswith("1"))},
        "tb_user_activity_tier": {"top_tier_actions_pct": _pick("行为量占比pct", F.col("活跃度分层") == "D10")},
        "tb_buyer_vs_nonbuyer": {
            "buyer_actions": _pick("平均行为次数", buyers),
            "buyer_items": _pick("平均触达商品数", buyers),
            "other_actions": _pick("平均行为次数", ~buyers),
            "other_items": _pick("平均触达商品数", ~buyers),
        },
        "tb_category_top_conv": {"best_category_conversion_pct": F.max("购买转化率pct")},
        "ab_room_type": {
            "entire_pct": _pick("供给占比pct", F.col("房型") == entire),
            "private_pct": _pick("供给占比pct", F.col("房型") == private),
            "entire_price": _pick("均价", F.col("房型") == entire),
            "private_price": _pick("均价", F.col("房型") == private),
        },
        "tb_daily": {"days": F.datediff(F.max(F.col("日期").cast("date")), F.min(F.col("日期").cast("date"))) + 1},
        "ab_neighbourhood": {"top_neighbourhood_listings": F.max("房源数")},
        "ab_host_scale": {
            f"revenue_hosts_{key}": _pick("房均年化收入", F.col("房东规模") == label)
            for key, (_, label) in zip(("1_2", "3_10", "11_50", "over_50"), HOST_SCALES)
        },
        "ab_top_revenue_profile": {
            f"{key}_revenue_{short}": _pick(column, F.col("收入分层") == tier)
            for key, tier in (("top", TOP_REVENUE), ("rest", OTHER_REVENUE))
            for short, column in (("price", "均价"), ("rating", "平均评分"), ("guests", "平均可住人数"))
        },
        "ab_host_concentration": {"top_hosts_pct": F.max("头部10%房东房源占比pct")},
        "ab_superhost_premium": {
            "superhost_price_premium_pct": (
                F.try_divide(_pick("均价", F.col("超级房东") == 1), _pick("均价", F.col("超级房东") == 0)) - 1
            )
            * 100,
            "superhost_revenue_ratio": F.try_divide(
                _pick("年化预估收入", F.col("超级房东") == 1), _pick("年化预估收入", F.col("超级房东") == 0)
            ),
        },
        "yp_rating_dist": {
            "five_star_pct": _pick("占比pct", F.col("星级") == 5.0),
            "low_star_pct": pct(
                F.sum(F.when(F.col("星级").isin(1.0, 2.0), F.col("评论数"))), F.sum("评论数")
            ),
        },
        "rd_sentiment_dist": {
            "negative_pct": _pick("占比pct", F.col("情感标签") == "负面"),
            "positive_pct": _pick("占比pct", F.col("情感标签") == "正面"),
        },
        "rd_pain_points": {"top_topic_mentions": F.max("提及数")},
    }
    leading = {
        "top_topic_mentions": ("痛点主题", "提及数"),
        "top_neighbourhood_listings": ("区域", "房源数"),
    }
    parts = []
    for name, figures in rows.items():
        labels = {k: leading[k] for k in figures if k in leading}
        one = results[name].agg(
            *[c.cast("double").alias(k) for k, c in figures.items()],
            # The largest, then the first by name.
            *[F.min(F.struct((-F.col(n)).alias("n"), F.col(l).alias("l")))["l"].alias(f"_{k}") for k, (l, n) in labels.items()],
        )
        pairs = [
            F.struct(
                F.lit(k).alias("metric"), F.col(k).alias("value"),
                (F.col(f"_{k}") if k in labels else F.lit(None)).cast("string").alias("label"),
            )
            for k in figures
        ]
        parts.append(one.select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)
