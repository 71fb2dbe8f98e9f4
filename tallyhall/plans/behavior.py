"""Questions over cleaned behaviour events."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhall.functions.numbers import cut_right, ordinal, pct
from tallyhall.operators.ranking import tiles_from_counts, with_ntile
from tallyhall.operators.shares import share
from tallyhall.session import saved

# Funnel stages in order, purchase-frequency bands.
STAGES = (("pv", "浏览pv"), ("fav", "收藏fav"), ("cart", "加购cart"), ("buy", "购买buy"))
PURCHASE_BANDS = ((1, "1次"), (2, "2次"), (5, "3-5次"), (float("inf"), "6次及以上"))
MIN_CATEGORY_VIEWS = 200


def _is(kind: str) -> Column:
    return F.col("behavior_type") == kind


def tb_overview(behavior: DataFrame) -> DataFrame:
    return behavior.agg(
        F.count("*").alias("行为总量"),
        F.countDistinct("user_id").alias("活跃用户数"),
        F.countDistinct("item_id").alias("触达商品数"),
        F.countDistinct("category_id").alias("触达类目数"),
    )


def tb_funnel(behavior: DataFrame) -> DataFrame:
    """Distinct users per behaviour; a stage nobody reached shows 0."""
    spark = behavior.sparkSession
    stages = spark.createDataFrame(
        pa.table(
            {
                "behavior_type": [k for k, _ in STAGES],
                "漏斗层级": [label for _, label in STAGES],
                "ord": list(range(len(STAGES))),
            }
        )
    )
    users = behavior.groupBy("behavior_type").agg(F.countDistinct("user_id").alias("n"))
    return (
        stages.join(users, "behavior_type", "left")
        .orderBy("ord")
        .select("漏斗层级", F.coalesce("n", F.lit(0)).cast("bigint").alias("用户数"))
    )


def tb_hourly(behavior: DataFrame) -> DataFrame:
    return (
        behavior.groupBy(F.col("hour").alias("小时"))
        .agg(F.count_if(_is("pv")).alias("pv量"), F.count_if(_is("buy")).alias("购买量"))
        .orderBy("小时")
    )


def tb_daily(behavior: DataFrame) -> DataFrame:
    views = F.count_if(_is("pv"))
    return (
        behavior.groupBy(F.col("date").alias("日期"))
        .agg(
            F.countDistinct("user_id").alias("活跃用户数"),
            views.alias("pv量"),
            pct(F.count_if(_is("buy")), views).alias("购买转化率pct"),
        )
        .orderBy("日期")
    )


def tb_category(behavior: DataFrame, min_views: int = MIN_CATEGORY_VIEWS) -> DataFrame:
    """Views, purchases and conversion of every category with enough views."""
    return (
        behavior.groupBy(F.col("category_id").alias("类目ID"))
        .agg(F.count_if(_is("pv")).alias("浏览量"), F.count_if(_is("buy")).alias("购买量"))
        .where(F.col("浏览量") >= min_views)
        .withColumn("购买转化率pct", pct(F.col("购买量"), F.col("浏览量")))
    )


def tb_category_top_conv(
    behavior: DataFrame, min_views: int = MIN_CATEGORY_VIEWS, top: int = 10
) -> DataFrame:
    return (
        tb_category(behavior, min_views)
        .select("类目ID", "购买转化率pct", "浏览量")
        .orderBy(F.desc("购买转化率pct"), F.desc("浏览量"), "类目ID")
        .limit(top)
    )


def _buys_per_user(behavior: DataFrame) -> DataFrame:
    return behavior.where(_is("buy")).groupBy("user_id").agg(F.count("*").alias("buys"))


def tb_repurchase(behavior: DataFrame) -> DataFrame:
    """Buyers by number of purchases, with their share."""
    band = cut_right(F.col("buys"), 0, PURCHASE_BANDS).alias("购买频次分层")
    bands = _buys_per_user(behavior).groupBy(band).agg(F.count("*").alias("用户数"))
    order = ordinal(F.col("购买频次分层"), [label for _, label in PURCHASE_BANDS])
    return share(bands, "用户数", "占比pct").orderBy(order)


def tb_user_activity_tier(behavior: DataFrame, tiers: int = 10) -> DataFrame:
    """Users in ten equal groups by activity (D10 most active) and their share of actions."""
    per_user = behavior.groupBy("user_id").agg(F.count("*").alias("actions"))
    tiles = tiles_from_counts(per_user, "actions", tiers)
    return (
        share(tiles, "total", "行为量占比pct")
        .orderBy("tile")
        .select(
            F.concat(F.lit("D"), F.col("tile").cast("string")).alias("活跃度分层"),
            F.col("entities").alias("用户数"),
            "行为量占比pct",
        )
    )


def tb_buyer_vs_nonbuyer(behavior: DataFrame) -> DataFrame:
    """Mean actions and mean distinct items of buyers and of everyone else."""
    per_user = behavior.groupBy("user_id").agg(
        F.count("*").alias("actions"),
        F.countDistinct("item_id").alias("items"),
        F.count_if(_is("buy")).alias("buys"),
    )
    group = F.when(F.col("buys") > 0, "购买用户").otherwise("未购买用户").alias("用户群")
    return per_user.groupBy(group).agg(
        (F.sum("actions").cast("double") / F.count("*")).alias("平均行为次数"),
        (F.sum("items").cast("double") / F.count("*")).alias("平均触达商品数"),
    )


def tb_intermediate_conv(behavior: DataFrame, grain: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Share of those with a favourite (a cart) who also bought.

    The grain is the user; ("user_id", "date") asks for a purchase on the same day.
    """
    did = behavior.groupBy(*grain).agg(
        *[(F.count_if(_is(k)) > 0).alias(k) for k in ("fav", "cart", "buy")]
    )
    both = lambda k: pct(F.count_if(F.col(k) & F.col("buy")), F.count_if(F.col(k)))
    return did.agg(both("fav").alias("收藏转购买率pct"), both("cart").alias("加购转购买率pct"))


# Asked for in prose only; the definitions below are this project's own.


def rfm_segments(behavior: DataFrame) -> DataFrame:
    """Buyers by recency and frequency fifths (5 = most recent, most frequent)."""
    # Days since the last purchase, counted back from the data's last day.
    day = F.col("date").cast("date")
    latest = behavior.agg(F.max(day).alias("d")).scalar()
    buyers = (
        behavior.where(_is("buy"))
        .groupBy("user_id")
        .agg(F.max(day).alias("last_buy"), F.count("*").alias("frequency"))
        .withColumn("recency", F.datediff(latest, F.col("last_buy")))
    )
    scored = with_ntile(saved(buyers), "user_id", "recency", 5, "r", descending=True)
    scored = with_ntile(scored, "user_id", "frequency", 5, "f")
    recent, frequent = F.col("r") >= 4, F.col("f") >= 4
    segment = (
        F.when(recent & frequent, "重要价值")
        .when(recent, "新近")
        .when(frequent, "重要唤回")
        .otherwise("流失风险")
    )
    return scored.groupBy(segment.alias("segment")).agg(
        F.count("*").alias("users"),
        (F.sum("recency").cast("double") / F.count("*")).alias("avg_recency_days"),
        (F.sum("frequency").cast("double") / F.count("*")).alias("avg_frequency"),
    )


def top_items_per_category(behavior: DataFrame, top: int = 3) -> DataFrame:
    """The most viewed items of every category; ties go to the smaller item id."""
    views = (
        behavior.where(_is("pv"))
        .groupBy("category_id", "item_id")
        .agg(F.count("*").alias("views"))
    )
    w = Window.partitionBy("category_id").orderBy(F.desc("views"), "item_id")
    return views.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def retention_by_day(behavior: DataFrame) -> DataFrame:
    """Users per first day who were active n days later.

    Each user is one row with the set of own days, no more than the data has.
    """
    day = F.col("date").cast("date")
    users = behavior.groupBy("user_id").agg(F.min(day).alias("cohort"), F.collect_set(day).alias("days"))
    counts = (
        users.select("cohort", F.explode("days").alias("date"))
        .groupBy("cohort", F.datediff("date", "cohort").alias("day_offset"))
        .agg(F.count("*").alias("users"))
        .withColumn("cohort", F.col("cohort").cast("string"))
    )
    size = F.max(F.when(F.col("day_offset") == 0, F.col("users"))).over(Window.partitionBy("cohort"))
    return counts.withColumn("retention_pct", pct(F.col("users"), size))
