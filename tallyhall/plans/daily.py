"""Behaviour by day, kept as counts and sketches that add up.

The layer has one folder per date, beside the cleaned events. Loading a day replaces that day's rows and
reads no other; questions about any span of days read the layer alone. Their distinct counts are approximate
and say so in their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.functions.numbers import pct
from tallyhall.operators.sketches import distinct_sketch, estimate, merged
from tallyhall.plans.behavior import STAGES

LAYER = "behavior_by_day"
COLUMNS = "date STRING, behavior_type STRING, events LONG, users BINARY, items BINARY, categories BINARY"
_SKETCHED = {"users": "user_id", "items": "item_id", "categories": "category_id"}


def by_day(behavior: DataFrame) -> DataFrame:
    """date, behavior_type, events, and a sketch each of users, items and categories."""
    return behavior.groupBy("date", "behavior_type").agg(
        F.count("*").alias("events"), *[distinct_sketch(column).alias(name) for name, column in _SKETCHED.items()]
    )


def add_days(behavior: DataFrame, cleaned_dir: str) -> None:
    """Put the days of `behavior` into the layer. Days it holds already are replaced, others stay: safe to run again."""
    rows = by_day(behavior).hint("rebalance", "date")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(f"{cleaned_dir}/{LAYER}")


def load_days(spark: SparkSession, cleaned_dir: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(f"{cleaned_dir}/{LAYER}")


def overview(days: DataFrame) -> DataFrame:
    """tb_overview from the layer: events exactly, the distinct counts about."""
    return days.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("行为总量"),
        estimate(merged("users")).alias("活跃用户数约"),
        estimate(merged("items")).alias("触达商品数约"),
        estimate(merged("categories")).alias("触达类目数约"),
    )


def funnel(days: DataFrame) -> DataFrame:
    """tb_funnel from the layer; a stage nobody reached shows 0."""
    one = days.agg(
        *[estimate(merged(F.when(F.col("behavior_type") == kind, F.col("users")))).alias(kind) for kind, _ in STAGES]
    )
    stages = [F.struct(F.lit(label).alias("漏斗层级"), F.col(kind).alias("用户数约")) for kind, label in STAGES]
    return one.select(F.inline(F.array(*stages)))


def daily(days: DataFrame) -> DataFrame:
    """tb_daily from the layer."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("behavior_type") == kind, F.col("events"))), F.lit(0))
    return days.groupBy(F.col("date").alias("日期")).agg(
        estimate(merged("users")).alias("活跃用户数约"), of("pv").alias("pv量"), pct(of("buy"), of("pv")).alias("购买转化率pct")
    )
