"""Behaviour events: raw text rows to typed, valid, unique events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhall.functions.numbers import to_long

# The valid behaviours and the published time window
# (2017-11-25 00:00:00 to 2017-12-03 23:59:59 at UTC+8).
BEHAVIORS = ("pv", "fav", "cart", "buy")
WINDOW = (1511539200, 1512316799)
UTC_OFFSET_SECONDS = 8 * 3600
EVENT_KEY = ("user_id", "item_id", "behavior_type", "timestamp")


def checked(raw: DataFrame, window: tuple[int, int] = WINDOW) -> DataFrame:
    """Typed rows, each with the outcome of the three validity rules."""
    ids = ("user_id", "item_id", "category_id", "timestamp")
    typed = raw.select(*[to_long(c).alias(c) for c in ids], "behavior_type")
    present = F.col("behavior_type").isNotNull()
    for c in ids:
        present = present & F.col(c).isNotNull()
    return typed.withColumns(
        {
            "ok_fields": present,
            "ok_type": F.coalesce(F.col("behavior_type").isin(*BEHAVIORS), F.lit(False)),
            "ok_time": F.coalesce(F.col("timestamp").between(*window), F.lit(False)),
        }
    )


def clean_behavior(raw: DataFrame, window: tuple[int, int] = WINDOW) -> DataFrame:
    """Valid events, one per (user, item, behaviour, second), with local time parts.

    Duplicates can differ in category only; the smallest is kept. The local
    clock is built without time zones, so the session's zone does not matter.
    """
    valid = checked(raw, window).where(F.col("ok_fields") & F.col("ok_type") & F.col("ok_time"))
    unique = valid.groupBy(*EVENT_KEY).agg(F.min("category_id").alias("category_id"))
    clock = F.timestamp_add(
        "SECOND",
        F.col("timestamp") + F.lit(UTC_OFFSET_SECONDS),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )
    return unique.withColumn("datetime", clock).select(
        "user_id",
        "item_id",
        "category_id",
        "behavior_type",
        "datetime",
        F.col("datetime").cast("date").cast("string").alias("date"),
        F.hour("datetime").alias("hour"),
        (F.weekday("datetime") + 1).alias("weekday"),
    )


def behavior_summary(behavior: DataFrame) -> DataFrame:
    return behavior.agg(
        F.count("*").alias("rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("item_id").alias("items"),
        F.countDistinct("category_id").alias("categories"),
        F.min(F.col("date").cast("date")).cast("string").alias("date_min"),
        F.max(F.col("date").cast("date")).cast("string").alias("date_max"),
    )
