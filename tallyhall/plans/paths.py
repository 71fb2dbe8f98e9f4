"""Questions about a user's events together: how long a purchase waits, the way to it, what is viewed beside what.

Asked for in prose only; the definitions are this project's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhall.functions.numbers import pct
from tallyhall.session import saved

# A session ends after so many seconds without an event, and is cut into parts of this length.
GAP, LONGEST = 30 * 60, 12 * 3600
BOUGHT, NOT_BOUGHT = "购买", "未购买"
# Users who must have viewed both items of a pair, and pairs in the report.
TOGETHER, TOP_PAIRS = 2, 20


def _seconds(at: Column) -> Column:
    return F.unix_seconds(at.cast("timestamp"))


def recall_window(behavior: DataFrame) -> DataFrame:
    """Favourites and carts by the days until the same user next buys the same item (null: never), and their share.

    One pass over each user's and item's events, latest first, carries the next purchase along; a purchase in the
    same second counts as next. Nothing is joined.
    """
    kind = F.col("behavior_type")
    moved = behavior.where(kind.isin("fav", "cart", "buy")).select("user_id", "item_id", "behavior_type", "datetime")
    latest_first = Window.partitionBy("user_id", "item_id").orderBy(F.desc("datetime"))
    up_to_now = latest_first.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    bought = F.min(F.when(kind == "buy", F.col("datetime"))).over(up_to_now)
    waited = moved.withColumn("等待天数", F.datediff(bought.cast("date"), F.col("datetime").cast("date"))).where(kind != "buy")
    counts = waited.groupBy(kind.alias("行为"), "等待天数").agg(F.count("*").alias("次数"))
    return counts.withColumn("占比pct", pct(F.col("次数"), F.sum("次数").over(Window.partitionBy("行为"))))


def sessions(behavior: DataFrame, gap: int = GAP, longest: int = LONGEST) -> DataFrame:
    """user_id, start (of the session), part, steps, first_buy, steps_before: a row per session, or part of a long one.

    A session begins with an event that comes more than `gap` seconds after the user's last one; it is cut
    into parts, `longest` seconds each from its start. steps_before counts events earlier than the part's first purchase; null without one.

    Events are ordered within a user's hour. What an hour needs of the others, the time of the last event and of the last session's
    start before it, comes from one row per hour. So a user with a third of all events is spread over the hours, and sessions
    over their parts.
    """
    second = _seconds(F.col("datetime"))
    events = behavior.select("user_id", second.alias("t"), F.floor(second / 3600).alias("hour"), (F.col("behavior_type") == "buy").alias("buy"))
    # Events of one second are one moment: a user's hour has 3,600 moments at most, however many events.
    moments = events.groupBy("user_id", "hour", "t").agg(F.count("*").alias("n"), F.count_if("buy").alias("buys"))
    inside = Window.partitionBy("user_id", "hour").orderBy("t")
    before = F.lag("t").over(inside)
    marked = moments.withColumn("starts", F.when(F.col("t") - before > gap, F.col("t")))
    hours = marked.groupBy("user_id", "hour").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.max("starts").alias("inner"))
    by_hour = Window.partitionBy("user_id").orderBy("hour")
    opened = hours.withColumn("_before", F.lag("last").over(by_hour))
    fresh = F.col("_before").isNull() | (F.col("first") - F.col("_before") > gap)
    opened = opened.withColumn("_first", F.when(fresh, F.col("first")))
    # The last start at the end of each hour, and so the one that holds when the next begins.
    held = F.last(F.coalesce("inner", "_first"), ignorenulls=True).over(by_hour.rowsBetween(Window.unboundedPreceding, -1))
    opened = opened.select("user_id", "hour", F.coalesce("_first", held).alias("_held"))
    placed = marked.join(opened, ["user_id", "hour"])
    own = F.last("starts", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("start", F.coalesce(own, "_held")).withColumn("part", F.floor((F.col("t") - F.col("start")) / longest))
    key = ["user_id", "start", "part"]
    firsts = placed.groupBy(*key).agg(F.sum("n").alias("steps"), F.min(F.when(F.col("buys") > 0, F.col("t"))).alias("first_buy"))
    earlier = placed.join(firsts.where("first_buy IS NOT NULL").select(*key, "first_buy"), key).where(F.col("t") < F.col("first_buy"))
    counted = earlier.groupBy(*key).agg(F.sum("n").alias("_earlier"))
    joined = firsts.join(counted, key, "left")
    return joined.select(*key, "steps", "first_buy", F.when(F.col("first_buy").isNotNull(), F.coalesce("_earlier", F.lit(0))).alias("steps_before"))


def browsing_path(behavior: DataFrame) -> DataFrame:
    """Sessions by outcome: how many, mean steps, mean steps before the first purchase."""
    outcome = F.when(F.col("first_buy").isNotNull(), BOUGHT).otherwise(NOT_BOUGHT)
    return sessions(behavior).groupBy(outcome.alias("会话结果")).agg(
        F.count("*").alias("会话数"),
        (F.sum("steps").cast("double") / F.count("*")).alias("平均步数"),
        (F.sum("steps_before").cast("double") / F.count("steps_before")).alias("首购前平均步数"),
    )


def views_of(behavior: DataFrame) -> DataFrame:
    """user_id, item_id: every item a user viewed, once, as a written table. Rows without user or item take no part."""
    known = "behavior_type = 'pv' AND user_id IS NOT NULL AND item_id IS NOT NULL"
    return saved(behavior.where(known).select("user_id", "item_id").distinct())


def viewed_together(viewed: DataFrame, least: int = TOGETHER) -> DataFrame:
    """item_a < item_b, users, users_a, users_b: every pair of items that at least `least` (2 or more) users viewed both, counted exactly.

    viewed is a table as views_of writes it.

    Users are ordered by how many items they viewed, and each item lets the last least - 1 of its users go. Of two items
    with `least` users in common, both still keep the first of these, as least - 1 more come after. So only
    items that meet in a user whom both keep are candidates, and the users who viewed most, whose pairs would grow with the
    square of their views, are let go by most of their items. A candidate is then counted through the item
    with fewer users: each of them is looked up among those of the other.
    """
    if least < 2:
        raise ValueError("least must be 2 or more: a pair that one user viewed is no pattern")
    sizes = saved(viewed.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    views = saved(viewed.join(sizes.select("item_id"), "item_id").select("user_id", "item_id"))
    ordered = views.join(views.groupBy("user_id").agg(F.count("*").alias("breadth")).where("breadth > 1"), "user_id")
    # Users of one item only are in no pair. The rank is cut within each task before the shuffle, so a hot item moves few rows.
    widest = Window.partitionBy("item_id").orderBy(F.desc("breadth"), F.desc("user_id"))
    let_go = ordered.withColumn("_place", F.row_number().over(widest)).where(F.col("_place") < least).select("user_id", "item_id")
    kept = saved(ordered.select("user_id", "item_id").join(let_go, ["user_id", "item_id"], "left_anti"))
    one, other = kept.withColumnRenamed("item_id", "item_a"), kept.withColumnRenamed("item_id", "item_b")
    met = one.join(other, "user_id").where("item_a < item_b").select("item_a", "item_b").distinct()
    sized = met.join(sizes.toDF("item_a", "users_a"), "item_a").join(sizes.toDF("item_b", "users_b"), "item_b")
    a_is_less = F.col("users_a") <= F.col("users_b")
    less, more = (F.when(a_is_less, F.col(x)).otherwise(F.col(y)) for x, y in (("item_a", "item_b"), ("item_b", "item_a")))
    asked = sized.withColumn("less", less).withColumn("more", more).join(views.toDF("user_id", "less"), "less")
    found = asked.join(views.toDF("user_id", "more"), ["user_id", "more"])
    counted = found.groupBy("item_a", "item_b", "users_a", "users_b").agg(F.count("*").alias("users")).where(F.col("users") >= least)
    return counted.select("item_a", "item_b", "users", "users_a", "users_b")


def goods_viewed_together(behavior: DataFrame, least: int = TOGETHER, top: int = TOP_PAIRS) -> DataFrame:
    """The pairs of viewed_together with the highest lift: users of both, over how many there would be if items were viewed independently.

    Ties go to more users, then to smaller items. Lift is taken over all users who viewed anything.
    """
    viewed = views_of(behavior)
    everyone = viewed.agg(F.count_distinct("user_id").alias("n")).scalar()
    expected = F.col("users_a").cast("double") * F.col("users_b")
    lift = F.col("users").cast("double") * everyone / expected
    pairs = viewed_together(viewed, least).select(
        F.col("item_a").alias("商品A"), F.col("item_b").alias("商品B"), F.col("users").alias("共同浏览用户数"), lift.alias("提升度")
    )
    return pairs.orderBy(F.desc("提升度"), F.desc("共同浏览用户数"), "商品A", "商品B").limit(top)
