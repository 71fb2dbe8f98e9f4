"""The cleaning log: how many rows remain after each step, without re-running the chain.

Each dataset needs one aggregate. Row rules are counted side by side; a removal
of duplicates is counted as the number of distinct keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.functions.numbers import to_long
from tallyhall.plans import clean_behavior as cb, clean_listings as cl, clean_texts as ct

COLUMNS = ("数据集", "步骤", "清洗动作", "剩余记录数")

# Dataset names, steps and sentences of the log, in order; %d takes a number counted.
LOG = {
    "behavior": ("淘宝用户行为(天池)", (
        ("原始数据", "共 %d 条用户行为记录"),
        ("缺失值处理", "剔除字段缺失/非数值的脏记录"),
        ("异常值过滤", "剔除非法行为类型"),
        ("异常值过滤", "剔除官方时间窗口外的记录"),
        ("去重", "剔除完全重复记录 %d 条"),
        ("缺失值处理", "剔除关键字段缺失记录"),
    )),
    "listings": ("香港Airbnb(InsideAirbnb)", (
        ("原始数据", "共 %d 条香港房源"),
        ("异常值过滤", "剔除价格缺失或<=0的房源"),
        ("极端值缩尾", "价格99分位=$%s 以上封顶处理"),
        ("缺失值处理", "剔除区域/房型/房东缺失的房源"),
    )),
    "listing_reviews": ("香港Airbnb(InsideAirbnb)", (
        ("原始数据", "共 %d 条评论"),
        ("缺失值处理", "剔除空评论"),
        ("去重", "剔除重复评论"),
    )),
    "reviews": ("Yelp评论样本", (
        ("原始数据", "共 %d 条商家评论"),
        ("类型转换", "标准化DD/MM/YYYY日期并剔除无法解析的日期"),
        ("异常值过滤", "剔除非1-5星评分"),
        ("去重/缺失值", "剔除重复与空评论"),
    )),
    "comments": ("Reddit(r/ChatGPT)", (
        ("原始数据", "共 %d 条社区评论"),
        ("缺失值处理", "剔除已删除/移除的评论"),
        ("去重", "剔除重复评论"),
        ("异常值过滤", "剔除<15字符的灌水评论"),
    )),
}


def _rows(one: DataFrame, table: str, left: list[Column], told: dict[int, Column]) -> DataFrame:
    """Turn one row of counts into a log row per step of the table: how many rows are left, and the number its sentence tells."""
    tables = list(LOG)
    first = 1 + sum(len(LOG[t][1]) for t in tables[: tables.index(table)])
    dataset, steps = LOG[table]
    entries = [
        F.struct(
            F.lit(first + i).alias("seq"),
            F.lit(dataset).alias(COLUMNS[0]),
            F.lit(step).alias(COLUMNS[1]),
            (F.format_string(action, told[i]) if i in told else F.lit(action)).alias(COLUMNS[2]),
            remaining.cast("bigint").alias(COLUMNS[3]),
        )
        for i, ((step, action), remaining) in enumerate(zip(steps, left, strict=True))
    ]
    return one.select(F.inline(F.array(*entries)))


def _count_if(name: str, rule: Column) -> Column:
    return F.count_if(rule).alias(name)


def behavior_log(raw: DataFrame, window: tuple[int, int] = cb.WINDOW) -> DataFrame:
    typed = F.col("ok_fields") & F.col("ok_type")
    valid = typed & F.col("ok_time")
    one = cb.checked(raw, window).agg(
        F.count("*").alias("raw"),
        _count_if("fields", F.col("ok_fields")),
        _count_if("types", typed),
        _count_if("times", valid),
        F.count_distinct(F.when(valid, F.struct(*cb.EVENT_KEY))).alias("unique"),
    )
    c = F.col
    # The last step repeats the first; nothing can be missing by then.
    left = [c("raw"), c("fields"), c("types"), c("times"), c("unique"), c("unique")]
    return _rows(one, "behavior", left, {0: c("raw"), 4: c("times") - c("unique")})


def listings_log(raw: DataFrame, cap: DataFrame | None = None) -> DataFrame:
    priced = F.coalesce(F.col("price") > 0, F.lit(False))
    complete = priced
    for name in ("neighbourhood_cleansed", "room_type", "host_id"):
        complete = complete & F.col(name).isNotNull()
    one = cl.typed_listings(raw).agg(
        F.count("*").alias("raw"), _count_if("priced", priced), _count_if("complete", complete)
    )
    one = one.withColumn("p99", (cl.price_cap(raw) if cap is None else cap).scalar())
    c = F.col
    left = [c("raw"), c("priced"), c("priced"), c("complete")]
    return _rows(one, "listings", left, {0: c("raw"), 2: F.bround("p99").cast("bigint")})


def listing_reviews_log(raw: DataFrame) -> DataFrame:
    said = F.coalesce((F.length("comments") > 0) & ~F.col("comments").isin("nan", "None"), F.lit(False))
    one = raw.agg(
        F.count("*").alias("raw"),
        _count_if("said", said),
        F.count_distinct(F.when(said, F.struct(to_long("id")))).alias("unique"),
    )
    return _rows(one, "listing_reviews", [F.col("raw"), F.col("said"), F.col("unique")], {0: F.col("raw")})


def reviews_log(raw: DataFrame) -> DataFrame:
    dated = F.col("Date").isNotNull()
    rated = dated & F.coalesce(F.col("Rating").between(1, 5), F.lit(False))
    full = rated & F.coalesce(F.length("Content") > 0, F.lit(False))
    key = ct.text_key(F.col("business_id"), F.col("Content"))
    one = ct.dated_reviews(raw).agg(
        F.count("*").alias("raw"),
        _count_if("dated", dated),
        _count_if("rated", rated),
        F.count_distinct(F.when(full, key)).alias("unique"),
    )
    left = [F.col(name) for name in ("raw", "dated", "rated", "unique")]
    return _rows(one, "reviews", left, {0: F.col("raw")})


def comments_log(raw: DataFrame) -> DataFrame:
    """Which copy of a comment is kept decides its length: the longest live one."""
    body = F.col("comment_body")
    live = ct.live_body(body)
    per_id = raw.groupBy(F.coalesce("comment_id", F.lit(""))).agg(
        F.count("*").alias("raw"),
        _count_if("live", live),
        F.max(F.when(live, F.length(body))).alias("kept_len"),
    )
    one = per_id.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("live"), F.lit(0)).alias("live"),
        _count_if("unique", F.col("kept_len").isNotNull()),
        _count_if("long", F.col("kept_len") >= ct.MIN_BODY),
    )
    left = [F.col(name) for name in ("raw", "live", "unique", "long")]
    return _rows(one, "comments", left, {0: F.col("raw")})


def cleaning_report(
    raw: dict[str, DataFrame], window: tuple[int, int] = cb.WINDOW, cap: DataFrame | None = None
) -> DataFrame:
    """All log rows in order; `seq` gives that order. `cap` is the price cap of the listings, if it is known already."""
    logs = [
        behavior_log(raw["behavior"], window),
        listings_log(raw["listings"], cap),
        listing_reviews_log(raw["listing_reviews"]),
        reviews_log(raw["reviews"]),
        comments_log(raw["comments"]),
    ]
    return reduce(DataFrame.unionByName, logs).orderBy("seq")


def cleaning_report_head(report: DataFrame, rows: int = 17) -> DataFrame:
    """The excerpt shown in an appendix: the first rows, three columns."""
    return report.orderBy("seq").limit(rows).select(COLUMNS[0], COLUMNS[2], COLUMNS[3])


def total_records(cleaned: dict[str, DataFrame]) -> DataFrame:
    """Rows over all cleaned tables together."""
    counts = [df.agg(F.count("*").alias("n")) for df in cleaned.values()]
    return reduce(DataFrame.unionByName, counts).agg(F.sum("n").alias("total_records"))
