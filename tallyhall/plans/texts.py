"""Questions over star reviews and community comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhall.functions.numbers import cut_left, mean, ordinal, pct
from tallyhall.functions.text import mentions_any
from tallyhall.operators.ranking import exact_quantiles
from tallyhall.operators.shares import share

# Topics and the word each is matched by.
TOPICS = {
    "工作替代 (job)": ["job"],
    "回答错误 (wrong)": ["wrong"],
    "使用限制 (limit)": ["limit"],
    "好用/惊艳 (amazing)": ["amazing"],
    "付费/订阅 (pay)": ["pay"],
    "替代品/竞争 (better than)": ["better than"],
    "封号/审查 (banned)": ["banned"],
    "幻觉/胡编 (hallucination)": ["hallucination"],
}
LENGTH_BANDS = ((50, "50字以下"), (150, "50-150字"), (300, "150-300字"), (None, "300字以上"))
LABEL_ORDER = ("正面", "中性", "负面")
QUANTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def rating_counts(reviews: DataFrame) -> DataFrame:
    """What yp_rating_dist says of numbers of reviews, for reviews without scores."""
    return reviews.groupBy(F.col("rating").alias("星级")).agg(F.count("*").alias("评论数"))


def yp_rating_dist(reviews: DataFrame) -> DataFrame:
    ratings = reviews.groupBy(F.col("rating").alias("星级")).agg(
        F.count("*").alias("评论数"),
        mean(F.col("sentiment")).alias("平均情感得分"),
        mean(F.col("word_count")).alias("平均词数"),
    )
    return share(ratings, "评论数", "占比pct").orderBy("星级")


def yp_elite_vs_normal(reviews: DataFrame) -> DataFrame:
    kind = F.when(F.col("elite_flag") == 1, "精英用户").otherwise("普通用户")
    return reviews.groupBy(kind.alias("用户类型")).agg(
        F.count("*").alias("评论数"),
        mean(F.col("rating")).alias("平均星级"),
        mean(F.col("word_count")).alias("平均词数"),
        mean(F.col("sentiment")).alias("平均情感得分"),
    )


def rd_sentiment_dist(comments: DataFrame) -> DataFrame:
    labels = comments.groupBy(F.col("sentiment_label").alias("情感标签")).agg(
        F.count("*").alias("评论数")
    )
    return share(labels, "评论数", "占比pct").orderBy(ordinal(F.col("情感标签"), LABEL_ORDER))


def rd_len_vs_sentiment(comments: DataFrame) -> DataFrame:
    band = cut_left(F.col("review_len"), LENGTH_BANDS)
    negative = F.count_if(F.col("sentiment_label") == "负面")
    return (
        comments.groupBy(band.alias("评论长度档"))
        .agg(F.count("*").alias("评论数"), pct(negative, F.count("*")).alias("负面占比pct"))
        .orderBy(ordinal(F.col("评论长度档"), [label for _, label in LENGTH_BANDS]))
    )


def topic_counts(flagged: DataFrame, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    """Comments per topic from columns t0, t1, ...: one aggregate, then one row per topic."""
    one = flagged.agg(*[F.count_if(F.col(f"t{i}")).alias(f"t{i}") for i in range(len(topics))])
    entries = [
        F.struct(F.lit(name).alias("痛点主题"), F.col(f"t{i}").alias("提及数"))
        for i, name in enumerate(topics)
    ]
    return one.select(F.inline(F.array(*entries))).orderBy(F.desc("提及数"), "痛点主题")


def rd_pain_points(
    comments: DataFrame, topics: Mapping[str, Sequence[str]] = TOPICS
) -> DataFrame:
    """Comments that mention each topic; a comment may count for several."""
    flags = [
        mentions_any(F.col("body"), words).alias(f"t{i}") for i, words in enumerate(topics.values())
    ]
    return topic_counts(comments.select(*flags), topics)


# Asked for in prose only; the definition is this project's own.


def sentiment_quantiles(reviews: DataFrame) -> DataFrame:
    """Sentiment quantiles per star rating."""
    return exact_quantiles(reviews, "sentiment", QUANTILES, by=["rating"])
