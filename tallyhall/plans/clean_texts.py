"""Star reviews and community comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.functions.numbers import mean, to_double
from tallyhall.functions.text import mentions_any, strip, text_key, word_count
from tallyhall.operators.sentiment import CONTRAST, compound, context_sums, label

# Placeholder bodies, and the shortest body kept.
TOMBSTONES = ("[deleted]", "[removed]", "nan")
MIN_BODY = 15


def dated_reviews(raw: DataFrame) -> DataFrame:
    """Star reviews with Date read as day/month/year (quotes removed) and Rating as a number."""
    stripped = strip(F.replace(F.col("Date"), F.lit('"')))
    return raw.withColumns(
        {
            "Date": F.try_to_timestamp(stripped, F.lit("d/M/yyyy")).cast("date"),
            "Rating": to_double("Rating"),
        }
    )


def rated_reviews(raw: DataFrame) -> DataFrame:
    return dated_reviews(raw).where(F.col("Date").isNotNull() & F.col("Rating").between(1, 5))


def keyed_reviews(raw: DataFrame) -> DataFrame:
    """Dated, rated, non-empty reviews with their features and a key for (business, text).

    Nothing here needs other rows, so it is done before any shuffle. The key
    stands in for the text, which then moves no further.
    """
    return (
        rated_reviews(raw)
        .where(F.length("Content") > 0)
        .select(
            text_key(F.col("business_id"), F.col("Content")).alias("text_key"),
            "Date",
            "Rating",
            "business_name",
            F.col("Eelite_status").isNotNull().cast("int").alias("elite_flag"),
            "Reactions",
            "business_id",
            F.length("Content").alias("review_len"),
            word_count(F.col("Content")).alias("word_count"),
            "Content",
        )
    )


# Of several copies of a review the smallest row in this order of columns stays.
_ROW = (
    "Date", "Rating", "business_name", "elite_flag", "Reactions", "business_id", "review_len",
    "word_count",
)


def _one_per_text(rows: DataFrame, *extra: str) -> DataFrame:
    kept = rows.groupBy("text_key").agg(F.min(F.struct(*_ROW, *extra)).alias("r"))
    return kept.select("r.*")


def unique_reviews(raw: DataFrame) -> DataFrame:
    """One row per (business, text), without the text or its score.

    A text held by a third of the rows is merged before the shuffle.
    """
    return _one_per_text(keyed_reviews(raw))


def clean_reviews(
    raw: DataFrame, lexicon: DataFrame, modifiers: DataFrame | None = None, contrast: str = CONTRAST,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """One row per (business, text) with its sentiment, from one pass over the text."""
    sums = context_sums(keyed_reviews(raw), ["text_key"], "Content", lexicon, modifiers, contrast, phrases, row=_ROW)
    return sums.select("row.*", "valence").select(
        "business_id", "business_name", "Date", "Rating", "review_len", "word_count", "elite_flag",
        compound(F.col("valence")).alias("sentiment"),
        label(compound(F.col("valence"))).alias("sentiment_label"),
        "Reactions",
    )


def reviews_summary(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        F.count("*").alias("rows"),
        F.countDistinct("business_id").alias("businesses"),
        mean(F.col("Rating")).alias("avg_rating"),
    )


def live_body(body: Column) -> Column:
    """True for a body that is there and is no placeholder."""
    return F.coalesce(~body.isin(*TOMBSTONES), F.lit(False))


def keyed_comments(raw: DataFrame) -> DataFrame:
    """Live comments with length and rank among the copies of their id; a missing id is held as the empty text.

    The rank puts longer bodies first, then smaller hashes of the text; it is of fixed width, so
    that the best copy is found by hashing, without a sort.
    """
    body = F.col("body")
    place = F.conv(F.substring(text_key(F.col("comment_id"), body), 1, 15), 16, 10).cast("decimal(38,0)")
    return (
        raw.withColumnRenamed("comment_body", "body")
        .where(live_body(body))
        .withColumn("comment_id", F.coalesce("comment_id", F.lit("")))
        .withColumn("review_len", F.length(body))
        .withColumn("rank", F.col("review_len").cast("decimal(38,0)") * F.lit(2 * 10**18).cast("decimal(20,0)") - place)
        .withColumn("rank", F.col("rank").cast("decimal(38,0)"))
    )


def kept_comments(keyed: DataFrame, *extra: str) -> DataFrame:
    """One row per comment_id: the longest body, then the smallest hash; 15+ characters.

    So an id with a copy that passes the length rule is never lost. `extra` columns must
    depend on the body alone and be of fixed width; no text moves.
    """
    best = [F.max_by(c, "rank").alias(c) for c in ("review_len", *extra)]
    kept = keyed.groupBy("comment_id").agg(F.max("rank").alias("rank"), *best)
    return kept.where(F.col("review_len") >= MIN_BODY)


def scored_comments(
    raw: DataFrame, lexicon: DataFrame, modifiers: DataFrame | None = None, contrast: str = CONTRAST,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """Kept comments without their text: id, rank, length, sentiment. One pass over the text."""
    sums = context_sums(keyed_comments(raw), ["comment_id", "review_len", "rank"], "body", lexicon, modifiers, contrast, phrases)
    return kept_comments(sums, "valence").select(
        "comment_id",
        "rank",
        "review_len",
        compound(F.col("valence")).alias("sentiment"),
        label(compound(F.col("valence"))).alias("sentiment_label"),
    )


def clean_comments(
    raw: DataFrame, lexicon: DataFrame, modifiers: DataFrame | None = None, contrast: str = CONTRAST,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """Kept comments with text and sentiment. Text moves once, to meet the kept ranks; copies of it merge there."""
    scored = scored_comments(raw, lexicon, modifiers, contrast, phrases)
    columns = ["comment_id", "rank", "body", "sentiment", "sentiment_label", "review_len"]
    texts = keyed_comments(raw).select("comment_id", "rank", "body")
    return (
        texts.join(scored, ["comment_id", "rank"])
        .select(*columns)
        .distinct()
        .select(F.nullif("comment_id", F.lit("")).alias("comment_id"), *columns[2:])
    )


def comment_topics(raw: DataFrame, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    """Kept comments with one flag per topic, t0, t1, ..., found before the shuffle."""
    names = [f"t{i}" for i in range(len(topics))]
    flags = {n: mentions_any(F.col("body"), words) for n, words in zip(names, topics.values())}
    return kept_comments(keyed_comments(raw).withColumns(flags), *names)


def comments_summary(comments: DataFrame) -> DataFrame:
    negative = F.count_if(F.col("sentiment_label") == "负面").cast("double")
    return comments.agg(
        F.count("*").alias("rows"), F.try_divide(negative, F.count("*")).alias("neg_ratio")
    )
