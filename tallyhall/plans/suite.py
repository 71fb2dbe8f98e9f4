"""The whole run: clean and save, answer every named question, save each result, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.operators.sentiment import CONTRAST
from tallyhall.operators.shares import multi_row_gate
from tallyhall.plans import (
    audit,
    behavior as tb,
    clean_behavior as cb,
    clean_listings as cl,
    clean_texts as ct,
    listings as ab,
    metrics,
    paths,
    texts as tx,
)
from tallyhall.session import saved
from tallyhall.sources import readers, writers

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """What a dataset may need to change: time window, thresholds, topics."""

    window: tuple[int, int] = cb.WINDOW
    min_category_views: int = tb.MIN_CATEGORY_VIEWS
    season_start: str = ab.SEASON_START
    topics: Mapping[str, Sequence[str]] = field(default_factory=lambda: tx.TOPICS)
    contrast: str = CONTRAST
    entire: str = metrics.ENTIRE
    private: str = metrics.PRIVATE


Question = Callable[[Tables, Settings], DataFrame]

# Every named question over the analysis tables, in running order.
QUESTIONS: dict[str, Question] = {
    "tb_overview": lambda t, s: tb.tb_overview(t["behavior"]),
    "tb_funnel": lambda t, s: tb.tb_funnel(t["behavior"]),
    "tb_hourly": lambda t, s: tb.tb_hourly(t["behavior"]),
    "tb_daily": lambda t, s: tb.tb_daily(t["behavior"]),
    "tb_category": lambda t, s: tb.tb_category(t["behavior"], s.min_category_views),
    "tb_category_top_conv": lambda t, s: tb.tb_category_top_conv(t["behavior"], s.min_category_views),
    "tb_repurchase": lambda t, s: tb.tb_repurchase(t["behavior"]),
    "tb_user_activity_tier": lambda t, s: tb.tb_user_activity_tier(t["behavior"]),
    "tb_buyer_vs_nonbuyer": lambda t, s: tb.tb_buyer_vs_nonbuyer(t["behavior"]),
    "tb_intermediate_conv": lambda t, s: tb.tb_intermediate_conv(t["behavior"]),
    "recall_window": lambda t, s: paths.recall_window(t["behavior"]),
    "browsing_path": lambda t, s: paths.browsing_path(t["behavior"]),
    "goods_viewed_together": lambda t, s: paths.goods_viewed_together(t["behavior"]),
    "rfm_segments": lambda t, s: tb.rfm_segments(t["behavior"]),
    "top_items_per_category": lambda t, s: tb.top_items_per_category(t["behavior"]),
    "retention_by_day": lambda t, s: tb.retention_by_day(t["behavior"]),
    "ab_neighbourhood": lambda t, s: ab.ab_neighbourhood(t["listings"]),
    "ab_room_type": lambda t, s: ab.ab_room_type(t["listings"]),
    "ab_price_by_rating": lambda t, s: ab.ab_price_by_rating(t["listings"]),
    "ab_price_by_reviews": lambda t, s: ab.ab_price_by_reviews(t["listings"]),
    "ab_host_scale": lambda t, s: ab.ab_host_scale(t["listings"]),
    "ab_host_concentration": lambda t, s: ab.ab_host_concentration(t["listings"]),
    "ab_superhost_premium": lambda t, s: ab.ab_superhost_premium(t["listings"]),
    "ab_top_revenue_profile": lambda t, s: ab.ab_top_revenue_profile(t["listings"]),
    "ab_review_month_of_year": lambda t, s: ab.ab_review_month_of_year(t["listing_reviews"], s.season_start),
    "listing_review_activity": lambda t, s: ab.listing_review_activity(t["listings"], t["listing_reviews"]),
    "season_lead": lambda t, s: ab.season_lead(t["listing_reviews"], s.season_start),
    "yp_rating_dist": lambda t, s: tx.yp_rating_dist(t["reviews"]),
    "yp_elite_vs_normal": lambda t, s: tx.yp_elite_vs_normal(t["reviews"]),
    "sentiment_quantiles": lambda t, s: tx.sentiment_quantiles(t["reviews"]),
    "rd_sentiment_dist": lambda t, s: tx.rd_sentiment_dist(t["comments"]),
    "rd_len_vs_sentiment": lambda t, s: tx.rd_len_vs_sentiment(t["comments"]),
    "rd_pain_points": lambda t, s: tx.rd_pain_points(t["comments"], s.topics),
}


Figure = Callable[[DataFrame, Settings], DataFrame]

# Figures derived from one named result: the result's name and what to do with it.
FIGURES: dict[str, tuple[str, Figure]] = {
    "funnel_rates": ("tb_funnel", lambda r, s: metrics.funnel_rates(r)),
    "hourly_conversion": ("tb_hourly", lambda r, s: metrics.hourly_conversion(r)),
    "multi_row_gate": ("tb_daily", lambda r, s: multi_row_gate(r)),
    "host_scale_gate": ("ab_host_scale", lambda r, s: multi_row_gate(r)),
    "elite_gate": ("yp_elite_vs_normal", lambda r, s: multi_row_gate(r)),
    "category_quadrants": ("tb_category", lambda r, s: metrics.category_quadrants(r)),
    "neighbourhood_top12": ("ab_neighbourhood", lambda r, s: metrics.neighbourhood_top(r)),
    "room_type_major": ("ab_room_type", lambda r, s: metrics.room_type_major(r)),
    "room_price_multiple": ("ab_room_type", lambda r, s: metrics.room_price_multiple(r, s.entire, s.private)),
    "rating_band_ordered": ("ab_price_by_rating", lambda r, s: metrics.rating_band_ordered(r)),
    "superhost_labels": ("ab_superhost_premium", lambda r, s: metrics.superhost_labels(r)),
    "superhost_ratio": ("ab_superhost_premium", lambda r, s: metrics.superhost_ratio(r)),
    "low_star_share": ("yp_rating_dist", lambda r, s: metrics.low_star_share(r)),
    "topic_tone": ("rd_pain_points", lambda r, s: metrics.topic_tone(r)),
    "pain_points_ranked": ("rd_pain_points", lambda r, s: metrics.pain_points_ranked(r)),
}


def clean_all(
    raw: Tables, lexicon: DataFrame, settings: Settings, modifiers: DataFrame | None = None, phrases: DataFrame | None = None,
    cap: DataFrame | None = None,
) -> dict[str, DataFrame]:
    return {
        "behavior": cb.clean_behavior(raw["behavior"], settings.window),
        "listings": cl.clean_listings(raw["listings"], cap),
        "listing_reviews": cl.clean_listing_reviews(raw["listing_reviews"]),
        "reviews": ct.clean_reviews(raw["reviews"], lexicon, modifiers, settings.contrast, phrases),
        "comments": ct.clean_comments(raw["comments"], lexicon, modifiers, settings.contrast, phrases),
    }


def summary(cleaned: Tables, price_cap: DataFrame) -> DataFrame:
    """One row, one struct per dataset, rounded for reading."""
    parts = {
        "taobao": cb.behavior_summary(cleaned["behavior"]),
        "airbnb": cl.listings_summary(cleaned["listings"], cleaned["listing_reviews"], price_cap),
        "yelp": ct.reviews_summary(cleaned["reviews"]).withColumn("avg_rating", F.round("avg_rating", 2)),
        "reddit": ct.comments_summary(cleaned["comments"]).withColumn("neg_ratio", F.round("neg_ratio", 4)),
    }
    one = price_cap.sparkSession.range(1)
    return one.select(
        *[df.select(F.struct(*df.columns).alias("s")).scalar().alias(k) for k, df in parts.items()]
    )


def run_cleaning(
    raw: Tables, lexicon: DataFrame, out_dir: str, settings: Settings = Settings(), modifiers: DataFrame | None = None,
    phrases: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Clean every dataset once, save tables, log and summary; return the saved tables.

    The price cap, which all three need, is found once.
    """
    spark = lexicon.sparkSession
    cleaned_dir = f"{out_dir}/cleaned"
    cap = saved(cl.price_cap(raw["listings"]))
    for name, df in clean_all(raw, lexicon, settings, modifiers, phrases, cap).items():
        writers.write_cleaned(df, cleaned_dir, name)
    cleaned = {name: readers.load_table(spark, cleaned_dir, name) for name in raw}
    writers.write_log(audit.cleaning_report(dict(raw), settings.window, cap), f"{out_dir}/cleaning_report")
    writers.write_summary(summary(cleaned, cap), f"{out_dir}/summary")
    return cleaned


def run_questions(
    spark: SparkSession,
    cleaned_dir: str,
    results_dir: str,
    settings: Settings = Settings(),
    at_once: int = 4,
    run: str | None = None,
) -> DataFrame:
    """Answer every named question from the saved tables and save each result.

    A few questions run side by side: each ends in a small job that would leave
    most of a cluster idle. A failure ends the run, names its question and what was answered before.
    With a `run` name, every answer is entered in that run's ledger once its result is written, and what the
    ledger holds is not asked again: a run that broke off goes on with the question that failed.
    Returns the run report: order, name, rows.
    """
    ledger = f"{results_dir}/ledger/{run}"
    known = readers.read_ledger(spark, ledger, list(QUESTIONS)) if run else {}
    tables = {}
    for name in ("behavior", "listings", "listing_reviews", "reviews", "comments"):
        tables[name] = readers.load_analysis(spark, cleaned_dir, name)
        writers.save_view(tables[name], name)

    answered: list[str] = []

    def answer(name: str) -> int:
        if name in known:
            return known[name]
        try:
            rows = writers.write_result(QUESTIONS[name](tables, settings), results_dir, name)
            if run:
                writers.write_entry(spark, ledger, name, rows)
        except Exception as error:
            raise RuntimeError(f"question {name} failed; answered: {', '.join(answered) or 'none'}") from error
        answered.append(name)
        return rows

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(answer, QUESTIONS))
    report = pa.table({"seq": list(range(1, len(rows) + 1)), "name": list(QUESTIONS), "rows": rows})
    return spark.createDataFrame(report)


def run_figures(spark: SparkSession, results_dir: str, settings: Settings = Settings()) -> list[str]:
    """Derive every figure from the saved results and save it beside them."""
    for name, (source, derive) in FIGURES.items():
        result = readers.load_result(spark, results_dir, source)
        writers.write_result(derive(result, settings), results_dir, name)
    results = {name: readers.load_result(spark, results_dir, name) for name in metrics.HEADLINE_INPUTS}
    headline = metrics.headline_metrics(results, settings.entire, settings.private)
    writers.write_result(headline, results_dir, "headline_metrics")
    return [*FIGURES, "headline_metrics"]
