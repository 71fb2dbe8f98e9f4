
from __future__ import annotations

import sys
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import sql as oracle  # noqa: E402
from tallyhall.operators import sketches
from tallyhall.operators.sentiment import compound, context_sums, label, score, valence_sums
from tallyhall.plans import (
    audit,
    behavior as tb,
    clean_behavior as cb,
    clean_listings as cl,
    clean_texts as ct,
    daily,
    listings as ab,
    metrics,
    suite,
    texts as tx,
)
from tallyhall.session import saved, shared_dir
from tallyhall.sources import readers, testviews as tv, writers

try:  # the operators for training data can be taken out
    import corpus_pipeline
    from tallyhall.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tallyhall.llm", "tallyhall.llm.queries"):
        raise
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
SETTINGS = suite.Settings(
    window=tv.EVENT_WINDOW,
    min_category_views=tv.MIN_CATEGORY_VIEWS,
    season_start=tv.SEASON_START,
    contrast=tv.CONTRAST,
    topics=tv.TOPICS,
    entire=tv.ENTIRE,
    private=tv.PRIVATE,
)

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Cleaned tables over the test views, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.sentiment = (tv.lexicon(spark), tv.modifiers(spark), tv.CONTRAST)

    def __getitem__(self, name: str) -> DataFrame:
        if name == "behavior":
            return cb.clean_behavior(tv.behavior_raw(self.spark, self.folder), SETTINGS.window)
        if name == "listings":
            cleaned = cl.clean_listings(tv.listings_raw(self.spark, self.folder))
            return readers.for_analysis(cleaned, "listings")
        if name == "listing_reviews":
            raw = tv.listing_reviews_raw(self.spark, self.folder)
            return cl.clean_listing_reviews(raw, with_text=False)
        if name == "reviews":
            cleaned = ct.clean_reviews(tv.reviews_raw(self.spark, self.folder), *self.sentiment)
            return readers.for_analysis(cleaned, "reviews")
        if name == "comments":
            return ct.scored_comments(tv.comments_raw(self.spark, self.folder), *self.sentiment)
        raise KeyError(name)


def _ask(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """A named question straight from the raw tables."""
    if name == "rd_pain_points":
        # Topics are matched before duplicates go, so that no text is shuffled.
        flagged = ct.comment_topics(tv.comments_raw(spark, folder), SETTINGS.topics)
        return tx.topic_counts(flagged, SETTINGS.topics)
    return suite.QUESTIONS[name](Tables(spark, folder), SETTINGS)


def _figure(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """A figure derived from a named result, which is saved first if read repeatedly."""
    source, derive = suite.FIGURES[name]
    if name == "low_star_share":  # needs no scores
        reviews = ct.unique_reviews(tv.reviews_raw(spark, folder))
        return metrics.low_star_share(tx.rating_counts(readers.renamed(reviews, "reviews")))
    result = _ask(source, spark, folder)
    return derive(saved(result) if name == "category_quadrants" else result, SETTINGS)


def _sentiment_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score; doc_id is the key, so its text is scored once."""
    docs = tv.table(spark, folder, "documents")
    sums = valence_sums(docs, ["doc_id"], "text", tv.lexicon(spark))
    return sums.select("doc_id", score(F.col("valence")).alias("sentiment"))


def _sentiment_in_context(spark: SparkSession, folder: str) -> DataFrame:
    """As _sentiment_score, with the words around each hit taken into account."""
    docs = tv.table(spark, folder, "documents")
    sums = context_sums(docs, ["doc_id"], "text", tv.lexicon(spark), tv.modifiers(spark), tv.CONTRAST)
    return sums.select("doc_id", compound(F.col("valence")).alias("sentiment"))


def _sentiment_in_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """As _sentiment_in_context, with phrases that take the place of their words."""
    docs = tv.table(spark, folder, "documents")
    sums = context_sums(docs, ["doc_id"], "text", tv.lexicon(spark), tv.modifiers(spark), tv.CONTRAST, tv.phrases(spark))
    return sums.select("doc_id", compound(F.col("valence")).alias("sentiment"))


def _sentiment_label(spark: SparkSession, folder: str) -> DataFrame:
    scored = _sentiment_score(spark, folder).withColumn("sentiment_label", label(F.col("sentiment")))
    return scored.groupBy("sentiment_label").agg(F.count("*").alias("documents"))


def _listings_summary(spark: SparkSession, folder: str) -> DataFrame:
    raw = tv.listings_raw(spark, folder)
    reviews = cl.clean_listing_reviews(tv.listing_reviews_raw(spark, folder), with_text=False)
    return cl.listings_summary(cl.clean_listings(raw), reviews, cl.price_cap(raw))


def _cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return audit.cleaning_report(tv.raw_inputs(spark, folder), SETTINGS.window)


def _total_records(spark: SparkSession, folder: str) -> DataFrame:
    raw = tv.raw_inputs(spark, folder)
    return audit.total_records(
        {
            "behavior": cb.clean_behavior(raw["behavior"], SETTINGS.window),
            "listings": cl.clean_listings(raw["listings"]),
            "listing_reviews": cl.clean_listing_reviews(raw["listing_reviews"], with_text=False),
            "reviews": ct.unique_reviews(raw["reviews"]),
            "comments": ct.kept_comments(ct.keyed_comments(raw["comments"])),
        }
    )


def _headline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Seventeen questions over four tables: each table is cleaned and saved once."""
    fresh = Tables(spark, folder)
    tables = {name: saved(fresh[name]) for name in ("behavior", "listings", "reviews", "comments")}
    results = {
        name: _ask(name, spark, folder) if name == "rd_pain_points" else suite.QUESTIONS[name](tables, SETTINGS)
        for name in metrics.HEADLINE_INPUTS
    }
    return metrics.headline_metrics(results, SETTINGS.entire, SETTINGS.private)


def _named_query_suite(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, save, answer everything from the saved tables, save, report."""
    out = shared_dir(spark)
    suite.run_cleaning(tv.raw_inputs(spark, folder), tv.lexicon(spark), out, SETTINGS, tv.modifiers(spark))
    return suite.run_questions(spark, f"{out}/cleaned", f"{out}/tables", SETTINGS)


def _raw_csv_behavior(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as headerless CSV, read back by the raw reader, cleaned."""
    path = f"{shared_dir(spark)}/behavior"
    tv.behavior_raw(spark, folder).write.csv(path, header=False)
    return cb.behavior_summary(cb.clean_behavior(readers.read_behavior_csv(spark, path), SETTINGS.window))


def _raw_csv_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comments with line breaks written as gzip CSV, read back by the raw reader, cleaned."""
    path = f"{shared_dir(spark)}/comments"
    writers.write_cleaned_csv(tv.comments_raw(spark, folder), path)
    raw = readers.read_csv(spark, path, "comments")
    return ct.comments_summary(ct.scored_comments(raw, tv.lexicon(spark), tv.modifiers(spark), tv.CONTRAST))


def _cleaned_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Events saved as the cleaned layer (a folder per date) and loaded again."""
    out = shared_dir(spark)
    writers.write_cleaned(Tables(spark, folder)["behavior"], out, "behavior")
    return tb.tb_daily(readers.load_analysis(spark, out, "behavior"))


def _days_added(spark: SparkSession, folder: str) -> DataFrame:
    """The layer of days, filled in two loads of which the second repeats days of the first."""
    out, events = shared_dir(spark), Tables(spark, folder)["behavior"]
    middle = events.agg(F.expr("get(sort_array(collect_set(date)), int(count(DISTINCT date) div 2))").alias("m")).scalar()
    daily.add_days(events.where(F.col("date") <= middle), out)
    daily.add_days(events.where(F.col("date") >= middle), out)
    return daily.load_days(spark, out)


def _sketched_daily(spark: SparkSession, folder: str) -> DataFrame:
    """tb_daily from sketches: what is exact, and whether users are within five standard errors of the exact count."""
    exact = tb.tb_daily(Tables(spark, folder)["behavior"]).select("日期", F.col("活跃用户数").alias("用户数"))
    return daily.daily(_days_added(spark, folder)).join(exact, "日期").select(
        "日期", "pv量", "购买转化率pct", sketches.within(F.col("活跃用户数约"), F.col("用户数")).alias("误差内")
    )


def _sketched_overview(spark: SparkSession, folder: str) -> DataFrame:
    """tb_overview and tb_funnel from sketches merged over all days, held against the exact counts."""
    events = Tables(spark, folder)["behavior"]
    days = _days_added(spark, folder)
    about = saved(daily.overview(days))
    exact = tb.tb_overview(events)
    near = [
        sketches.within(about.select(f"{name}约").scalar(), F.col(name)).alias(f"{name}误差内")
        for name in ("活跃用户数", "触达商品数", "触达类目数")
    ]
    return exact.select(about.select("行为总量").scalar().alias("行为总量"), *near)


def _sketched_funnel(spark: SparkSession, folder: str) -> DataFrame:
    exact = tb.tb_funnel(Tables(spark, folder)["behavior"])
    about = daily.funnel(_days_added(spark, folder))
    return about.join(exact, "漏斗层级").select("漏斗层级", sketches.within(F.col("用户数约"), F.col("用户数")).alias("误差内"))


def _sketched_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Price quantiles by room type from sketches of each neighbourhood, merged: are their exact ranks within the bound?"""
    rows = saved(Tables(spark, folder)["listings"].select("neighbourhood", "room_type", "price"))
    parts = sketches.quantile_sketches(rows, "price", ["neighbourhood", "room_type"])
    found = sketches.quantiles(parts, tx.QUANTILES, ["room_type"])
    each = found.select("room_type", "n", F.inline(F.array(*[F.struct(F.lit(k).alias("q"), F.lit(p).alias("p"), F.col(k).alias("v")) for k, p in tx.QUANTILES.items()])))
    # Ranks of each value found: a few values per room type, met by a join on it and counted.
    prices = rows.where("price IS NOT NULL").groupBy("room_type", "price").agg(F.count("*").alias("c"))
    ranked = each.join(prices, "room_type").groupBy("room_type", "n", "q", "p", "v").agg(
        F.sum(F.when(F.col("price") < F.col("v"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("price") <= F.col("v"), F.col("c")).otherwise(0)).alias("up_to"),
    )
    slack = F.lit(2 * sketches.RANK_ERROR) * F.col("n") + 1
    near = (F.col("below") - slack <= F.col("p") * F.col("n")) & (F.col("up_to") + slack >= F.col("p") * F.col("n"))
    return ranked.select("room_type", "q", "n", near.alias("within"))


def _catalog_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Events loaded into a catalog table, some days twice, and asked for by day."""
    out, events = shared_dir(spark), saved(Tables(spark, folder)["behavior"])
    name = f"events_{out.rsplit('-', 1)[-1]}"
    writers.add_to_table(events, name, "date", f"{out}/{name}")
    writers.add_to_table(events.where("weekday <= 3"), name, "date")
    return tb.tb_daily(spark.table(name))


def _sinks(spark: SparkSession, folder: str) -> DataFrame:
    """Log as CSV, summary as JSON, a result as Parquet and CSV: written, read back, told as kind, key, value."""
    out = shared_dir(spark)
    writers.write_log(_cleaning_report(spark, folder), f"{out}/log")
    log = spark.read.csv(f"{out}/log", header=True).select(
        F.lit("log").alias("kind"), F.concat_ws("|", "数据集", "步骤", "清洗动作").alias("key"), F.col("剩余记录数").alias("value")
    )
    writers.write_summary(cb.behavior_summary(Tables(spark, folder)["behavior"]).select(F.struct("rows", "users").alias("taobao")), f"{out}/summary")
    told = readers.read_summary(spark, f"{out}/summary").select(
        F.inline(F.array(*[F.struct(F.lit("summary").alias("kind"), F.lit(k).alias("key"), F.col(f"taobao.{k}").cast("string").alias("value")) for k in ("rows", "users")]))
    )
    writers.write_result(_ask("tb_hourly", spark, folder), out, "tb_hourly", as_csv=True)
    result = readers.load_result(spark, out, "tb_hourly").select(F.lit("result").alias("kind"), F.col("小时").cast("string").alias("key"), F.col("pv量").cast("string").alias("value"))
    as_csv = spark.read.csv(f"{out}/csv/tb_hourly", header=True).select(F.lit("csv").alias("kind"), F.col("小时").alias("key"), F.col("购买量").alias("value"))
    return log.unionByName(told).unionByName(result).unionByName(as_csv)


def entry(spark: SparkSession) -> DataFrame:
    return _ask("tb_funnel", spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {
        "clean_behavior": lambda s, d: Tables(s, d)["behavior"],
        "behavior_summary": lambda s, d: cb.behavior_summary(Tables(s, d)["behavior"]),
        "clean_listings": lambda s, d: cl.clean_listings(tv.listings_raw(s, d)),
        "clean_listing_reviews": lambda s, d: cl.clean_listing_reviews(tv.listing_reviews_raw(s, d)),
        "listings_summary": _listings_summary,
        "clean_reviews": lambda s, d: ct.clean_reviews(tv.reviews_raw(s, d), *Tables(s, d).sentiment),
        "reviews_summary": lambda s, d: ct.reviews_summary(ct.unique_reviews(tv.reviews_raw(s, d))),
        "clean_comments": lambda s, d: ct.clean_comments(tv.comments_raw(s, d), *Tables(s, d).sentiment),
        "comments_summary": lambda s, d: ct.comments_summary(Tables(s, d)["comments"]),
        "sentiment_score": _sentiment_score,
        "sentiment_label": _sentiment_label,
        "sentiment_in_context": _sentiment_in_context,
        "sentiment_in_phrases": _sentiment_in_phrases,
        "cleaning_report": _cleaning_report,
        "cleaning_report_head": lambda s, d: audit.cleaning_report_head(_cleaning_report(s, d)),
        **{name: partial(_ask, name) for name in suite.QUESTIONS},
        "tb_intermediate_conv_same_day": lambda s, d: tb.tb_intermediate_conv(
            Tables(s, d)["behavior"], ("user_id", "date")
        ),
        **{name: partial(_figure, name) for name in suite.FIGURES},
        "day_span": lambda s, d: metrics.day_span(Tables(s, d)["behavior"]),
        "total_records": _total_records,
        "headline_metrics": _headline_metrics,
        "raw_csv_behavior": _raw_csv_behavior,
        "raw_csv_comments": _raw_csv_comments,
        "cleaned_layer": _cleaned_layer,
        "named_query_suite": _named_query_suite,
        "sketched_daily": _sketched_daily,
        "sketched_overview": _sketched_overview,
        "sketched_funnel": _sketched_funnel,
        "sketched_quantiles": _sketched_quantiles,
        "catalog_reload": _catalog_reload,
        "sinks_read_back": _sinks,
        **({**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle.all_queries(), **(llm.oracle_sql() if llm else {})}
