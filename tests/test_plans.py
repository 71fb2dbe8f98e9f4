"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tallyhall.plans import behavior as tb
from tallyhall.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"
LLM = {*entry.llm.queries(), "pipeline"} if entry.llm else set()  # looked at in tests/llm
QUERIES = {k: q for k, q in entry.queries().items() if k != "named_query_suite" and k not in LLM}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "RDDScan"):
        assert word not in plan


def test_saved_events_are_pruned_and_filtered_in_the_scan(spark, tmp_path):
    out = str(tmp_path)
    writers.write_cleaned(entry.Tables(spark, FOLDER)["behavior"], out, "behavior")
    df = readers.load_analysis(spark, out, "behavior")
    plan = plan_of(tb.tb_repurchase(df))
    assert "PushedFilters: [IsNotNull(behavior_type), EqualTo(behavior_type,buy)]" in plan
    assert "ReadSchema: struct<user_id:bigint,behavior_type:string>" in plan
    one_day = plan_of(df.where("date = '2024-01-05'").groupBy("hour").count())
    assert "PartitionFilters: [isnotnull(date" in one_day


def shuffled_columns(df) -> set[str]:
    """Names of all columns and struct fields that pass through an exchange."""
    names, todo = set(), [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if "Exchange" in node.nodeName():
            names |= set(re.findall(r"(\w+):", node.schema().simpleString()))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return names


TEXT = {"body", "Content", "text", "comments"}


@pytest.mark.parametrize(
    "name",
    [
        "rd_sentiment_dist", "rd_len_vs_sentiment", "rd_pain_points", "comments_summary",
        "ab_review_month_of_year", "listing_review_activity", "sentiment_score",
    ],
)
def test_texts_are_not_shuffled(spark, name):
    assert not shuffled_columns(QUERIES[name](spark, FOLDER)) & TEXT


def test_reviews_do_not_shuffle_their_text(spark, tmp_path):
    """Reviews from a file (the test view itself joins its two tables)."""
    from tallyhall.plans import clean_texts as ct
    from tallyhall.sources import testviews as tv

    path = str(tmp_path / "reviews")
    tv.reviews_raw(spark, FOLDER).write.parquet(path)
    raw = spark.read.parquet(path)
    assert not shuffled_columns(ct.clean_reviews(raw, tv.lexicon(spark))) & TEXT
    assert not shuffled_columns(ct.unique_reviews(raw)) & TEXT


def test_the_text_check_can_fail(spark):
    assert shuffled_columns(QUERIES["clean_comments"](spark, FOLDER)) & TEXT == {"body"}


def test_top_items_limit_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["top_items_per_category"](spark, FOLDER))


def test_comments_are_kept_without_sorting_texts(spark):
    """Winners are found by hashing fixed-width ranks; the text only meets them."""
    for name in ("rd_sentiment_dist", "rd_pain_points", "clean_comments"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["rfm_segments", "ab_top_revenue_profile"])
def test_tiles_do_not_shuffle_rows(spark, name):
    """With broadcasts by size switched off, as for big inputs, no join for tiles moves rows by block or value."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"(SortMergeJoin|ShuffledHashJoin) \[(\w+)#", plan)
    assert not [key for _, key in joins if key in ("_b", "_v", "_s")]
