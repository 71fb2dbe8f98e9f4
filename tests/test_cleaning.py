"""The cleaners on hand-made rows: every rule, every edge."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest

from tallyhall.plans import (
    audit,
    behavior as tb,
    clean_behavior as cb,
    clean_listings as cl,
    clean_texts as ct,
    listings as ab,
    metrics,
    suite,
    texts as tx,
)
from tallyhall.operators.shares import multi_row_gate
from tallyhall.schemas import RAW, texts
from tallyhall.sources import readers, testviews as tv

LO, HI = cb.WINDOW


@pytest.fixture(scope="module")
def lexicon(spark):
    df = spark.createDataFrame([("good", "1.9"), ("bad", "-2.5")], "token string, v string")
    return df.selectExpr("token", "cast(v as decimal(4,1)) as valence")


def raw(spark, dataset, rows):
    return spark.createDataFrame(rows, texts(*RAW[dataset]))


@pytest.fixture(scope="module")
def events(spark):
    t = str(LO + 60)
    return raw(
        spark,
        "behavior",
        [
            ("1", "10", "5", "pv", t),
            ("1", "10", "3", "pv", t),  # the same event in another category
            ("1", "10", "3", "buy", t),
            ("2.0", "10", "3", "pv", str(LO)),  # a number with a fraction
            ("2", "11", "3", "pv", str(HI)),
            ("2", "11", "3", "pv", str(LO - 1)),
            ("2", "11", "3", "pv", str(HI + 1)),
            ("x", "11", "3", "pv", t),
            (None, "11", "3", "pv", t),
            ("3", "11", "3", None, t),
            ("3", "11", "3", "PV", t),
            ("3", "11", "3", "cart", "nan"),
        ],
    )


def test_clean_behavior(events):
    got = {tuple(r) for r in cb.clean_behavior(events).collect()}
    first = datetime(2017, 11, 25, 0, 1)
    assert got == {
        (1, 10, 3, "pv", first, "2017-11-25", 0, 6),
        (1, 10, 3, "buy", first, "2017-11-25", 0, 6),
        (2, 10, 3, "pv", datetime(2017, 11, 25), "2017-11-25", 0, 6),
        (2, 11, 3, "pv", datetime(2017, 12, 3, 23, 59, 59), "2017-12-03", 23, 7),
    }


def test_clean_behavior_ignores_the_session_zone(spark, events):
    expected = {tuple(r) for r in cb.clean_behavior(events).collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {tuple(r) for r in cb.clean_behavior(events).collect()} == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_behavior_log(events):
    rows = audit.behavior_log(events).orderBy("seq").collect()
    assert [r["剩余记录数"] for r in rows] == [12, 8, 7, 5, 4, 4]
    assert rows[4]["清洗动作"] == "剔除完全重复记录 1 条"


def listing(i, **changes):
    row = dict.fromkeys(RAW["listings"]) | {
        "id": str(i), "host_id": "7", "neighbourhood_cleansed": "A", "room_type": "R",
        "price": f"${i}.00", "availability_365": "73", "host_listings_count": "1",
    }
    return tuple((row | changes).values())


def test_clean_listings(spark):
    rows = [listing(i) for i in range(1, 101)]
    rows += [
        listing(201, price="$1,234.50", neighbourhood_cleansed=None),  # counts for the cap, then goes
        listing(202, price="$0.00"),
        listing(203, price=None),
        listing(204, price="free"),
        listing(205, price="-5"),
        listing(206, price=" $50.00 ", host_listings_count=None, availability_365=None),
        listing(207, price="50", host_listings_count="0"),
        listing(208, price="nan"),
    ]
    df = raw(spark, "listings", rows)
    prices = [*range(1, 101), 1234.5, 50, 50]
    cap = float(np.quantile(prices, 0.99))
    assert cl.price_cap(df).first()[0] == cap
    got = {r.id: r for r in cl.clean_listings(df).collect()}
    assert sorted(got) == [*range(1, 101), 206, 207]
    assert got[100].price_winsor == min(100.0, cap)
    assert (got[1].occupancy_ratio, got[206].occupancy_ratio) == (0.8, None)
    assert (got[206].host_listings_count, got[206].host_scale) == (1.0, "个人(1-2)")
    assert got[207].host_scale is None
    log = [r["剩余记录数"] for r in audit.listings_log(df).orderBy("seq").collect()]
    assert log == [108, 103, 103, 102]


def test_clean_listing_reviews(spark):
    rows = [
        ("5", "1", "2024-02-01", "long one"),
        ("4", "1", "2024-03-01", "x"),  # same id: the smaller listing stays
        ("4", "2", "2024-03-01", "zz"),
        ("4", "2", "2024-03-01", "y"),  # same listing and date: the shorter comment stays
        ("4", "3", "not a date", "x"),
        ("4", "4", "2024-01-01", ""),
        ("4", "5", "2024-01-01", None),
        ("4", "6", "2024-01-01", "nan"),
    ]
    df = raw(spark, "listing_reviews", rows)
    assert {tuple(r) for r in cl.clean_listing_reviews(df).collect()} == {
        (4, 1, date(2024, 3, 1), "x", 1),
        (4, 2, date(2024, 3, 1), "y", 1),
    }
    assert {tuple(r) for r in cl.clean_listing_reviews(df, with_text=False).collect()} == {
        (4, 1, date(2024, 3, 1), 1),
        (4, 2, date(2024, 3, 1), 1),
    }
    log = [r["剩余记录数"] for r in audit.listing_reviews_log(df).orderBy("seq").collect()]
    assert log == [8, 5, 3]


@pytest.fixture(scope="module")
def star_reviews(spark):
    return raw(
        spark,
        "reviews",
        [
            ("b1", "n", '"01/02/2020"', "5", "good food", "Elite", "r"),
            ("b1", "n", '"1/1/2020"', "4", "good food", None, None),  # copy with the earlier date
            ("b2", "n", '" 3/4/2021 "', "4.5", "good food", None, None),  # other business
            (None, "n", "3/4/2021", "1", "bad bad", None, None),
            (None, "n", "3/4/2021", "1", "bad bad", None, None),  # missing equals missing
            ("b3", "n", "31/02/2020", "3", "text", None, None),
            ("b3", "n", "2020-01-01", "3", "text", None, None),
            ("b3", "n", "1/1/2020", "0", "text", None, None),
            ("b3", "n", "1/1/2020", "5.1", "text", None, None),
            ("b3", "n", "1/1/2020", "three", "text", None, None),
            ("b3", "n", "1/1/2020", "3", "", None, None),
            ("b3", "n", "1/1/2020", "3", None, None, None),
        ],
    )


def test_clean_reviews(star_reviews, lexicon):
    rows = ct.clean_reviews(star_reviews, lexicon).collect()
    got = {r.business_id: r for r in rows}
    assert len(rows) == len(got) == 3
    one = got["b1"]
    assert (one.Date, one.Rating, one.elite_flag, one.Reactions) == (date(2020, 1, 1), 4.0, 0, None)
    assert (one.review_len, one.word_count, one.sentiment_label) == (9, 2, "正面")
    assert one.sentiment == round(1.9 / (1.9 * 1.9 + 15) ** 0.5, 6)
    assert (got["b2"].Date, got["b2"].Rating) == (date(2021, 4, 3), 4.5)
    assert got[None].sentiment == round(-5.0 / 40**0.5, 6)
    log = [r["剩余记录数"] for r in audit.reviews_log(star_reviews).orderBy("seq").collect()]
    assert log == [12, 10, 7, 3]
    summary = ct.reviews_summary(ct.unique_reviews(star_reviews)).first()
    assert tuple(summary) == (3, 2, 9.5 / 3)


@pytest.fixture(scope="module")
def community(spark):
    return raw(
        spark,
        "comments",
        [
            ("c1", "a good comment, long enough"),
            ("c1", "a bad shorter comment"),
            ("c2", "[deleted]"),
            ("c2", "this one was deleted once"),
            ("c3", "[removed]"),
            ("c4", None),
            ("c5", "exactly fifteen"),
            ("c6", "only fourteen!"),
            ("c7", "a long body with a short copy"),
            ("c7", "short"),  # the longest copy stays, so the id is not lost
            (None, "bad bad bad bad bad bad"),
            (None, "bad bad bad bad bad bad"),
        ],
    )


def test_clean_comments(community, lexicon):
    got = {r.comment_id: r for r in ct.clean_comments(community, lexicon).collect()}
    assert set(got) == {"c1", "c2", "c5", "c7", None}
    assert (got["c1"].body, got["c1"].sentiment_label) == ("a good comment, long enough", "正面")
    assert got["c7"].body == "a long body with a short copy"
    assert got[None].sentiment == round(-15.0 / 240**0.5, 6)
    narrow = {r.review_len: r.sentiment for r in ct.scored_comments(community, lexicon).collect()}
    assert narrow == {r.review_len: r.sentiment for r in got.values()}
    log = [r["剩余记录数"] for r in audit.comments_log(community).orderBy("seq").collect()]
    assert log == [12, 9, 6, 5]
    assert tuple(ct.comments_summary(ct.scored_comments(community, lexicon)).first()) == (5, 0.2)


def test_topics_before_and_after_cleaning_agree(community, lexicon):
    topics = {"t1": ["GOOD", "shorter"], "t2": ["bad"], "t3": ["nowhere"]}
    early = tx.topic_counts(ct.comment_topics(community, topics), topics).collect()
    late = tx.rd_pain_points(ct.clean_comments(community, lexicon), topics).collect()
    assert early == late
    assert {r["痛点主题"]: r["提及数"] for r in late} == {"t1": 1, "t2": 1, "t3": 0}


def test_empty_inputs(spark, lexicon):
    empty = {name: raw(spark, name, []) for name in RAW}
    report = audit.cleaning_report(empty).collect()
    assert [r["剩余记录数"] for r in report] == [0] * 21
    behavior = cb.clean_behavior(empty["behavior"])
    assert [r["用户数"] for r in tb.tb_funnel(behavior).collect()] == [0, 0, 0, 0]
    assert tb.tb_user_activity_tier(behavior).count() == 0
    assert tb.tb_intermediate_conv(behavior).first()["收藏转购买率pct"] is None
    listings = readers.for_analysis(cl.clean_listings(empty["listings"]), "listings")
    assert ab.ab_host_concentration(listings).first()[0] is None
    assert ab.ab_top_revenue_profile(listings).count() == 0
    assert ct.clean_comments(empty["comments"], lexicon).count() == 0


def events_of(spark, rows):
    return spark.createDataFrame(
        rows, "user_id long, item_id long, category_id long, behavior_type string, date string"
    )


def test_purchase_bands_reach_the_last(spark):
    rows = [(u, i, 1, "buy", "2024-01-01") for u, n in enumerate([1, 2, 3, 5, 6, 9]) for i in range(n)]
    got = {r["购买频次分层"]: (r["用户数"], r["占比pct"]) for r in tb.tb_repurchase(events_of(spark, rows)).collect()}
    assert got == {
        "1次": (1, 100 / 6), "2次": (1, 100 / 6), "3-5次": (2, 200 / 6), "6次及以上": (2, 200 / 6),
    }


def test_retention_and_same_day_conversion(spark):
    rows = [
        (1, 1, 1, "fav", "2024-01-01"),
        (1, 1, 1, "buy", "2024-01-03"),
        (2, 1, 1, "fav", "2024-01-01"),
        (2, 1, 1, "buy", "2024-01-01"),
    ]
    df = events_of(spark, rows)
    assert tb.tb_intermediate_conv(df).first()[0] == 100.0
    assert tb.tb_intermediate_conv(df, ("user_id", "date")).first()[0] == 50.0
    got = {(r.cohort, r.day_offset): (r.users, r.retention_pct) for r in tb.retention_by_day(df).collect()}
    assert got == {("2024-01-01", 0): (2, 100.0), ("2024-01-01", 2): (1, 50.0)}


def test_review_bands_reach_the_last(spark):
    rows = [(n, 10.0) for n in (0, 1, 10, 11, 50, 51, 200, 201)]
    df = spark.createDataFrame(rows, "number_of_reviews long, price_winsor double")
    got = [(r["评论数档"], r["房源数"]) for r in ab.ab_price_by_reviews(df).collect()]
    assert got == [("0条", 1), ("1-10条", 2), ("11-50条", 2), ("51-200条", 2), ("200条以上", 1)]


def test_quadrants_and_gate(spark):
    rows = [(1, 100, 9.0), (2, 10, 9.0), (3, 100, 1.0), (4, 10, 1.0)]
    df = spark.createDataFrame(rows, "`类目ID` long, `浏览量` long, `购买转化率pct` double")
    got = {r["类目ID"]: r["象限"] for r in metrics.category_quadrants(df).collect()}
    assert got == {1: "明星类目", 2: "流量洼地", 3: "优化详情页", 4: "低效类目"}
    assert multi_row_gate(df).count() == 4
    assert multi_row_gate(df.limit(1)).count() == 0


def test_the_price_cap_is_found_once(spark, tmp_path, monkeypatch):
    """Cleaning, log and summary share it; the digits are computed once a row."""
    asked, price_cap = [], cl.price_cap

    def counted(raw):
        asked.append(price_cap(raw)._jdf.queryExecution().optimizedPlan().toString())
        return price_cap(raw)

    monkeypatch.setattr(cl, "price_cap", counted)
    raw = tv.raw_inputs(spark, "/root/testdata/sf0.001")
    suite.run_cleaning(raw, tv.lexicon(spark), str(tmp_path), suite.Settings(window=tv.EVENT_WINDOW))
    assert len(asked) == 1 and asked[0].count("replace(replace(") == 2  # exact_quantiles reads its input twice
