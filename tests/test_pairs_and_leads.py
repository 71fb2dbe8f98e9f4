"""Goods viewed together and the lead of supply over demand, against plain versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyhall.plans import listings, paths

VIEW = "user_id long, item_id long, behavior_type string"
REVIEW = "listing_id long, date date"


def plain_pairs(rows, least):
    users, sizes, both = {}, Counter(), Counter()
    for u, i, k in rows:
        if k == "pv" and u is not None and i is not None:
            users.setdefault(u, set()).add(i)
    for items in users.values():
        sizes.update(items)
        both.update(combinations(sorted(items), 2))
    return {(a, b, n, sizes[a], sizes[b]) for (a, b), n in both.items() if n >= least}, len(users)


def random_views(n, users, items, seed):
    """A third of all rows are one user's, a third one item's; nulls, other kinds, repeated rows."""
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        u = 0 if pick.random() < 0.33 else pick.randrange(users)
        i = 0 if pick.random() < 0.33 else pick.randrange(items)
        rows.append((u, i, pick.choice(["pv", "pv", "pv", "buy"])))
    return rows + rows[: n // 10] + [(None, 1, "pv"), (1, None, "pv"), (None, None, "pv"), (2, 2, None)]


@pytest.mark.parametrize("n, users, items, least", [(600, 40, 25, 2), (600, 40, 25, 3), (900, 15, 60, 6), (400, 400, 5, 2), (30, 3, 3, 4)])
def test_viewed_together(spark, n, users, items, least):
    rows = random_views(n, users, items, n + least)
    found = paths.viewed_together(paths.views_of(spark.createDataFrame(rows, VIEW)), least).collect()
    wanted, _ = plain_pairs(rows, least)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_report_of_pairs_with_ties(spark):
    rows = [(u, i, "pv") for u in range(8) for i in range(6) if (u + i) % 2] + [(99, 77, "pv")]
    wanted, users = plain_pairs(rows, 2)
    ranked = sorted(((a, b, n, n * users / (x * y)) for a, b, n, x, y in wanted), key=lambda r: (-r[3], -r[2], r[0], r[1]))
    assert [tuple(r) for r in paths.goods_viewed_together(spark.createDataFrame(rows, VIEW), 2, 4).collect()] == ranked[:4]


def test_no_views(spark):
    assert paths.goods_viewed_together(spark.createDataFrame([], VIEW)).collect() == []
    assert paths.goods_viewed_together(spark.createDataFrame([(1, 1, "pv"), (1, 2, "pv")], VIEW)).collect() == []
    with pytest.raises(ValueError, match="least"):
        paths.viewed_together(paths.views_of(spark.createDataFrame([], VIEW)), 1)


def test_a_hot_user_does_not_square(spark, monkeypatch):
    """One user who viewed every item: of its 2,000 items none keeps it, so none of its two million pairs is made."""
    rows = [(0, i, "pv") for i in range(2000)] + [(1 + i // 2, i, "pv") for i in range(2000)]
    kept = []
    original = paths.saved
    monkeypatch.setattr(paths, "saved", lambda df: kept.append(original(df)) or kept[-1])
    found = paths.viewed_together(paths.views_of(spark.createDataFrame(rows, VIEW)), 2)
    assert found.count() == 1000 and found.where("item_b = item_a + 1 AND users = 2").count() == 1000
    edges = kept[-1]
    assert edges.count() == 2000 and edges.where("user_id = 0").count() == 0


def test_the_rank_of_users_is_cut_before_the_shuffle(spark, tmp_path, monkeypatch):
    plans = []
    original = paths.saved
    monkeypatch.setattr(paths, "saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or original(df))
    entry._ask("goods_viewed_together", spark, "/root/testdata/sf0.001")
    assert "WindowGroupLimit" in plans[-1]


def plain_leads(rows, since, lags):
    months = [(i, d.year * 12 + d.month) for i, d in rows if i is not None and d is not None]
    firsts = Counter({})
    for i in {i for i, _ in months}:
        firsts[min(m for j, m in months if j == i)] += 1
    begin = since.year * 12 + since.month
    there = [m for _, m in months if m >= begin]
    if not there:
        return {}
    span = range(min(there), max(there) + 1)
    written = Counter(m for _, m in months)
    out = {}
    for lag in lags:
        pairs = [(firsts[m], written[m + lag]) for m in span if m + lag in span]
        if pairs:
            x, y = np.array(pairs, float).T
            out[lag] = (len(pairs), np.corrcoef(x, y)[0, 1] if x.std() and y.std() else None)
    return out


@pytest.mark.parametrize("n, listings_, years", [(400, 60, 3), (60, 30, 5), (5, 5, 1), (1, 1, 1), (0, 1, 1)])
def test_season_lead(spark, n, listings_, years):
    """Months without any review, listings first seen before the first month, a listing with a third of all reviews, nulls."""
    pick = random.Random(n)
    rows = [
        (0 if pick.random() < 0.33 else pick.randrange(listings_), date(2018 + pick.randrange(years + 1), pick.choice([1, 2, 5, 7, 8, 12]), 3))
        for _ in range(n)
    ] + [(None, date(2019, 4, 1)), (3, None)]
    since, lags = date(2018, 6, 15), (0, 1, 2, 5)
    found = listings.season_lead(spark.createDataFrame(rows, REVIEW), since.isoformat(), lags).collect()
    wanted = plain_leads(rows, since, lags)
    assert {r[0]: r[1] for r in found} == {k: c for k, (c, _) in wanted.items()}
    for lag, _, r in found:
        assert (r is None and wanted[lag][1] is None) or r == pytest.approx(wanted[lag][1])


def test_a_planted_lead_is_found(spark):
    """Each listing is reviewed once when new, and ten times two months later."""
    pick = random.Random(5)
    rows, listing = [], 0
    for m in range(48):
        for _ in range(pick.randrange(1, 20)):
            listing += 1
            for later, times in ((0, 1), (2, 10)):
                rows += [(listing, date(2019 + (m + later) // 12, (m + later) % 12 + 1, 1))] * times
    found = listings.season_lead(spark.createDataFrame(rows, REVIEW))
    best = found.orderBy(F.desc("相关系数")).first()
    assert best["提前月数"] == 2 and best["相关系数"] > 0.9
