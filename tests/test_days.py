"""Loads by day, sketches that merge, runs that go on where they broke off, and the order of events."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyhall.operators import sketches
from tallyhall.plans import daily, paths, suite
from tallyhall.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"
EVENT = "user_id long, item_id long, category_id long, behavior_type string, datetime timestamp_ntz, date string"


def events(spark, rows):
    """rows: (user, item, kind, seconds since 2024-01-01)."""
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    return spark.createDataFrame([(u, i, i % 3, k, at(s), at(s).date().isoformat()) for u, i, k, s in rows], EVENT)


def random_events(n, users, seed, span=4 * 86400):
    pick = random.Random(seed)
    # A third of all events are the first user's.
    return [(0 if pick.random() < 0.33 else pick.randrange(users), pick.randrange(12), pick.choice(["pv", "pv", "pv", "fav", "cart", "buy"]),
             pick.randrange(span)) for _ in range(n)]


def test_a_day_is_added_without_touching_others(spark, tmp_path):
    out = str(tmp_path)
    rows = events(spark, random_events(3000, 400, 1)).cache()
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    days = sorted(r[0] for r in rows.select("date").distinct().collect())
    daily.add_days(rows.where(F.col("date") < days[-1]), out)
    before = files()
    daily.add_days(rows.where(F.col("date") == days[-1]), out)
    assert before.items() <= files().items() and len(files()) > len(before)
    twice = lambda: sorted(map(tuple, daily.daily(daily.load_days(spark, out)).collect()))
    whole = sorted(map(tuple, daily.daily(daily.by_day(rows)).collect()))
    assert twice() == whole and len(whole) == 4
    daily.add_days(rows.where(F.col("date") == days[-1]), out)  # the same load again
    assert twice() == whole


def test_distinct_error(spark):
    """Merged over forty parts, 200,000 distinct values are told within five standard errors; missing values do not count."""
    parts = spark.range(400_000).selectExpr("id % 200000 AS v", "id % 40 AS part").unionByName(spark.sql("SELECT CAST(NULL AS long) AS v, 1 AS part"))
    one = parts.groupBy("part").agg(sketches.distinct_sketch("v").alias("s")).agg(sketches.estimate(sketches.merged("s"))).first()[0]
    assert abs(one - 200_000) <= 5 * sketches.DISTINCT_ERROR * 200_000
    assert parts.where("false").agg(sketches.estimate(sketches.distinct_sketch("v"))).first()[0] == 0


@pytest.mark.parametrize("kind", ["id", "id % 7", "pow(id, 3)", "if(id % 3 = 0, 5, id)"])
def test_quantile_rank_error(spark, kind):
    n, probs = 200_000, {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}
    df = spark.range(n).selectExpr(f"CAST({kind} AS double) AS v", "id % 30 AS part", "id % 2 AS g").unionByName(
        spark.sql("SELECT double('NaN') AS v, 0 AS part, 0 AS g UNION ALL SELECT NULL, 0, 5")
    )
    found = {r.g: r for r in sketches.quantiles(sketches.quantile_sketches(df, "v", ["part", "g"]), probs, ["g"]).collect()}
    assert set(found) == {0, 1} and found[0].n == found[1].n == n // 2
    for g, row in found.items():
        own = sorted(r.v for r in df.where(f"g = {g} AND v IS NOT NULL AND NOT isnan(v)").collect())
        for name, p in probs.items():
            below, up_to = sum(x < row[name] for x in own), sum(x <= row[name] for x in own)
            slack = sketches.RANK_ERROR * len(own) + 1
            assert below - slack <= p * len(own) <= up_to + slack, (name, row[name])


def test_sketches_of_nothing(spark):
    empty = events(spark, [])
    assert [r["用户数约"] for r in daily.funnel(daily.by_day(empty)).collect()] == [0, 0, 0, 0]
    assert tuple(daily.overview(daily.by_day(empty)).first()) == (0, 0, 0, 0)
    assert sketches.quantiles(sketches.quantile_sketches(empty, "item_id"), {"m": 0.5}).collect() == []


def test_loading_the_same_day_twice(spark, tmp_path):
    rows, table = events(spark, random_events(500, 20, 2)).cache(), "loaded_days"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    count = lambda: {r[0]: r[1] for r in spark.table(table).groupBy("date").count().collect()}
    writers.add_to_table(rows, table, "date", str(tmp_path / "t"))
    whole = count()
    assert sum(whole.values()) == 500 and len(whole) == 4
    writers.add_to_table(rows.where("date = '2024-01-02'"), table, "date")
    assert count() == whole
    shuffled = rows.where("date = '2024-01-03'").limit(5).select("date", *[c for c in rows.columns if c != "date"])
    writers.add_to_table(shuffled, table, "date")  # columns by name; a corrected day replaces the old one
    assert count() == whole | {"2024-01-03": 5}
    assert spark.table(table).where("date = '2024-01-03'").select(*rows.columns).exceptAll(rows).count() == 0
    with pytest.raises(ValueError, match="extra"):
        writers.add_to_table(rows.withColumn("extra", F.lit(1)), table, "date")
    assert spark.conf.get(writers.OVERWRITE_MODE).lower() == "static"
    spark.sql(f"DROP TABLE {table}")


def test_a_run_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    tables = entry.Tables(spark, FOLDER)
    for name in ("behavior", "listings", "listing_reviews", "reviews", "comments"):
        writers.write_cleaned(events(spark, random_events(50, 5, 3)) if name == "behavior" else tables["behavior"].limit(1), out, name)
    asked = []

    def question(name, fails=False):
        def ask(t, s):
            asked.append(name)
            if fails and len([a for a in asked if a == name]) == 1:
                raise ValueError("broken")
            return t["behavior"].groupBy("user_id").count()

        return ask

    monkeypatch.setattr(readers, "for_analysis", lambda df, table: df)
    monkeypatch.setattr(suite, "QUESTIONS", {n: question(n, n == "third") for n in ("first", "second", "third", "fourth")})
    with pytest.raises(RuntimeError, match="question third failed; answered: first, second"):
        suite.run_questions(spark, out, f"{out}/r", at_once=1, run="monday")
    report = suite.run_questions(spark, out, f"{out}/r", at_once=1, run="monday").collect()
    assert Counter(asked)["first"] == Counter(asked)["second"] == 1 and Counter(asked)["third"] == 2
    assert [(r.seq, r.name, r.rows) for r in report] == [(n, q, 5) for n, q in enumerate(suite.QUESTIONS, 1)]
    suite.run_questions(spark, out, f"{out}/r", at_once=1, run="tuesday")
    assert Counter(asked)["first"] == 2  # another run asks all again


def plain_sessions(rows, gap, longest):
    out, by_user = {}, {}
    for u, _, k, s in rows:
        by_user.setdefault(u, []).append((s, k))
    for u, own in by_user.items():
        last = start = None
        for s, k in sorted(own):
            if last is None or s - last > gap:
                start = s
            last = s
            out.setdefault((u, start, (s - start) // longest), []).append((s, k))
    found = []
    for key, own in out.items():
        buy = min((s for s, k in own if k == "buy"), default=None)
        found.append((*key, len(own), buy, None if buy is None else sum(s < buy for s, _ in own)))
    return sorted(found, key=str)


@pytest.mark.parametrize("n, users, gap, longest", [(800, 6, 1800, 43200), (2000, 3, 1800, 7200), (300, 40, 7200, 5000), (1, 1, 1800, 43200), (0, 1, 1800, 43200)])
def test_sessions(spark, n, users, gap, longest):
    """Sessions that cross hours and days, long ones cut, events of the same second, a user with a third of all."""
    rows = random_events(n, users, n + gap)
    rows += rows[: n // 10]
    epoch = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds())
    found = [
        (r.user_id, r.start - epoch, r.part, r.steps, None if r.first_buy is None else r.first_buy - epoch, r.steps_before)
        for r in paths.sessions(events(spark, rows), gap, longest).collect()
    ]
    assert sorted(found, key=str) == plain_sessions(rows, gap, longest)


def test_recall_window(spark):
    rows = random_events(1500, 10, 5, span=12 * 86400)
    wanted = Counter()
    for u, i, k, s in rows:
        if k in ("fav", "cart"):
            later = [b for v, j, kind, b in rows if (v, j, kind) == (u, i, "buy") and b >= s]
            wanted[k, min(later) // 86400 - s // 86400 if later else None] += 1
    found = {(r["行为"], r["等待天数"]): (r["次数"], r["占比pct"]) for r in paths.recall_window(events(spark, rows)).collect()}
    assert {k: n for k, (n, _) in found.items()} == wanted
    assert sum(p for (kind, _), (_, p) in found.items() if kind == "fav") == pytest.approx(100)
