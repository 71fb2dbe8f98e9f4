"""Files in, files out."""

from __future__ import annotations

import gzip
from datetime import date

import pytest

import __spark_entry__ as entry
from tallyhall import job
from tallyhall.plans import suite
from tallyhall.schemas import RAW
from tallyhall.sources import readers, testviews as tv, writers

FOLDER = "/root/testdata/sf0.001"


def test_headerless_events(spark, tmp_path):
    (tmp_path / "e.csv").write_text("1,2,3,pv,1511539200\n4,NA,,buy,x\n", encoding="utf-8")
    rows = readers.read_behavior_csv(spark, str(tmp_path / "e.csv")).collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3", "pv", "1511539200"), ("4", None, None, "buy", "x")]
    kept = readers.read_behavior_csv(spark, str(tmp_path / "e.csv"), na_tokens=()).collect()
    assert kept[1].item_id == "NA"


def test_gzip_text_with_line_breaks_and_quotes(spark, tmp_path):
    text = 'extra,id,comments,listing_id,date\nx,1,"two\nlines, and ""quotes""",9,2024-01-01\ny,2,None,9,2024-01-02\n'
    path = tmp_path / "r.csv.gz"
    path.write_bytes(gzip.compress(text.encode()))
    df = readers.read_csv(spark, str(path), "listing_reviews", partitions=3)
    assert df.columns == list(RAW["listing_reviews"])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("9", "1", "2024-01-01", 'two\nlines, and "quotes"'), ("9", "2", "2024-01-02", None)]


def test_byte_order_mark_in_header(spark, tmp_path):
    (tmp_path / "c.csv").write_text("comment_id,comment_body\n1,hello\n", encoding="utf-8-sig")
    rows = readers.read_csv(spark, str(tmp_path / "c.csv"), "comments").collect()
    assert [tuple(r) for r in rows] == [("1", "hello")]


def test_several_files_must_agree_in_their_headers(spark, tmp_path):
    """Files are never read by place: a header in another order is an error, not a swap."""
    (tmp_path / "a.csv").write_text("comment_id,comment_body\n1,first body\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("comment_id,comment_body\n2,second body\n", encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path), "comments").collect()
    assert sorted(map(tuple, rows)) == [("1", "first body"), ("2", "second body")]
    (tmp_path / "b.csv").write_text("comment_body,comment_id\nsecond body,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path), "comments").collect()


def test_modifier_file_and_fine_valences(spark, tmp_path):
    (tmp_path / "m.txt").write_text("Very\t1\nhardly\t-1\nnot\t0\nodd\t7\n", encoding="utf-8")
    assert {tuple(r) for r in readers.read_modifiers(spark, str(tmp_path / "m.txt")).collect()} == {("very", 1), ("hardly", -1), ("not", 0)}
    (tmp_path / "l.txt").write_text("good\t1.925\nhuge\t1234.5\n", encoding="utf-8")
    rows = readers.read_lexicon(spark, str(tmp_path / "l.txt")).collect()
    assert {(r.token, float(r.valence)) for r in rows} == {("good", 1.925), ("huge", 1234.5)}
    (tmp_path / "l.txt").write_text("good\t1.92512345\n", encoding="utf-8")
    with pytest.raises(Exception, match="valence"):
        readers.read_lexicon(spark, str(tmp_path / "l.txt")).collect()


def test_a_failing_question_is_named(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    suite.run_cleaning(tv.raw_inputs(spark, FOLDER), tv.lexicon(spark), out, entry.SETTINGS)
    asked = {"tb_hourly": suite.QUESTIONS["tb_hourly"], "broken": lambda t, s: t["behavior"].select("no such column")}
    monkeypatch.setattr(suite, "QUESTIONS", asked)
    with pytest.raises(RuntimeError, match="question broken failed; answered: tb_hourly"):
        suite.run_questions(spark, f"{out}/cleaned", f"{out}/tables", entry.SETTINGS, at_once=1)


def test_lexicon_file(spark, tmp_path):
    (tmp_path / "l.txt").write_text("good\t1.9\t0.9\t[2, 2]\n:'(\t-2.2\t1\t[]\nbroken\tx\t1\t[]\n", encoding="utf-8")
    rows = readers.read_lexicon(spark, str(tmp_path / "l.txt")).collect()
    assert {(r.token, float(r.valence)) for r in rows} == {("good", 1.9), (":'(", -2.2)}


def test_raw_files_clean_like_the_tables(spark, tmp_path):
    """Every dataset written as its raw file, read back and cleaned, equals the direct way."""
    raw = tv.raw_inputs(spark, FOLDER)
    paths = {name: str(tmp_path / name) for name in raw}
    for name, df in raw.items():
        if name == "behavior":
            df.write.csv(paths[name], header=False)
        else:
            writers.write_cleaned_csv(df, paths[name])
    words = (tv.lexicon(spark), entry.SETTINGS, tv.modifiers(spark))
    direct = suite.clean_all(raw, *words)
    again = suite.clean_all(readers.read_raw(spark, paths, partitions=2), *words)
    for name in raw:
        assert direct[name].exceptAll(again[name]).count() == 0, name
        assert again[name].exceptAll(direct[name]).count() == 0, name


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "run")
    raw = tv.raw_inputs(spark, FOLDER)
    cleaned = suite.run_cleaning(raw, tv.lexicon(spark), out, entry.SETTINGS)
    behavior = cleaned["behavior"]
    assert dict(behavior.dtypes)["date"] == "string"
    assert behavior.columns != [] and set(behavior.columns) >= {"user_id", "datetime", "weekday"}
    narrow = readers.load_table(spark, f"{out}/cleaned", "behavior", ["user_id", "date"])
    assert narrow.columns == ["user_id", "date"]

    listings = readers.load_analysis(spark, f"{out}/cleaned", "listings")
    assert listings.columns == list(readers.ANALYSIS_COLUMNS["listings"])
    reviews = readers.load_analysis(spark, f"{out}/cleaned", "reviews")
    assert dict(reviews.dtypes)["review_date"] == "date"

    log = spark.read.csv(f"{out}/cleaning_report", header=True).collect()
    assert len(log) == 21
    left = None
    for r in log:  # counts never rise within one chain
        n = int(r["剩余记录数"])
        assert r["步骤"] == "原始数据" or n <= left
        left = n

    report = suite.run_questions(spark, f"{out}/cleaned", f"{out}/tables", entry.SETTINGS).collect()
    assert [r.name for r in report] == list(suite.QUESTIONS)
    for r in report:
        assert readers.load_result(spark, f"{out}/tables", r.name).count() == r.rows

    summary = readers.read_summary(spark, f"{out}/summary").first()
    assert summary.taobao.rows == behavior.count()
    assert summary.airbnb.listings == listings.count()
    assert summary.yelp.rows == reviews.count()
    assert date.fromisoformat(summary.airbnb.review_date_max)

    # Shares add up, stages stay within all users.
    users = readers.load_result(spark, f"{out}/tables", "tb_overview").first()["活跃用户数"]
    for r in readers.load_result(spark, f"{out}/tables", "tb_funnel").collect():
        assert r["用户数"] <= users
    for name in ("tb_repurchase", "ab_room_type", "rd_sentiment_dist", "yp_rating_dist"):
        result = readers.load_result(spark, f"{out}/tables", name)
        share = next(c for c in result.columns if c.endswith("占比pct"))
        assert abs(sum(r[share] for r in result.collect()) - 100) < 1e-9
    names = suite.run_figures(spark, f"{out}/tables", entry.SETTINGS)
    assert set(names) == set(suite.FIGURES) | {"headline_metrics"}
    figures = {r.metric: r.value for r in readers.load_result(spark, f"{out}/tables", "headline_metrics").collect()}
    assert (len(figures), figures["active_users"]) == (40, users)
    # Views answer SQL.
    assert spark.sql("SELECT count(*) FROM behavior").first()[0] == behavior.count()


def test_results_as_csv_and_overwriting(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")
    out = str(tmp_path)
    assert writers.write_result(df, out, "r", as_csv=True) == 2
    assert writers.write_result(df.limit(1), out, "r") == 1
    assert readers.load_result(spark, out, "r").count() == 1
    assert spark.read.csv(f"{out}/csv/r", header=True).count() == 2


def test_job_from_files(spark, tmp_path):
    """The job on raw files under their usual names answers like the tables do."""
    raw_dir, out = tmp_path / "raw", str(tmp_path / "out")
    raw = tv.raw_inputs(spark, FOLDER)
    for name, file in job.FILES.items():
        if name == "behavior":
            raw[name].write.csv(str(raw_dir / file), header=False)
        else:
            writers.write_cleaned_csv(raw[name], str(raw_dir / file))
    lexicon = tmp_path / "lexicon.txt"
    lexicon.write_text("".join(f"{t}\t{v}\n" for t, v in tv.LEXICON.items()), encoding="utf-8")
    modifiers = tmp_path / "modifiers.txt"
    modifiers.write_text("".join(f"{t}\t{k}\n" for t, k in tv.MODIFIERS.items()), encoding="utf-8")
    job.run(spark, str(raw_dir), out, str(lexicon), entry.SETTINGS, partitions=4, modifiers_path=str(modifiers))
    for name in ("tb_funnel", "ab_host_scale", "yp_rating_dist", "rd_pain_points"):
        expected = entry.queries()[name](spark, FOLDER)
        got = readers.load_result(spark, f"{out}/tables", name)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert spark.read.csv(f"{out}/run_report", header=True).count() == len(suite.QUESTIONS)
