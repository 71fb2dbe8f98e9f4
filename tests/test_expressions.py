from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyhall.functions import numbers as nb, text as tx
from tallyhall.operators.sentiment import label, score, valence_sums
from tallyhall.plans.clean_listings import HOST_SCALES
from tallyhall.plans.listings import RATING_BANDS


def column(spark, values, kind, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.orderBy("i").select(*[e.alias(f"c{n}") for n, e in enumerate(exprs)]).collect()
    return [r[0] if len(exprs) == 1 else tuple(r) for r in rows]


def test_numbers_from_text(spark):
    texts = ["12", " 12 ", "12.9", "-3", "1e3", "abc", "", "nan", "inf", "12d", None, "99999999999999999999"]
    assert column(spark, texts, "string", nb.to_long("x")) == [
        12, 12, 12, -3, 1000, None, None, None, None, None, None, None,
    ]
    assert column(spark, texts[:11], "string", nb.to_double("x")) == [
        12.0, 12.0, 12.9, -3.0, 1000.0, None, None, None, None, None, None,
    ]


def test_right_closed_bands(spark):
    values = [-1.0, 0.0, 0.5, 2.0, 2.5, 10.0, 50.0, 51.0, 1e6, 1e6 + 1, None]
    got = column(spark, values, "double", nb.cut_right(F.col("x"), 0, HOST_SCALES))
    small, mid, big, huge = (name for _, name in HOST_SCALES)
    assert got == [None, None, small, small, mid, mid, big, huge, huge, None, None]


def test_left_closed_bands(spark):
    values = [3.9, 4.0, 4.5, 4.79, 4.8, 5.0, None]
    got = column(spark, values, "double", nb.cut_left(F.col("x"), RATING_BANDS))
    assert got == ["4.0以下", "4.0-4.5", "4.5-4.8", "4.5-4.8", "4.8-5.0", "4.8-5.0", None]


def test_sentiment_label_edges(spark):
    values = [-1.0, -0.05, -0.0499, 0.0, 0.05, 0.0501, 1.0, None]
    got = column(spark, values, "double", label(F.col("x")))
    assert got == ["负面", "负面", "中性", "中性", "中性", "正面", "正面", None]


def test_words_and_blanks_follow_python(spark):
    texts = ["a b", "  a\tb\n", "a b　c d", "", "   ", "a\x1cb\x1fc", "\u0085x", "a😀b c"]
    got = column(spark, texts, "string", tx.word_count(F.col("x")), tx.strip(F.col("x")), F.length("x"))
    assert got == [(len(t.split()), t.strip(), len(t)) for t in texts]
    assert set(tx.BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_text_key_tells_owner_and_text_apart(spark):
    pairs = [("a", "1b"), ("a1", "b"), (None, "a1b"), ("", "a1b"), ("1:a", "b"), ("1", ":ab"), ("a", "1b")]
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "o string, t string, i int")
    keys = [r[0] for r in df.orderBy("i").select(tx.text_key(F.col("o"), F.col("t"))).collect()]
    assert keys[0] == keys[-1]
    assert len(set(keys)) == len(pairs) - 1


def test_percentages_and_means(spark):
    df = spark.createDataFrame([(1.1, 0), (2.2, 0), (None, 0)], "x double, z int")
    row = df.agg(nb.mean(F.col("x")), nb.pct(F.sum("x"), F.sum("z")), nb.mean(F.col("z"))).first()
    assert tuple(row) == (1.65, None, 0.0)
    empty = df.where("x > 9").agg(nb.mean(F.col("x"))).first()
    assert empty[0] is None


def test_ordinal(spark):
    assert column(spark, ["b", "a", "z", None], "string", nb.ordinal(F.col("x"), ["a", "b"])) == [2, 1, None, None]


@pytest.mark.parametrize("copies", [1, 3])
def test_valence_counts_one_copy_of_each_text(spark, copies):
    lexicon = spark.createDataFrame([("good", "1.9"), ("bad", "-2.5")], "token string, v string")
    lexicon = lexicon.selectExpr("token", "cast(v as decimal(4,1)) as valence")
    texts = [("a", "Good, GOOD bad!"), ("b", "nothing here"), ("c", ""), ("d", "bad")] * copies
    df = spark.createDataFrame(texts, "k string, t string")
    got = {r.k: r.valence for r in valence_sums(df, ["k"], "t", lexicon).collect()}
    assert got == {"a": 1.3, "b": 0.0, "c": 0.0, "d": -2.5}
    s = column(spark, [1.3, 0.0], "double", score(F.col("x")))
    assert s == [1.3 / (1.3 * 1.3 + 15) ** 0.5, 0.0]


@pytest.mark.parametrize(
    "text, value",
    [("5e12", 5e12), ("1e39", 1e39), (" 1.5 ", 1.5), ("-.5", -0.5), ("nan", None), ("inf", None), ("-Infinity", None), ("12d", None), ("1f", None), ("x", None), ("", None), ("1e999", None)],
)
def test_numbers_of_any_size(spark, text, value):
    from tallyhall.functions.numbers import to_double

    assert spark.createDataFrame([(text,)], "t string").select(to_double("t")).first()[0] == value


def test_means_have_no_cap(spark):
    from tallyhall.functions.numbers import mean

    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(mean(F.col("v"))).first()[0]

    assert of(5e12, 5e12, None) == 5e12
    assert of(1e39, 3e39) == 2e39
    assert of(1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19, 1e19) == 1e19
    assert of(0.1, 0.2, 0.3) == 0.6 / 3
    assert of(1e-9, 3e-9) == 2e-9
    assert of(None) is None


@pytest.mark.parametrize(
    "text, valence",
    [
        ("a good day", 1.9),
        ("not good", 1.9 * -0.74),
        ("isn't that good", 1.9 * -0.74),
        ("very good", 1.9 + 0.293),
        ("very, very good", 1.9 + 0.293 + 0.293 * 0.95),
        ("hardly good", 1.9 - 0.293),
        ("a GOOD day", 1.9 + 0.733),
        ("GOOD DAY", 1.9),
        ("good!!!", 1.9 + 3 * 0.292),
        ("good!!!!!!", 1.9 + 4 * 0.292),
        ("good??", 1.9 + 2 * 0.18),
        ("bad?????", -2.5 - 0.96),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("Good", 1.9),
        ("", 0.0),
        (" \t ", 0.0),
        (None, 0.0),
        ("nothing here", 0.0),
    ],
)
def test_words_around_a_hit(spark, text, valence):
    from tallyhall.operators.sentiment import context_sums

    lexicon = spark.sql("SELECT 'good' AS token, 1.9 AS valence UNION ALL SELECT 'bad', -2.5")
    modifiers = spark.createDataFrame([("very", 1), ("hardly", -1), ("not", 0)], "token string, kind int")
    for copies in (1, 3):
        df = spark.createDataFrame([(7, text)] * copies, "k long, t string")
        rows = context_sums(df, ["k"], "t", lexicon, modifiers).collect()
        assert [(r.k, pytest.approx(r.valence, abs=1e-7)) for r in rows] == [(7, valence)]


def test_words_are_counted_by_any_blank(spark):
    """Odd blanks amid ASCII and other letters, and letters in the same ranges as blanks."""
    blanks = [*tx.BLANKS, "\u1681", "\u200b", "\u2030", "\u2fff", "\x86", "\xe9"]
    texts = [f"{a}b{blank}c d{blank}{blank}e{blank}" for blank in blanks for a in ("a", "\xe9", "\u65e5", "\u2014")] + ["", " ", None]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    found = {r["n"]: r for r in df.select("n", tx.word_count(F.col("t")).alias("words"), tx.plain(F.col("t")).alias("plain")).collect()}
    for n, t in enumerate(texts):
        assert found[n]["words"] == (None if t is None else len([w for w in re.split(f"[{re.escape(tx.BLANKS)}]+", t) if w])), (n, t)
        if t is not None and found[n]["plain"]:
            assert not set(t) & set(tx.BLANKS[10:])
