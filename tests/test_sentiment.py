"""Scores in context against a plain Python version, with phrases, emoticons and emoji."""

from __future__ import annotations

import random
import re
import string

import pytest

from tallyhall.operators.sentiment import context_sums
from tallyhall.sources import readers

LEXICON = {"good": 1.9, "bad": -2.5, "sort": 0.4, ":)": 2.0, "<3": 1.5, "😀": 2.2, "👍": 1.1, "☹": -1.7}
MODIFIERS = {"very": 1, "hardly": -1, "not": 0}
PHRASES = {"kiss of death": -1.5, "sort of": -0.3, "bad luck": -1.0, "luck of the draw": 0.7, "good and bad": 0.2, "and bad luck": -3.0}


def plain(text, phrases=PHRASES):
    """What the words of a text add up to, one step after another."""
    text = re.sub("([😀👍☹🚀])[‍︎️\U0001f3fb-\U0001f3ff]*", r" \1 ", text or "")
    words = text.split()
    low = [(w if len(w.strip(string.punctuation)) <= 2 else w.strip(string.punctuation)).lower() for w in words]
    caps = [w == w.upper() and w != w.lower() for w in words]
    mixed = any(caps) and not all(caps)
    found, at = [], 0  # place, words, valence
    while at < len(low):
        n = next((n for n in (4, 3, 2) if at + n <= len(low) and " ".join(low[at : at + n]) in phrases), 1)
        found.append((at, n, phrases[" ".join(low[at : at + n])] if n > 1 else LEXICON.get(low[at])))
        at += n
    kind = {}
    for at, n, v in found:
        if n == 1 and v is None:
            kind[at] = MODIFIERS.get(low[at], 0 if "n't" in low[at] else None)
    turn = low.index("but") if "but" in low else None
    total = 0.0
    for at, _, v in found:
        if v is None:
            continue
        v += (0.733 if v > 0 else -0.733) if mixed and caps[at] else 0
        for back, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
            k = kind.get(at - back)
            if k == 0:
                v *= -0.74
            elif k:
                v += (1 if v > 0 else -1) * (0.293 * k + (0.733 if mixed and caps[at - back] else 0)) * weight
        total += v * (1 if turn is None or at == turn else 0.5 if at < turn else 1.5)
    asks = text.count("?")
    more = min(text.count("!"), 4) * 0.292 + (0 if asks < 2 else 0.18 * asks if asks <= 3 else 0.96)
    return total + (more if total > 0 else -more if total < 0 else 0)


@pytest.fixture(scope="module")
def tables(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    modifiers = spark.createDataFrame(list(MODIFIERS.items()), "token string, kind int")
    return lexicon, modifiers, "but", spark.createDataFrame(list(PHRASES.items()), "token string, valence double")


def scores(spark, tables, texts, copies=1):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts) for _ in range(copies)], "k long, t string").repartition(4)
    return {r.k: r.valence for r in context_sums(df, ["k"], "t", *tables).collect()}


HAND_MADE = {
    "sort of a day": -0.3,  # the phrase, not its first word
    "sort this": 0.4,
    "a kiss of death": -1.5,
    "very bad luck": -1.0 - 0.293,
    "not bad luck": 0.74,
    "bad luck of the draw": -1.0,  # from left to right: 'luck' is taken
    "good and bad luck": 0.2,  # the first phrase wins, though a later one is as long
    "x and bad luck": -3.0,
    "Bad, LUCK!": -1.0 - 0.292,
    "fine:) 👍🏽": 1.1,
    "fine :) <3": 3.5,
    "so😀😀": 4.4,
    "☹️ but 😀": -0.85 + 3.3,
    "not　good day": 1.9 * -0.74,
    "kiss of": 0.0,
}


def test_hand_made(spark, tables):
    found = scores(spark, tables, HAND_MADE)
    assert [found[n] for n in range(len(HAND_MADE))] == pytest.approx(list(HAND_MADE.values()), abs=1e-7)
    assert [plain(t) for t in HAND_MADE] == pytest.approx(list(HAND_MADE.values()), abs=1e-7)


@pytest.mark.parametrize("copies", [1, 3])
def test_random_texts(spark, tables, copies):
    pick = random.Random(copies)
    parts = [*LEXICON, *MODIFIERS, *" ".join(PHRASES).split(), "but", "isn't", "a", "the", "GOOD", "VERY", "Bad,", "(luck)", "🚀", "123", "ÄÖ", "👍🏽"]
    blank = lambda: pick.choice([" ", " ", " ", "  ", "\n", "\t", " ", " "])
    texts = ["".join(pick.choice(parts) + blank() for _ in range(pick.randrange(25))) + pick.choice(["", "!", "??", "!!!??", "????"]) for _ in range(400)]
    texts += [None, "", " \n", " good", "GOOD BAD", "GOOD 123"]
    found = scores(spark, tables, texts, copies)
    assert [found[n] for n in range(len(texts))] == pytest.approx([plain(t) for t in texts], abs=1e-6)


def test_without_broadcast(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = scores(spark, tables, HAND_MADE)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [found[n] for n in range(len(HAND_MADE))] == pytest.approx(list(HAND_MADE.values()), abs=1e-7)


def test_phrases_from_a_file(spark, tmp_path):
    (tmp_path / "p.txt").write_text("Kiss  of death\t-1.5\tmore\nbad luck\t-1\n")
    assert {tuple(r) for r in readers.read_phrases(spark, str(tmp_path)).selectExpr("token", "double(valence)").collect()} == {
        ("kiss of death", -1.5), ("bad luck", -1.0),
    }
    (tmp_path / "q.txt").write_text("one\t1\n")
    with pytest.raises(Exception, match="phrase of fewer"):
        readers.read_phrases(spark, str(tmp_path / "q.txt")).collect()
