from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyhall.llm import cotrain, queries


def test_query(spark):
    """Accuracy on labelled documents that the model was neither fitted to nor calibrated on."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    scores = cotrain.score(docs, cotrain.train(docs, half))
    rest = scores.join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    good = (rest["quality"] == 1) & (rest["toxic"] == 0)
    assert len(rest) > 1000
    assert rest[good]["kept"].mean() > 0.97
    assert 1 - rest[~good]["kept"].mean() > 0.88
    assert scores.count() == docs.count()


def test_query_is_registered(spark, folder):
    result = queries.op3_cotrain(spark, folder)
    assert result.columns == ["doc_id", "text_score", "meta_score", "score", "kept"]
    assert result.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_edge_cases(spark, documents):
    labels = spark.createDataFrame([(n, n % 2, None if n == 30 else 0, 1) for n in [*range(20, 60), 20, 999]], "doc_id long, quality int, toxic int, text int")
    model = cotrain.train(documents, labels)
    result = cotrain.score(documents, model)
    assert result.count() == documents.count() and result.where("score IS NULL OR kept IS NULL").count() == 0
    kept = cotrain.keep(documents, labels)
    assert kept.columns == documents.columns
    assert cotrain.score(documents.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert cotrain.train(documents, none) is None
        assert cotrain.keep(documents, none).count() == documents.count()


def test_sample_is_bounded(spark, documents):
    labels = spark.createDataFrame([(n, 1, 0) for n in range(20, 60)], "doc_id long, quality int, toxic int")
    rows = cotrain.sample(documents, labels, labelled=10, pool=5).select("doc_id", "y").distinct().collect()
    assert sum(r["y"] is not None for r in rows) == 10 and sum(r["y"] is None for r in rows) == 5
    again = documents.select("*", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("col")  # repeated rows do not add to it
    assert cotrain.sample(again, labels, labelled=10, pool=5).count() == 15


def made(pick, n):
    """Rows whose text marks the class well and whose metadata marks it fairly."""
    y = [int(pick.random() < 0.7) for _ in range(n)]
    text = [frozenset(({"good"} if (k == 1) == (pick.random() < 0.95) else {"bad"}) | {f"w{pick.randrange(30)}"}) for k in y]
    meta = [frozenset({"a" if (k == 1) == (pick.random() < 0.85) else "b", f"m{pick.randrange(5)}"}) for k in y]
    return text, meta, y


def test_views_teach_each_other():
    """The combined score is no worse than either view, and few labels go further with a pool than without."""
    pick = random.Random(0)
    text, meta, y = made(pick, 60)
    pool = made(pick, 2000)
    test = made(pick, 4000)
    held = [n % 3 == 0 for n in range(60)]
    model = cotrain.cotrain(text, meta, y, held, pool[0], pool[1])
    scores = np.array([model.score(t, m) for t, m in zip(test[0], test[1])])
    right = ((scores > 0.5) == (np.array(test[2])[:, None] == 1)).mean(0)
    assert right[2] >= max(right[0], right[1]) - 0.01 and right[2] > 0.93


def test_either_view_hands_on_labels():
    """With held-out rows enough to be sure of; a view that knows nothing hands on none."""
    pick = random.Random(1)
    text, meta, y = made(pick, 600)
    pool = made(pick, 2000)
    held = [n % 3 == 0 for n in range(600)]
    model = cotrain.cotrain(text, meta, y, held, pool[0], pool[1])
    assert len(model.handed) == cotrain.ROUNDS and all(sum(given) > 0 for given in zip(*model.handed))
    blind = cotrain.cotrain(text, [frozenset({"x"})] * 600, y, held, pool[0], [frozenset({"x"})] * 2000)
    assert sum(a for a, _ in blind.handed) > 0 and not any(b for _, b in blind.handed)


def test_fit_finds_the_optimum():
    pick = random.Random(3)
    rows = [frozenset(f"f{k}" for k in range(6) if pick.random() < 0.4) for _ in range(300)]
    y = np.array([float(("f0" in r) != (pick.random() < 0.2)) for r in rows])
    view = cotrain.fit(rows, y, steps=3000)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    gap = weight * (1 / (1 + np.exp(-np.array([view.logit(r) for r in rows]))) - y)
    for name, w in view.weights.items():
        assert sum(g for g, r in zip(gap, rows) if name in r) + 0.3 * w == pytest.approx(0, abs=0.05)
    assert gap.sum() == pytest.approx(0, abs=0.05)


def test_keep_decides_row_by_row(spark, monkeypatch):
    """Rows that share a doc_id, or have none, go one by one; so do rows that differ in metadata alone."""
    text = cotrain.View({"bad": -50.0}, 5.0)
    meta = cotrain.View({"lang=xx": -50.0}, 5.0)
    monkeypatch.setattr(cotrain, "train", lambda *_: cotrain.Model(text, meta, (1.0, 1.0, 0.0), 1))
    rows = [
        (None, "bad one", "en", "a", 3), (None, "fine one", "en", "a", 3), (None, None, "en", None, None), (1, "bad", "en", "a", 3),
        (1, "fine", "en", "a", 3), (2, "fine", "xx", "a", 3), (2, "fine", "en", "a", 3), (2, "fine", None, "a", None), (3, "bad", None, None, None),
        (3, "bad", "en", "a", 3), (4, "fine", "en", "a", 3), (4, "fine", "en", "a", 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(map(tuple, cotrain.keep(docs, None).collect()), key=str)
    assert kept == sorted((r for r in rows if "bad" not in (r[1] or "") and r[2] != "xx"), key=str)
