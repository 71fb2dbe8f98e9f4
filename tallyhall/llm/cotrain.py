"""Quality classifier by co-training: one view reads the text, the other the page's metadata.

Both are logistic regressions over binary features. Over rounds each labels the unlabelled
documents of a pool that it is most certain of, for the other to learn from. Held-out labelled
documents then calibrate each view and weigh the two against each other. Fitting uses a
bounded sample; every document is scored.
"""

from __future__ import annotations

import pickle
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.session import saved

# Bounds of the sample: labelled documents, unlabelled documents in the pool, words known to the text view.
LABELLED = 6000
POOL = 4000
VOCABULARY = 4000
# A feature is known if its frequency differs between the kinds by so many standard errors.
LEAST_Z = 3.0
# Rounds of co-training, and the share of the pool that each view labels per round and class.
ROUNDS = 3
SHARE = 0.05
# A document is kept from this probability on.
THRESHOLD = 0.5
# Letters in the beginnings of words that are features too: forms of a word share them.
STEMS = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def _level(share: float) -> int:
    """A share in steps that are finer near 0."""
    return int(round(10 * share**0.5))


def text_features(text: str) -> set[str]:
    """The text's words, their beginnings (they end in *), and marks of its shape (they begin with #)."""
    n = len(text)
    found = set(_WORD.findall(text.lower()))
    stems = [{w[:k] + "*" for w in found if len(w) >= k} for k in STEMS]
    found.update(*stems)
    parts = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    letters = sum(map(text.count, "aeiouAEIOU")) or 1
    upper = sum(map(text.count, "AEIOU"))
    odd = sum(map(text.count, "#*$%&|<>!=_~^{}"))
    pairs = list(zip(parts, parts[1:], parts[2:]))
    found.add(f"#length{n.bit_length()}")
    found.add(f"#upper{_level(upper / letters)}")
    found.add(f"#odd{min(10, int(round(20 * (odd / max(1, n)) ** 0.5)))}")
    found.add(f"#lines{_level(1 - len(set(lines)) / max(1, len(lines)))}")
    found.add(f"#repeats{_level(1 - len(set(pairs)) / max(1, len(pairs)))}")
    found.add(f"#word{min(20, round(sum(map(len, parts)) / max(1, len(parts))))}")
    found.add(f"#digits{_level(sum(map(text.count, '0123456789')) / max(1, n))}")
    return found


def meta_features(lang, source, n_chars) -> set[str]:
    size = "none" if n_chars is None or n_chars != n_chars else int(max(0, n_chars)).bit_length()
    return {f"lang={lang}", f"source={source}", f"size={size}", f"lang,size={lang},{size}"}


@dataclass
class View:
    """A fitted logistic regression: weight per feature, bias, and its calibration."""

    weights: dict[str, float]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, features: set[str]) -> float:
        weights = self.weights
        return self.bias + sum(weights[f] for f in weights.keys() & features)

    def calibrated(self, features: set[str]) -> float:
        return self.slope * self.logit(features) + self.shift


def fit(rows: list[set[str]], y: np.ndarray, penalty: float = 0.3, steps: int = 300) -> View:
    """Logistic regression with classes of equal weight and a quadratic penalty, by accelerated gradient descent."""
    names = sorted(set().union(*rows)) if rows else []
    place = {f: n for n, f in enumerate(names)}
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    index = np.fromiter((place[f] for r in rows for f in sorted(r)), dtype=np.int64, count=int(lengths.sum()))
    row = np.repeat(np.arange(len(rows)), lengths)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w, b = np.zeros(len(names)), 0.0
    v, c = w.copy(), b
    # An upper bound of the curvature, feature by feature, scales the steps.
    scale = 0.25 * np.bincount(index, weights=(weight * np.maximum(1, lengths))[row], minlength=len(names)) + penalty
    scale_b = 0.25 * float((weight * (1 + lengths)).sum()) + 1e-9
    for k in range(steps):
        z = np.bincount(row, weights=v[index], minlength=len(rows)) + c
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        new_w = v - (np.bincount(index, weights=g[row], minlength=len(names)) + penalty * v) / scale
        new_b = c - g.sum() / scale_b
        pace = k / (k + 3)
        v, c, w, b = new_w + pace * (new_w - w), new_b + pace * (new_b - b), new_w, new_b
    return View(dict(zip(names, w.tolist())), float(b))


def _platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and, last, the constant of a ridge logistic regression on few columns, by Newton's method."""
    x = np.column_stack([z, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + beta)
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return beta


@dataclass
class Model:
    text: View
    meta: View
    combine: tuple[float, float, float]
    known: int
    # Pseudo-labels that either view handed to the other, per round: (by the text, by the metadata).
    handed: tuple[tuple[int, int], ...] = ()

    def score(self, text: set[str], meta: set[str]) -> tuple[float, float, float]:
        a, b = self.text.calibrated(text), self.meta.calibrated(meta)
        logits = np.clip([a, b, self.combine[0] * a + self.combine[1] * b + self.combine[2]], -30, 30)
        return tuple(float(p) for p in 1 / (1 + np.exp(-logits)))


def cotrain(text, meta, y, held, pool_text, pool_meta, rounds: int = ROUNDS, share: float = SHARE) -> Model:
    """Fit both views on labelled rows that aren't held out, exchange labels over the pool, calibrate on the held-out rows.

    Of the pool each view labels, per round, the rows that it is most certain of, as many of
    either class as the labelled rows suggest, and hands those to the other view of which it is sure enough: held-out rows
    at such logits are of that class at least half way from its share in all of them to always.
    """
    train = [n for n in range(len(y)) if not held[n]]
    sets = {"text": ([text[n] for n in train], [y[n] for n in train]), "meta": ([meta[n] for n in train], [y[n] for n in train])}
    pools = {"text": pool_text, "meta": pool_meta}
    views = {k: fit(rows, np.array(labels, dtype=float)) for k, (rows, labels) in sets.items()}
    free = set(range(len(pool_text)))
    positive = float(np.mean([y[n] for n in train])) if train else 0.5
    handed = []
    for _ in range(rounds):
        given = []
        for teacher, learner in (("text", "meta"), ("meta", "text")):
            order = sorted(free, key=lambda n: (views[teacher].logit(pools[teacher][n]), n))
            many = int(len(pool_text) * share)
            up, down = int(many * positive), many - int(many * positive)
            chosen = [(n, 0.0) for n in order[:down] if views[teacher].logit(pools[teacher][n]) < 0]
            chosen += [(n, 1.0) for n in order[len(order) - up :] if views[teacher].logit(pools[teacher][n]) > 0]
            sure = _confident(views[teacher], pools[teacher], chosen, text if teacher == "text" else meta, y, held)
            for n, label in sure:
                sets[learner][0].append(pools[learner][n])
                sets[learner][1].append(label)
                free.discard(n)
            given.append(len(sure))
        handed.append(tuple(given))
        views = {k: fit(rows, np.array(labels, dtype=float)) for k, (rows, labels) in sets.items()}
    kept = [n for n in range(len(y)) if held[n]] or train
    truth = np.array([y[n] for n in kept], dtype=float)
    for name, rows in (("text", text), ("meta", meta)):
        view = views[name]
        view.slope, view.shift = _platt(np.array([view.logit(rows[n]) for n in kept]), truth)
    both = np.array([[views["text"].calibrated(text[n]), views["meta"].calibrated(meta[n])] for n in kept]).reshape(len(kept), 2)
    return Model(views["text"], views["meta"], tuple(_platt(both, truth)), len(train), tuple(handed))


def _confident(view, pool, chosen, rows, y, held):
    """Of the chosen rows those at logits beyond which the view makes at most half the mistakes, on held-out rows, of always naming the class."""
    logits = np.array([view.logit(rows[n]) for n in range(len(y)) if held[n]])
    truth = np.array([y[n] for n in range(len(y)) if held[n]])
    out = []
    for n, label in chosen:
        z = view.logit(pool[n])
        beyond = truth[logits >= z] if label else 1 - truth[logits <= z]
        share = truth.mean() if label else 1 - truth.mean()
        if len(beyond) >= 10 and beyond.mean() >= (1 + share) / 2:
            out.append((n, label))
    return out


def _targets(labels: DataFrame) -> DataFrame:
    """doc_id, y: 1 for good quality that isn't toxic; rows of one document must all say so; incomplete rows say nothing."""
    read = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"), F.col("toxic").alias("t"))
    good = ((F.col("q") == 1) & (F.col("t") == 0)).cast("int")
    return read.dropna().groupBy("doc_id").agg(F.min(good).alias("y"))


def sample(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> DataFrame:
    """doc_id, y (null: pool), held, text, lang, source, n_chars of a bounded number of documents, chosen by hash of doc_id.

    Only ids are sorted, and only as many as wanted leave a task; the texts are fetched by a
    join with those few.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    marks = _targets(labels)
    mixed = F.xxhash64(F.col("doc_id"), F.lit(1))
    known = marks.join(ids.distinct(), "doc_id", "left_semi").orderBy(mixed, "doc_id").limit(labelled)
    free = ids.join(marks, "doc_id", "left_anti").distinct().orderBy(mixed, "doc_id").limit(pool)
    chosen = known.select("doc_id", "y").unionByName(free.select("doc_id", F.lit(None).cast("int").alias("y")))
    held = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(2)), F.lit(3)) == 0
    few = F.broadcast(saved(chosen.withColumn("held", held)))  # at most labelled + pool rows
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("double").alias("n_chars"),
    )
    # Of rows that repeat a doc_id the smallest stands for all.
    own = rows.join(few, "doc_id").groupBy("doc_id").agg(F.min(F.struct("y", "held", "text", "lang", "source", "n_chars")).alias("row"))
    return own.select("doc_id", "row.*")


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        meta = [sorted(meta_features(*r)) for r in zip(batch["lang"], batch["source"], batch["n_chars"])]
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"], "y": batch["y"].astype("Float64"), "held": batch["held"],
                "features": [sorted(text_features(t)) for t in batch["text"]], "meta": meta,
            }
        )


def train(docs: DataFrame, labels: DataFrame, vocabulary: int = VOCABULARY) -> Model | None:
    """The fitted model; None without labelled documents of both kinds.

    The text view knows the `vocabulary` features that tell the kinds of labelled documents
    apart best, by their frequency in either; they are counted in Spark, and only those of each sampled document are collected.
    """
    rows = saved(
        sample(docs, labels).mapInPandas(
            _featured, "doc_id long, y double, held boolean, features array<string>, meta array<string>"
        )
    )
    known = rows.where("y IS NOT NULL AND NOT held")
    totals = known.agg(F.count("*").alias("n"), F.sum("y").alias("good")).first()
    if not totals["n"] or not 0 < totals["good"] < totals["n"]:
        return None
    bad, good = totals["n"] - totals["good"], totals["good"]
    words = known.select("y", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")
    )
    p, q = (F.col("bad") + 0.5) / (bad + 1), (F.col("good") + 0.5) / (good + 1)
    both = (F.col("bad") + F.col("good") + 1) / (totals["n"] + 2)
    z = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / (bad + 1) + 1 / (good + 1)))
    listed = words.where((F.col("bad") + F.col("good") >= 3) & (z >= LEAST_Z)).orderBy(z.desc(), "f").limit(vocabulary)
    names = [sys.intern(r["f"]) for r in listed.select("f").collect()]
    places = docs.sparkSession.createDataFrame(pa.table({"f": pa.array(names, pa.string()), "place": pa.array(range(len(names)), pa.int32())}))
    own = rows.select("doc_id", F.explode("features").alias("f")).join(F.broadcast(places), "f")
    own = own.groupBy("doc_id").agg(F.collect_set("place").alias("text"))
    # One task fits both views, on labelled + pool rows at most; the driver sees weights only.
    table = rows.select("doc_id", "y", "held", "meta").join(own, "doc_id", "left").coalesce(1).sortWithinPartitions("doc_id")
    return pickle.loads(table.mapInPandas(_fitted(names), "model binary").first()["model"])


def _fitted(names: list[str]):
    """All rows of the sample (y, held, meta, text as places in names) to one row that holds the model."""

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text, meta, known_y, held = [], [], [], []
        for batch in batches:
            text += [frozenset(() if x is None else map(names.__getitem__, x)) for x in batch["text"]]
            meta += [frozenset(map(sys.intern, x)) for x in batch["meta"]]
            known_y += [None if y != y else int(y) for y in batch["y"]]
            held += batch["held"].tolist()
        pick = lambda values, flag: [v for v, y in zip(values, known_y) if (y is not None) == flag]
        model = cotrain(pick(text, True), pick(meta, True), pick(known_y, True), pick(held, True), pick(text, False), pick(meta, False))
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    return fitted


def _scorer(model: Model):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                model.score(text_features(t or ""), meta_features(*m))
                for t, *m in zip(batch["text"], batch["lang"], batch["source"], batch["n_chars"])
            ]
            text, meta, both = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"key": batch["key"], "row": batch["row"], "text_score": text, "meta_score": meta, "score": both})

    return score


def _row(docs: DataFrame) -> Column:
    """A hash of what tells a row's verdict apart: doc_id, text and metadata, missing or not."""
    read = [
        docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")), docs["lang"].cast("string"), docs["source"].cast("string"),
        docs["n_chars"].cast("double"),
    ]
    return F.xxhash64(*read, *[c.isNull() for c in read])


def _scored(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """row and the columns of score()."""
    thin = docs.select(
        F.col("doc_id").cast("string").alias("key"), _row(docs).alias("row"), F.col("text"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), F.col("n_chars").cast("double").alias("n_chars"),
    )
    rows = thin.mapInPandas(_scorer(model), "key string, row long, text_score double, meta_score double, score double")
    return rows.select(
        "row", F.col("key").cast("long").alias("doc_id"), "text_score", "meta_score", "score", (F.col("score") >= threshold).alias("kept")
    )


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept: a row per row of docs.

    Null text is empty; null metadata are values of their own. Without a model all scores are
    null and every document is kept.
    """
    if model is None:
        none = [F.lit(None).cast("double").alias(c) for c in ("text_score", "meta_score", "score")]
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *none, F.lit(True).alias("kept"))
    return _scored(docs, model, threshold).drop("row")


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier keeps, with their columns; other rows of a rejected row's doc_id, missing or not, stay."""
    model = train(docs, labels)
    if model is None:
        return docs
    verdicts = _scored(docs, model, threshold).where(~F.col("kept"))
    bad = verdicts.select(F.col("doc_id").alias("_tallyhall_bad"), F.col("row").alias("_tallyhall_row")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_tallyhall_bad")) & (_row(docs) == F.col("_tallyhall_row"))
    return docs.join(bad, same, "left_anti")
