"""Base statistics by plain loops; the estimate against numpy's."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
from brute import words
from tallyhall.llm import outliers, queries


def base(text):
    found, text = words(text), text or ""
    runs = Counter(zip(found, found[1:], found[2:]))
    inside = {m for n in range(len(found) - 2) if runs[tuple(found[n : n + 3])] > 1 for m in (n, n + 1, n + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def vector(n, chars, symbols, lines, repeats):
    one = max(1, n)
    parts = (math.log1p(n), math.log(max(1, chars) / one), math.log1p(100 * symbols / one), math.log1p(lines), math.sqrt(repeats / one))
    return np.floor(np.array(parts) * outliers.SCALE + 0.5) / outliers.SCALE


def rank(values, share):
    return sorted(values)[math.ceil(share * len(values)) - 1]


def starts(x, floor):
    mean = np.array([rank(c, 0.5) for c in x.T])
    mad = np.array([rank(abs(c - m), 0.5) for c, m in zip(x.T, mean)])
    square = (1.4826 * mad) ** 2 + np.diag(floor)
    bent = np.round(np.tanh((x - mean) / np.sqrt(square)) * outliers.SCALE) / outliers.SCALE
    cov = np.cov(bent.T, bias=True) + floor
    alike = cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov)))
    return [(mean, np.diag(square)), (mean, alike * np.sqrt(np.outer(square, square))), (x.mean(0), np.cov(x.T, bias=True) + floor)]


def estimate(x):
    """The same concentration steps as the operator's from the same starts, in numpy; the least determinant stays."""
    floor = np.diag(np.array(outliers.FLOOR) ** 2)
    bins = lambda mean, cov: np.floor(np.log(((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(1) + 1e-6) * outliers.BINS)
    ends = []
    for mean, cov in starts(x, floor):
        for _ in range(outliers.STEPS):
            at = bins(mean, cov)
            core = x[at <= rank(at, outliers.CORE)]
            mean, cov = core.mean(0), np.cov(core.T, bias=True) + floor
        ends.append((mean, cov))
    sizes = [np.linalg.slogdet(cov)[1] for _, cov in ends]
    mean, cov = next(end for end, size in zip(ends, sizes) if size <= min(sizes) + 1e-9)
    return mean, cov, math.exp((rank(bins(mean, cov), outliers.CORE) + 1) / outliers.BINS) / outliers.CORE_DISTANCE


def expected(rows):
    stats = [base(t) for _, t, _, _ in rows]
    fails = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    key = [(l or "", s or "") for _, _, l, s in rows]
    sizes = Counter(k for k, f in zip(key, fails) if not f)
    pools = Counter()
    for (lang, _), n in sizes.items():
        pools[lang] += n if n < outliers.LEAST_ROWS else 0
    group = lambda k: k if sizes[k] >= outliers.LEAST_ROWS else (k[0],) if pools[k[0]] >= outliers.LEAST_ROWS else ()
    by = defaultdict(list)
    for k, s, f in zip(key, stats, fails):
        if not f:
            by[group(k)].append(vector(*s))
    fitted = {g: estimate(np.array(x)) for g, x in by.items() if len(x) >= outliers.LEAST_ROWS}
    out = []
    for (i, *_), k, s, f in zip(rows, key, stats, fails):
        d = None
        if not f and group(k) in fitted:
            mean, cov, unit = fitted[group(k)]
            d = float((vector(*s) - mean) @ np.linalg.inv(cov) @ (vector(*s) - mean) / unit)
        out.append((i, *s, f, d))
    return out


def check(df, rows):
    key = lambda r: [(x is not None, x) for x in r[:6]]
    result = sorted(map(tuple, df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept").collect()), key=key)
    wanted = sorted(expected(rows), key=key)
    assert [r[:7] for r in result] == [w[:7] for w in wanted]
    for r, w in zip(result, wanted):
        assert (r[7] is None) == (w[7] is None) and (w[7] is None or math.isclose(r[7], w[7], rel_tol=1e-6, abs_tol=1e-9))
        assert r[8] == (not w[6] and (w[7] is None or r[7] <= outliers.CUTOFF))


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(queries.op4_outliers(spark, folder), [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])


def test_groups_and_edge_cases(spark, documents):
    """One group large enough for itself, small ones pooled, an outlier of each kind."""
    pick = random.Random(4)
    vocabulary = [f"{chr(97 + n % 26) * (1 + n % 7)}{n}" for n in range(900)]
    prose = lambda n: "\n".join(" ".join(pick.choice(vocabulary) for _ in range(n // 4)) for _ in range(4))
    rows = [(1000 + n, prose(pick.randint(60, 600)), "en", "big") for n in range(140)]
    rows += [(2000 + n, prose(pick.randint(60, 600)), "fr", f"s{n % 5}") for n in range(120)]
    rows += [(3000, " ".join(["|"] * 400), "en", "big"), (3001, prose(200).replace(" ", " *** "), "en", "big"), (3002, "ü" * 3000 + " " + prose(60), "fr", "s0")]
    extra = spark.createDataFrame([(*r, 0, -1, "x") for r in rows], documents.schema)
    df = documents.unionByName(extra)
    every = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
    result = outliers.judge(df)
    check(result, every)
    kept = {r["doc_id"]: r["kept"] for r in result.collect()}
    assert not kept[3000] and not kept[3001]
    assert all(kept[1000 + n] for n in range(140)) and all(kept[2000 + n] for n in range(120))


def test_least_determinant_of_the_starts(spark):
    """Two clouds, the tighter one aslant: the estimate of least determinant stays, not that of the first start."""
    pick = np.random.default_rng(12)
    slant = pick.normal(size=(300, 1)) * np.array([[2.0, 2.0, 2.0, 2.0, 2.0]]) + pick.normal(size=(300, 5)) * 0.02
    far = pick.normal(size=(90, 5)) * 0.5 + np.array([6.0, -6.0, 6.0, 0.0, 3.0])
    x = np.round(np.vstack([slant, far]) * outliers.SCALE).astype(int)
    rows = spark.createDataFrame([(7, *map(int, v)) for v in x], ["group", *outliers.NAMES])
    estimates = outliers.saved(outliers._starts(rows))
    assert estimates.count() == 3
    sizes = {}
    for r in outliers._factored(estimates).collect():
        sizes[r["start"]] = sum(math.log(r[f"l{k}{k}"]) for k in range(5))
    kept = outliers._least(estimates).collect()
    assert [r["start"] for r in kept] == [min(sizes, key=lambda s: (sizes[s], s))]
    floor = np.diag(np.array(outliers.FLOOR) ** 2)
    for r, (mean, cov) in zip(sorted(estimates.collect(), key=lambda r: r["start"]), starts(x / outliers.SCALE, floor)):
        assert np.allclose([r[f"mean{k}"] for k in range(5)], mean)
        assert np.allclose([r[f"cov{a}{b}"] for a, b in outliers.PAIRS], [cov[a][b] for a, b in outliers.PAIRS], atol=1e-6)


def test_shuffled_estimates(spark, folder, monkeypatch):
    usual = sorted(map(str, queries.op4_outliers(spark, folder).collect()))
    monkeypatch.setattr(outliers, "FEW_GROUPS", 0)
    assert sorted(map(str, queries.op4_outliers(spark, folder).collect())) == usual


def test_no_rows(spark, documents):
    assert outliers.judge(documents.limit(0)).count() == 0


def test_no_python_on_the_way(spark, folder):
    plan = queries.op4_outliers(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
