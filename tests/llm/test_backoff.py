from __future__ import annotations

import math
from collections import Counter

import pytest
from brute import lower, words
from tallyhall.llm import backoff, queries


def expected(rows, leave_out=True):
    texts = [words(lower(t)) for _, t in rows]
    runs = lambda w: Counter(tuple(w[n : n + k]) for k in (1, 2, 3) for n in range(len(w) - k + 1))
    every, own = Counter(), [runs(w) for w in texts]
    for o in own:
        every.update(o)
    total, out = sum(map(len, texts)), []
    for (i, _), w, mine in zip(rows, texts, own):
        count = lambda g: every[g] - (mine[g] if leave_out else 0)  # noqa: E731, B023
        of = max(1, total - (len(w) if leave_out else 0))
        score = 0.0
        for n in range(len(w)):
            factor = 1.0
            for k in (3, 2, 1):
                if n + 1 < k:
                    continue
                gram = tuple(w[n + 1 - k : n + 1])
                if k == 1:
                    score += math.log(factor * max(1, count(gram)) / of)
                elif count(gram) > 0:
                    score += math.log(factor * count(gram) / count(gram[:-1]))
                    break
                else:
                    factor *= backoff.ALPHA
        out.append((i, len(w), score))
    return out


def check(df, wanted):
    key = lambda r: (r[0] is not None, r[0], r[1], round(r[2], 3))
    found = sorted(map(tuple, df.select("doc_id", "n_words", "log_score", "mean_log_score").collect()), key=key)
    wanted = sorted(wanted, key=key)
    assert [f[:2] for f in found] == [w[:2] for w in wanted]
    for f, w in zip(found, wanted):
        assert math.isclose(f[2], w[2], rel_tol=1e-6, abs_tol=1e-6)
        assert (f[3] is None) == (w[1] == 0)


@pytest.mark.parametrize("split_bytes", [8 << 20, 60_000])
def test_query(spark, folder, monkeypatch, split_bytes):
    monkeypatch.setattr(backoff, "SPLIT_BYTES", split_bytes)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    check(queries.op7_backoff(spark, folder), expected(rows))


@pytest.mark.parametrize("leave_out", [True, False])
def test_edge_cases(spark, documents, leave_out):
    rows = documents.select("doc_id", "text").collect()
    check(backoff.score(documents, leave_out), expected(rows, leave_out))
    assert backoff.score(documents.limit(0), leave_out).count() == 0
