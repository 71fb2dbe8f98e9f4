from __future__ import annotations

import hashlib
import math
import random

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tallyhall.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows):
    """(vec_id, code, error, label_error, digest) by plain loops over whole numbers."""
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vector and all(x is not None and math.isfinite(x) and abs(x) * 4096 < vc.LARGEST for x in vector):
            kept.append((vec_id, label, [math.floor(4096 * x) for x in vector]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    if not kept:
        return []
    cuts = [p * len(kept[0][2]) // 8 for p in range(9)]
    parts = lambda v: [v[a:b] for a, b in zip(cuts, cuts[1:])]
    books = [[list(parts(r[2])[p]) for r in kept[:16]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(6):
        homes = [[nearest(p, x) for p, x in enumerate(parts(r[2]))] for r in kept]
        for p in range(8):
            for e in range(len(books[p])):
                own = [parts(r[2])[p] for r, h in zip(kept, homes) if h[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out, totals = [], {}
    for vec_id, label, v in kept:
        homes = [nearest(p, x) for p, x in enumerate(parts(v))]
        error = sum(far(x, books[p][h]) for p, (x, h) in enumerate(zip(parts(v), homes)))
        totals[label] = totals.get(label, 0) + error
        out.append((vec_id, "".join(f"{h:02x}" for h in homes), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, totals[label], digest) for i, c, e, label in out]


def check(spark, rows):
    found = vc.compress(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    key = lambda r: str(r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("length", [16, 11, 8, 3])
def test_rows(spark, length):
    """Nulls in every column, bad components, copies, negative floors, ties, other lengths, a third of all rows alike."""
    pick = random.Random(length)
    number = lambda: pick.choice([pick.gauss(0, 1), -0.25, 0.25, 0.0])
    rows = [(n, [number() for _ in range(length)], pick.choice([1, 2, None]), "x") for n in range(300)]
    hot = [0.5] * length
    rows += [(1000 + n, hot, 3, "y") for n in range(150)]
    rows += [rows[5], rows[5], (None, [number() for _ in range(length)], 2, None), (7, [number() for _ in range(length)], 2, None)]
    bad = ([None] * length, [float("nan")] * length, [float("inf")] * length, [1e30] * length, None, [], [1.0] * (length + 1))
    rows += [(2000 + n, v, 1, "z") for n, v in enumerate(bad)]
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(3, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], None, None), (1, [0.0] * 8, None, None)])
    check(spark, [])
    check(spark, [(1, None, 2, "a")])


def test_distances_are_squared_differences():
    import numpy as np

    class Rows(vc._Block):
        def __init__(self, matrix):
            self.ids = range(len(matrix))
            self.words, codes = zip(*(np.unique(c, return_inverse=True) for c in matrix.T))
            self.codes = np.array(codes).T

    pick = np.random.default_rng(2)
    matrix, entries = pick.integers(-9000, 9000, (50, 8)), pick.integers(-9000, 9000, (16, 3))
    wanted = ((matrix[:, None, 2:5] - entries[None]) ** 2).sum(axis=2)
    assert (Rows(matrix).distances(entries, 2) == wanted).all()


def test_query_equals_sql(spark, folder):
    name = "op12_vector_codes"
    assert differences(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) == []
