"""Distributed ranking against brute force, under several partitionings and heavy ties."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tallyhall.operators import ranking


def ntile(n: int, k: int) -> list[int]:
    size, extra = divmod(n, k)
    return [t for t in range(1, k + 1) for _ in range(size + (t <= extra))]


def numbers(kind: str, n: int) -> list[float | None]:
    rng = random.Random(n)
    return {
        "mixed": [rng.choice([0.0, -0.0, 0.0, rng.uniform(-5, 5), rng.uniform(-1e9, 1e9), 1e-300]) for _ in range(n)],
        "hot": [0.0 if rng.random() < 0.4 else round(rng.uniform(0, 1e6), 2) for _ in range(n)],
        "few": [float(rng.randint(1, 4)) for _ in range(n)],
        "narrow": [1000 + rng.random() / 1000 for _ in range(n)],
        "gaps": [None if rng.random() < 0.2 else float(rng.randint(0, 50)) for _ in range(n)],
    }[kind]


@pytest.mark.parametrize("kind", ["mixed", "hot", "few", "narrow", "gaps"])
@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_equal_numpy(spark, kind, n):
    values = numbers(kind, n)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = ranking.exact_quantiles(df, "x", probs).first()
    known = [v for v in values if v is not None]
    expected = tuple(float(np.quantile(known, p)) for p in probs.values()) if known else (None,) * 5
    assert tuple(got) == expected


def test_quantiles_by_group_with_a_missing_key(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.uniform(-9, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in ranking.exact_quantiles(df, "x", {"m": 0.37}, by=["g"]).collect()}
    for g in ("a", "b", None):
        assert got[g] == float(np.quantile([x for k, x in rows if k == g], 0.37))


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert ranking.exact_quantiles(df, "x", {"m": 0.5}).first().m is None


@pytest.mark.parametrize("n,k", [(1, 1), (3, 10), (10, 10), (11, 4), (1003, 10)])
def test_tile_formulas(spark, n, k):
    got = spark.range(1, n + 1).selectExpr(
        f"{ranking.tile_of('id', f'{n}L', k)} AS t", f"{ranking.last_rank('id', f'{n}L', k)} AS e"
    )
    tiles = [r.t for r in got.collect()]
    assert tiles == ntile(n, k)
    ends = [r.e for r in got.limit(k).collect()][: min(n, k)]
    assert ends == [sum(t <= i for t in tiles) for i in range(1, min(n, k) + 1)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind,n", [("few", 997), ("few", 3), ("gaps", 0)])
def test_tiles_from_counts(spark, kind, n, descending):
    values = [int(v) for v in numbers(kind, n)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = {r.tile: (r.entities, r.total) for r in ranking.tiles_from_counts(df, "x", 10, descending).collect()}
    expected: dict[int, tuple[int, int]] = {}
    for t, v in zip(ntile(n, 10), sorted(values, reverse=descending)):
        e = expected.get(t, (0, 0))
        expected[t] = (e[0] + 1, e[1] + v)
    assert got == expected


def by_md5(rows, descending):
    def key(row):
        i, v = row
        return (v is None, 0 if v is None else (-v if descending else v), hashlib.md5(str(i).encode()).hexdigest())

    return [i for i, _ in sorted(rows, key=key)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["mixed", "hot", "few", "narrow", "gaps"])
@pytest.mark.parametrize("n,k", [(3, 5), (1000, 4)])
def test_ntile_of_rows(spark, kind, n, k, descending):
    rows = list(zip(random.Random(1).sample(range(10**12), n), numbers(kind, n)))
    df = spark.createDataFrame(rows, "id long, x double").repartition(3)
    out = ranking.with_ntile(df, "id", "x", k, "tile", descending)
    assert out.columns == ["id", "x", "tile"]
    got = {r.id: r.tile for r in out.collect()}
    assert [got[i] for i in by_md5(rows, descending)] == ntile(n, k)


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_partitioning_does_not_matter(spark, partitions):
    rows = list(enumerate(numbers("hot", 2000)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "id long, x double").repartition(7)
        got = {r.id: r.t for r in ranking.with_ntile(df, "id", "x", 7, "t").collect()}
        assert [got[i] for i in by_md5(rows, False)] == ntile(2000, 7)
        p = ranking.exact_quantiles(df, "x", {"p": 0.99}).first().p
        assert p == float(np.quantile([v for _, v in rows], 0.99))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
