from __future__ import annotations

import math

import numpy as np
import pytest

import __spark_entry__ as entry
from compare import connect
from tallyhall.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double"


def exact(rows, every=50, k=5):
    """{(query_id, vector): [(vec_id, score)]} by comparing all pairs; a missing id is larger than any."""
    good = {(i, tuple(v)) for i, v in rows if v and any(v) and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q, a in good:
        if q is None or q % every:
            continue
        found = []
        for i, b in good:
            if i != q and len(a) == len(b):
                found.append((-float(ann.cosines(np.array([a], float), np.array([b], float))[0]), i is None, i or 0))
        out[q, a] = [(None if missing else i, -s) for s, missing, i in sorted(found)[:k]]
    return out


def recall(found: dict, wanted: dict) -> float:
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in best}) for q, best in wanted.items())
    return hit / sum(map(len, wanted.values()))


def by_query(rows) -> dict:
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 0.5) for i, v in rows], SCHEMA).repartition(6)


def vectors(kind, n, dim=24, seed=4):
    pick = np.random.default_rng(seed)
    if kind == "spread":
        return pick.normal(size=(n, dim))
    if kind == "clusters":  # tight ones, far apart
        return np.repeat(pick.normal(size=(n // 50, dim)), 50, axis=0) + 0.01 * pick.normal(size=(n // 50 * 50, dim))
    return np.cumsum(pick.normal(size=(n, dim)) * 0.05, axis=0)  # a path


@pytest.mark.parametrize("kind", ["spread", "clusters", "path"])
def test_recall(spark, monkeypatch, kind):
    """Several shards; at least 0.9 of what comparing all pairs finds, every score exact, best first."""
    monkeypatch.setattr(ann, "SHARD", 700)
    rows = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(vectors(kind, 2500))]
    found, wanted = by_query(ann.nearest(frame(spark, rows), every=25).collect()), exact(rows, every=25)
    wanted = {q: best for (q, _), best in wanted.items()}
    assert recall(found, wanted) >= 0.9
    held = dict(rows)
    for q, best in found.items():
        assert len(best) == 5 and best == sorted(best, key=lambda x: (-x[1], x[0]))
        for i, s in best:
            a, b = np.array(held[q]), np.array(held[i])
            assert s == pytest.approx(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b), abs=1e-12)


def test_edges(spark):
    """Few rows are found exactly: copies, ties, nulls, zero and non-finite vectors, other lengths, repeated and missing ids."""
    pick = np.random.default_rng(7)
    some = [float(np.float32(x)) for x in pick.normal(size=8)]
    rows = [(n, [float(np.float32(x)) for x in pick.normal(size=8)]) for n in range(120)]
    rows += [(200 + n, some) for n in range(60)]  # a third of all rows
    rows += [(300, [0.0] * 8), (350, None), (400, [float("nan")] * 8), (450, [None] * 8), (500, [float("inf")] * 8), (550, [])]
    rows += [(600, [1.0, 2.0]), (601, [2.0, 4.0]), (602, [2.0, 1.0]), (650, [1.0, 0.0, 0.0]), (None, some), (None, [0.5] * 8), rows[50], rows[50]]
    rows += [(750, [1e30] * 8), (751, [1e-30] * 8)]
    found = by_query(ann.nearest(frame(spark, rows)).collect())
    wanted = {q: best for (q, _), best in exact(rows).items()}
    assert found == {q: best for q, best in wanted.items() if best}
    assert found[600] == [(601, found[600][0][1]), (602, found[600][1][1])] and 650 not in found


def test_repeated_id_with_different_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    found = ann.nearest(frame(spark, rows), k=1).collect()
    assert sorted(r["vec_id"] for r in found) == [1, 2] and {r["query_id"] for r in found} == {50}


def test_empty(spark):
    assert ann.nearest(frame(spark, [])).collect() == []
    assert ann.nearest(frame(spark, [(50, [1.0])])).collect() == []


def test_pruned_edges_are_diverse():
    """No kept neighbour is much nearer to an earlier one than to the node."""
    units = ann.unit(vectors("spread", 400))
    own = np.arange(0, 400, 8)
    kept = ann.prune(units, own, np.tile(np.arange(400), (len(own), 1)), 12, 1.2)
    far = lambda a, b: float(2 - 2 * units[a] @ units[b])
    for node, row in zip(own, kept):
        row = [x for x in row if x >= 0]
        assert node not in row and len(set(row)) == len(row)
        for at, x in enumerate(row):
            assert all(1.44 * far(y, x) > far(node, x) - 1e-5 for y in row[:at])


def test_every_node_is_reached():
    for kind in ("spread", "clusters", "path"):
        edges, entries = ann.graph(vectors(kind, 1200))
        assert ann.reached(edges, entries).all()


def test_query(spark, folder):
    rows = connect(folder).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    found = by_query(entry.queries()["op11_graph_ann"](spark, folder).collect())
    wanted = {q: best for (q, _), best in exact(rows).items()}
    assert recall(found, wanted) >= 0.95 and found.keys() == wanted.keys()
