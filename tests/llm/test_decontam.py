from __future__ import annotations

import random
from collections import Counter

import regex
from tallyhall.llm import decontam, queries

WORD = regex.compile(r"[\p{L}\p{N}]+")


def normal(text):
    return WORD.findall((text or "").lower())


def alike(a, b, k):
    runs = lambda w: Counter(tuple(w[n : n + k]) for n in range(max(1, len(w) - k + 1)))
    a, b = runs(a), runs(b)
    return sum((a & b).values()) / sum((a | b).values())


def expected(docs, items, similarity=0.8):
    """Every window of the item's length, clipped at the ends, by exact similarity."""
    out = {}
    for i, text in docs:
        w = normal(text)
        for j, item in items:
            b = normal(item)
            if not b:
                continue
            runs = {tuple(b[n : n + min(5, len(b))]) for n in range(max(1, len(b) - 4))}
            k = min(5, len(b))
            if not any(tuple(w[n : n + k]) in runs for n in range(len(w) - k + 1)):
                continue
            best = max(alike(w[max(0, s) : s + len(b)], b, k) for s in range(-len(b) + k, len(w)) if w[max(0, s) : s + len(b)])
            if best >= similarity:
                out[i, j] = max(best, out.get((i, j), 0))
    return out


def found(df):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in df.collect()}


def same(a, b):
    assert set(a) == set(b)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_query(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = expected(docs, items)
    assert wanted
    same(found(queries.op9_decontam(spark, folder)), wanted)


def test_edge_cases(spark):
    pick = random.Random(8)
    vocabulary = [f"v{n}" for n in range(500)]
    prose = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items = [(n, " ".join(prose(pick.randint(20, 57)))) for n in range(25)]
    items += [(100, "Short one here"), (101, "yes"), (102, None), (103, "..."), (104, items[0][1]), (105, " ".join(["the cat sat on the mat"] * 6)), (106, " ".join(prose(400)))]
    docs = []
    for n, (_, text) in enumerate(items):
        if text is None:
            continue
        inner = text.split()
        if n % 4 == 1 and len(inner) > 30:
            inner = inner[3:]
        if n % 4 == 2 and len(inner) > 50:
            inner[len(inner) // 2] = "changed"
        if n % 4 == 3:
            inner = [w.upper() + ("," if m % 5 == 0 else "") for m, w in enumerate(inner)]
        docs.append((n, " ".join([*prose(30), *inner, *prose(30)])))
    docs += [(200, docs[0][1]), (200, docs[0][1]), (None, docs[4][1]), (201, None), (202, ""), (203, "short ONE, here!"), (204, "yes yes"), (205, " ".join(prose(20000)))]
    docs += [(300 + n, " ".join(prose(200))) for n in range(5)] + [(400, items[3][1][:-40]), (401, " ".join(items[5][1].split()[2:]))]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, m int, window string")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    wanted = expected(docs, items)
    same(found(decontam.leaks(df, bench)), wanted)
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns
    bad = {i for i, _ in wanted}
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, _ in docs if i not in bad)
    assert decontam.leaks(df, bench.limit(0)).count() == 0
    assert decontam.leaks(df.limit(0), bench).count() == 0


def test_shuffled_anchors(spark, folder, monkeypatch):
    usual = found(queries.op9_decontam(spark, folder))
    monkeypatch.setattr(decontam, "BROADCAST_ANCHORS", 0)
    same(found(queries.op9_decontam(spark, folder)), usual)


def test_no_python_on_the_way(spark, folder):
    plan = queries.op9_decontam(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reordered_and_shifted_items(spark):
    """Leaked items whose shared shingles stand at other places than the item's own."""
    pick = random.Random(21)
    vocabulary = [f"v{n}" for n in range(4000)]
    prose = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items, docs = [], []
    for n in range(12):
        item = prose(70 + 10 * (n % 3))
        inner = list(item)
        if n % 4 == 0:  # halves swapped
            inner = inner[30:] + inner[:30]
        elif n % 4 == 1:  # an insertion and a deletion around a shifted middle
            inner = [*inner[:3], "new", *inner[3:-4], *inner[-3:]]
        elif n % 4 == 2:  # the last words first
            inner = inner[-9:] + inner[:-9]
        else:  # at the very end of the document, cut
            inner = inner[:-5]
        items.append((n, " ".join(item)))
        docs.append((n, " ".join([*prose(40), *inner, *(prose(40) if n % 4 != 3 else [])])))
    wanted = expected(docs, items)
    assert len(wanted) == 12
    bench = spark.createDataFrame(items, "item_id long, text string")
    same(found(decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench)), wanted)


def test_clean_decides_row_by_row(spark):
    """Rows that share a doc_id with a leaking row, or have none as it has, stay."""
    item = " ".join(f"i{n}" for n in range(30))
    rows = [(None, f"x y {item}"), (None, "clean text"), (None, None), (1, item), (1, "clean too"), (2, item), (2, item), (3, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    kept = sorted(map(tuple, decontam.clean(docs, bench).collect()), key=str)
    assert kept == sorted((r for r in rows if "i7" not in (r[1] or "")), key=str)
