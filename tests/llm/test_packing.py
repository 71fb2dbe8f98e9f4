from __future__ import annotations

from collections import defaultdict

from brute import Groups, fingerprint
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tallyhall.llm import packing, queries
from tallyhall.llm.common import words


def checked(rows, info, capacity):
    """Every unit packed once, no bin too full, no conflict within a bin."""
    bins, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        covered[r["doc_id"]].append((r["start"], r["size"]))
    for held in bins.values():
        spans = sorted((r["offset"], r["size"]) for r in held)
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= capacity
        for k in (0, 1):
            marks = [info[r["doc_id"]][k] for r in held if info[r["doc_id"]][k] is not None]
            assert len(marks) == len(set(marks))
    for key, spans in covered.items():
        spans.sort()
        assert [a for a, _ in spans] == [n * capacity for n in range(len(spans))] and sum(n for _, n in spans) == info[key][2]


def clusters(texts):
    """Each text's class of five-word fingerprints within three bits, pair by pair; None without words."""
    prints = {t: fingerprint(t, 5) for t in texts if t and t.strip(" \t\n\x0b\f\r")}
    groups, distinct = Groups(), sorted(set(prints.values()))
    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            if (a ^ b).bit_count() <= 3:
                groups.join(a, b)
    return {t: groups.find(prints[t]) if t in prints else None for t in texts}


def test_clusters_against_brute_force(spark, documents):
    """Copies, near copies, null and empty texts, repeated rows."""
    long = " ".join(f"u{n}" for n in range(3000))
    near = spark.createDataFrame([(900, long), (901, long + " tail"), (902, long), (902, long), (None, long)], "doc_id long, text string")
    every = documents.unionByName(near, allowMissingColumns=True)
    rows = every.select("doc_id", "text").collect()
    wanted = clusters([r["text"] for r in rows])
    assert wanted[long] == wanted[long + " tail"]
    got = packing.clustered(every).join(every.select("doc_id", "text"), "doc_id").where("doc_id != 9").collect()
    name = {}
    for r in got:
        assert (r["cluster"] is None) == (wanted[r["text"]] is None)
        assert name.setdefault(wanted[r["text"]], r["cluster"]) == r["cluster"]
    assert len(set(name.values())) == len(name)
    assert packing.clustered(every).count() == len(rows)
    assert packing.clustered(documents.limit(0)).count() == 0


def test_query(spark, folder):
    rows = queries.op6_packing(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    cluster = clusters([r["text"] for r in docs])
    info = {r["doc_id"]: (r["source"], cluster[r["text"]], len(r["text"].split())) for r in docs}
    assert {r["doc_id"] for r in rows} == set(info)
    checked(rows, info, queries.SEQUENCE_WORDS)


def test_edge_cases(spark, documents):
    docs = documents.where("doc_id IS NOT NULL AND NOT (doc_id = 9 AND n_chars < 5000)")
    parts = packing.pieces(docs, F.size(words(F.col("text"))), F.xxhash64("text"), 64)
    rows = packing.pack(parts, 64).collect()
    blanks = " \t\n\x0b\f\r"
    count = lambda t: len([w for w in (t or "").translate({ord(c): " " for c in blanks}).split(" ") if w])
    info = {r["doc_id"]: (r["source"], r["text"], count(r["text"])) for r in docs.collect()}
    checked(rows, info, 64)
    every = packing.pack(packing.pieces(documents, F.size(words(F.col("text"))), F.xxhash64("text"), 64), 64)
    assert every.agg(F.sum("size")).first()[0] == documents.select(F.sum(F.size(words(F.col("text"))))).first()[0]
    assert packing.pack(parts.limit(0), 64).count() == 0


def brute(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] >= size and b[0] > 0 and not (b[1] & source or b[2] & cluster)]
        if fits:
            home = min(fits)[1]
        else:
            home = len(bins)
            bins.append([capacity, 0, 0])
        bins[home] = [bins[home][0] - size, bins[home][1] | source, bins[home][2] | cluster]
        out.append(home)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3), st.integers(0, 4)), max_size=60))
def test_best_fit_is_the_tightest_compatible_bin(items):
    items.sort(reverse=True)
    sizes = [a for a, _, _ in items]
    sources, clusters = [(1 << s) >> 1 for _, s, _ in items], [(1 << c) >> 1 for _, _, c in items]
    assert packing.best_fit(sizes, sources, clusters, 20)[0] == brute(sizes, sources, clusters, 20)
