from __future__ import annotations

import itertools
import random

import pytest
from brute import Groups, fingerprint, jaccard, lower, shingles, words
from hypothesis import given, strategies as st
from pyspark.sql import functions as F
from tallyhall.llm import graph, pairs, queries, simhash

SIGN = 1 << 64


def expected(rows, size=3, radius=3):
    prints = [(i, fingerprint(t, size)) for i, t in rows]
    groups, distinct = Groups(), sorted({p for _, p in prints})
    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= radius:
            groups.join(a, b)
    least = {}
    for i, p in prints:
        root = groups.find(p)
        if i is not None:
            least[root] = min(i, least.get(root, i))
    return sorted(((i, f"{p:016x}", least.get(groups.find(p))) for i, p in prints), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op1_simhash(spark, folder)) == expected(rows)


def test_edge_cases(spark, documents):
    assert found(simhash.classes(documents)) == expected(documents.select("doc_id", "text").collect())
    assert simhash.classes(documents.limit(0)).count() == 0


@given(st.integers(0, SIGN - 1), st.sampled_from([1, 3, 5, 6, 7]), st.data())
def test_masks_cover_the_radius(x, radius, data):
    bits = data.draw(st.lists(st.integers(0, 63), max_size=radius, unique=True))
    y = x ^ sum(1 << b for b in bits)
    assert any((x & m) == (y & m) for m in (m % SIGN for m in simhash.masks(radius)))


def test_masks_keep_bits():
    for radius in (1, 3, 5, 6, 7):
        assert min((m % SIGN).bit_count() for m in simhash.masks(radius)) >= 28
    with pytest.raises(ValueError):
        simhash.masks(8)


@pytest.mark.parametrize("small", [128, 2])
def test_links_join_all_within_radius(spark, monkeypatch, small):
    """Large buckets, too, without comparing pairs: a dense ball of fingerprints around a few centres."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    pick = random.Random(5)
    centres = [pick.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in pick.sample(range(10), pick.randint(0, 6))) for c in centres for _ in range(60)} | {0}
    signed = {p - SIGN if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    groups = Groups()
    for a, b in itertools.combinations(sorted(signed), 2):
        if (a ^ b & SIGN - 1 if False else ((a ^ b) % SIGN)).bit_count() <= 3:
            groups.join(a, b)
    result = {r["node"]: r["component"] for r in graph.components(simhash.links(df, 3)).collect()}
    assert {p: result.get(p, p) for p in signed} == {p: groups.find(p) for p in signed}


def test_components(spark):
    pick = random.Random(1)
    chain = [(n, n + 1) for n in range(60)]
    star = [(1000, n) for n in range(1001, 1200)]
    loose = [(pick.randint(2000, 2100), pick.randint(2000, 2100)) for _ in range(70)]
    links = [*chain, *star, *loose, (5, 5), (7, 6), (6, 7)]
    groups = Groups()
    for a, b in links:
        groups.join(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    result = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert result == {n: groups.find(n) for n in {x for a, b in links if a != b for x in (a, b)}}
    assert graph.components(df.limit(0)).count() == 0


def copies(pick, count=14):
    """Base texts with copies in which a few words are changed."""
    vocabulary = [f"w{n}" for n in range(3000)]
    rows, key = [], 0
    for size in (40, 120, 400):
        for _ in range(3):
            base = [pick.choice(vocabulary) for _ in range(size)]
            for n in range(count):
                text = list(base)
                for _ in range(pick.randint(0, max(1, size // 60))):
                    text[pick.randrange(size)] = pick.choice(vocabulary)
                rows.append((key, " ".join(text)))
                key += 1
    return rows


def test_near_duplicates(spark):
    rows = copies(random.Random(2)) + [(900, None), (901, ""), (902, "a"), (903, "a"), (None, "b c"), (904, "b c")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, stays int")
    sets = {t or "": set(shingles(words(lower(t)), 5)) for _, t in rows}
    prints = {t: fingerprint(t, 2) for t in sets}
    near, alike = Groups(), Groups()  # what must be joined, and what may be
    close = [(t, u) for t, u in itertools.combinations(sets, 2) if sets[t] and jaccard(sets[t], sets[u]) >= 0.8]
    for t, u in close:
        alike.join(t, u)
        if (prints[t] ^ prints[u]).bit_count() <= 7:
            near.join(t, u)
    result = simhash.near_duplicates(df).collect()
    texts = dict(rows)
    home = {texts[r["doc_id"]] or "": r["component_id"] for r in result}
    for t, u in itertools.combinations(sets, 2):
        if near.find(t) == near.find(u):
            assert home[t] == home[u]
        if home[t] == home[u]:
            assert alike.find(t) == alike.find(u)
    assert sum(home[t] == home[u] for t, u in close) >= 0.95 * len(close) > 0
    least = {}
    for r in result:
        if r["doc_id"] is not None:
            least[r["component_id"]] = min(r["doc_id"], least.get(r["component_id"], r["doc_id"]))
    assert all(r["component_id"] == least[r["component_id"]] for r in result)
    kept = simhash.clean(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))


def test_blocks_join_like_all_pairs():
    """Sets of few and of many members, in one block and in two, against all pairs."""
    pick = random.Random(7)
    for many in (5, 60):
        base = [set(range(1000 * k, 1000 * k + 40)) for k in range(3)]
        sets = [set(pick.sample(sorted(pick.choice(base)), 34)) | {pick.randrange(10**6) for _ in range(pick.randint(0, 8))} for _ in range(many)]
        for two in (False, True):
            blocks = [pick.randrange(2) if two else 0 for _ in sets]
            parts = [pick.choice([n, n // 2 * 2]) for n in range(many)]
            wanted, got = Groups(), Groups()
            for n, p in enumerate(parts):
                wanted.join(n, p)
                got.join(n, p)
            for m, n in itertools.combinations(range(many), 2):
                if jaccard(sets[m], sets[n]) >= 0.8 and not (len(set(blocks)) > 1 and blocks[m] == blocks[n]):
                    wanted.join(m, n)
            for m, n in pairs.joined(sets, parts, blocks, 0.8):
                assert jaccard(sets[m], sets[n]) >= 0.8
                got.join(m, n)
            assert [wanted.find(n) for n in range(many)] == [got.find(n) for n in range(many)]


def test_near_duplicates_of_nothing(spark, documents):
    assert simhash.clean(documents.limit(0)).count() == 0
    assert simhash.clean(documents).where("doc_id IN (1, 2)").count() == 1


def test_near_duplicates_of_every_kind_of_edit(spark):
    """Isolated pairs, 0.8 to 0.9 alike, whose difference stands in one block: nothing chains what candidates miss."""
    pick = random.Random(11)
    vocabulary = [f"w{n}" for n in range(5000)]
    prose = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    rows = []
    for n in range(180):
        base = prose(300)
        if n % 3 == 0:  # a paragraph appended
            other = base + prose(pick.randint(34, 73))
        elif n % 3 == 1:  # a block replaced
            many, at = pick.randint(13, 28), pick.randint(0, 250)
            other = base[:at] + prose(many) + base[at + many :]
        else:  # one word of a short text
            base = base[:52]
            other = base[:26] + ["changed"] + base[27:]
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    texts = dict(rows)
    sets = {i: set(shingles(words(t), 5)) for i, t in texts.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    home = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    close = [n for n in range(180) if jaccard(sets[2 * n], sets[2 * n + 1]) >= 0.8]
    assert len(close) > 150
    assert [n for n in close if home[2 * n + 1] != 2 * n] == []


@pytest.mark.parametrize("words_each, rows", [(32768, 1), (65536, 1), (66000, 2), (200_000, 1), (3, 70_000)])
def test_long_and_repeated_texts(spark, words_each, rows):
    """Counters hold any text and any number of equal rows, with and without an id."""
    pick = random.Random(words_each)
    text = " ".join(str(pick.randrange(10**6)) for _ in range(words_each))
    given_rows = [(1, text)] + [(None, text)] * (rows > 2) + [(2, "another text of five words")]
    docs = spark.createDataFrame(given_rows, "doc_id long, text string")
    docs = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.when(F.col("text") == text, rows).otherwise(1)))).drop("col").coalesce(1)
    found = simhash.classes(docs).groupBy("doc_id", "fingerprint").count().collect()
    assert {(r.doc_id, r.fingerprint): r["count"] for r in found} == {
        (i, f"{fingerprint(t, 3):016x}"): rows if t == text else 1 for i, t in given_rows
    }


@pytest.mark.parametrize("small", [128, 2])
def test_near_duplicates_meet_by_fingerprint(spark, monkeypatch, small):
    """Any two texts within three bits share a bucket, in small and in large buckets of the masks, and resolve() is given it."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rows = copies(random.Random(5))[:120] + [(900, ""), (901, " "), (902, "a b")]
    texts = sorted({t for _, t in rows})
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "text_id long, text string")
    homes = {}
    for r in simhash.meetings(df).collect():
        homes.setdefault(r["id"], set()).add(r["bucket"])
    prints = [fingerprint(t, 3) for t in texts]
    near = [(m, n) for m, n in itertools.combinations(range(len(texts)), 2) if (prints[m] ^ prints[n]).bit_count() <= 3]
    assert len(near) > 3
    assert [(m, n) for m, n in near if not homes[m] & homes[n]] == []

    given, resolve = [], simhash.resolve

    def seen(members, *rest):
        given.append(members)
        return resolve(members, *rest)

    monkeypatch.setattr(simhash, "resolve", seen)
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == len(texts)
    buckets = {r["bucket"] for r in given[0].select("bucket").distinct().collect()}
    assert set().union(*homes.values()) <= buckets
