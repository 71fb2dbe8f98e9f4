from __future__ import annotations

import itertools
import random

import numpy as np
from brute import BLANKS, Groups, jaccard
from tallyhall.llm import linededup, queries


def lines_of(rows):
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            normal = line.strip(BLANKS).lower()
            if normal:
                yield i, text or "", n, normal


def expected(rows):
    """doc, text -> places that go; lines of one component, all pairs compared."""
    every = list(lines_of(rows))
    distinct = sorted({line for *_, line in every})
    sets = {line: linededup.shingles(line) for line in distinct}
    groups = Groups()
    for a, b in itertools.combinations(distinct, 2):
        if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and jaccard(sets[a], sets[b]) >= 0.8:
            groups.join(a, b)
    return every, {line: groups.find(line) for line in distinct}


def check(result, rows):
    every, home = expected(rows)
    texts = {}
    for i, text in rows:
        texts.setdefault(i, set()).add(text or "")
    kept, lost = {}, 0
    gone = {}
    for r in result:
        gone.setdefault(r["doc"], []).append((r["n_lines"], r["removed"]))
    for i, places in gone.items():
        assert len(places) == len({t for t in texts[i] if any(True for _ in lines_of([(i, t)]))})
    removed = {(i, n) for i, places in gone.items() if len(places) == 1 for n in places[0][1]}
    for i, text, n, line in set(every):
        if len(gone[i]) > 1:
            continue  # which text a row belongs to is not told here
        if (i, n) in removed:
            lost += 1
        else:
            kept.setdefault(home[line], set()).add((i, n))
    first = {}
    for i, text, n, line in every:
        key = (i is not None, i or 0)
        first[home[line]] = min(key, first.get(home[line], key))
    for component, places in kept.items():
        assert len(places) == 1 and next(iter(places))[0] == (first[component][1] if first[component][0] else None)
    return lost


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    lost = check(linededup.removals(spark.read.parquet(f"{folder}/documents.parquet")).collect(), rows)
    result = queries.op10_linededup(spark, folder).collect()
    assert lost == sum(r["n_removed"] for r in result) > 0


def cases():
    pick = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    line = lambda n: "".join(pick.choice(letters) for _ in range(n)).strip() + "."
    rows = []
    bases = [line(n) for n in (12, 40, 90, 200, 400)]
    for n in range(60):
        text = []
        for base in bases:
            chars = list(base)
            for _ in range(pick.randint(0, len(base) // 80)):
                chars[pick.randrange(len(chars))] = "*"
            text.append("".join(chars))
        text.insert(pick.randrange(5), line(pick.randint(20, 300)))
        rows.append((n, "\n".join(pick.sample(text, 4))))
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "Same\n same \nSAME"), (104, "x\n\nx\ny"), (None, bases[4]), (105, line(50_000)), (106, "É é\né É")]
    return rows


def test_edge_cases(spark):
    rows = cases()
    df = spark.createDataFrame([(i, t, len(t or ""), 5, "q") for i, t in rows], "doc_id long, text string, n_chars int, removed int, n_lines string")
    result = linededup.removals(df).collect()
    assert check(result, rows) > 100
    by = {r["doc"]: r["removed"] for r in result}
    assert by[103] == [1, 2] and by[104] == [2] and None in by
    cleaned = linededup.clean(df)
    assert cleaned.columns == df.columns and cleaned.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    back = {r["doc_id"]: r for r in cleaned.collect()}
    assert back[103]["text"] == "Same" and back[104]["text"] == "x\n\ny" and back[104]["n_chars"] == 4
    assert back[100]["text"] is None and back[101]["text"] == "" and back[102]["text"] == " \n\t"
    assert all(i in back for i, t in rows if i in by and len(by[i]) < len({n for _, _, n, _ in lines_of([(i, t)])}))


def test_repeated_rows_are_treated_alike(spark):
    df = spark.createDataFrame([(1, "a line\nb line"), (1, "a line\nb line"), (2, "b line\nc line"), (2, "other text")], "doc_id long, text string")
    assert sorted(r["text"] for r in linededup.clean(df).collect()) == ["a line\nb line", "a line\nb line", "c line", "other text"]
    assert linededup.clean(df.limit(0)).count() == 0


def test_band_keys_follow_similarity():
    """Shares of equal bands near similarity ** ROWS, and every line's keys its own, whatever stands beside it."""
    pick = random.Random(9)
    base = "".join(pick.choice("abcdefghij ") for _ in range(2000))
    other = base[:1800] + "".join(pick.choice("abcdefghij ") for _ in range(200))
    s = jaccard(linededup.shingles(base), linededup.shingles(other))
    together = linededup.band_keys(["x", base, "abc", other, "z" * 8, "é"])
    alone = [linededup.band_keys([line])[0] for line in ["x", base, "abc", other, "z" * 8, "é"]]
    assert np.array_equal(together, np.array(alone))
    assert abs((together[1] == together[3]).mean() - s**linededup.ROWS) < 0.3
    assert len({tuple(k) for k in together}) == 6


def plain_keys(line):
    """Least value of each hash function over the line's runs, folded by band, in whole numbers."""
    codes = [ord(c) for c in line]
    runs = [codes[n : n + linededup.SHINGLE] for n in range(max(1, len(codes) - linededup.SHINGLE + 1))]
    hashes = []
    for run in runs:
        h = 0
        for code in run + [0] * (linededup.SHINGLE - len(run)):
            h = (h * 0x100000001B3 + code) % 2**64
        h ^= h >> 31
        hashes.append((h * 0x9E3779B97F4A7C15 % 2**64) >> 32)
    keys = []
    for band in range(linededup.BANDS):
        key = band
        for row in range(band * linededup.ROWS, (band + 1) * linededup.ROWS):
            least = min((h * int(linededup._FACTORS[row]) + int(linededup._SHIFTS[row])) % 2**32 for h in hashes)
            key = (key ^ least) * 0x9E3779B97F4A7C15 % 2**64
            key ^= key >> 29
        keys.append(key)
    return keys


def test_band_keys_are_those_of_each_line_alone():
    """Lines of all lengths around a shingle's, characters beyond 16 bits, one line or many at once."""
    pick = random.Random(2)
    lines = ["".join(pick.choice("ab cé日\U0001f600") for _ in range(n)) for n in [1, 2, 7, 8, 9, 15, 16, 17, 40, 300] * 3]
    assert linededup.band_keys(lines).tolist() == [plain_keys(line) for line in lines]
    assert linededup.band_keys(lines[:1]).tolist() == [plain_keys(lines[0])]
    assert linededup.band_keys(lines[9:10]).tolist() == [plain_keys(lines[9])]


def test_shingles_are_exact():
    """As many runs as texts would have, and as many in common, whatever the characters; short lines are one run."""
    pick = random.Random(12)
    lines = ["a", "ab", "abcdefgh", "abcdefghi", "é", "?", "日", "日本語日本語日本", "?" * 8, "日" * 8, "\ud800abcdefghi", "a\x00", "a\x00\x00"]
    lines += ["".join(pick.choice("ab?é日") for _ in range(pick.choice([3, 8, 9, 30, 200]))) for _ in range(60)]
    plain = {line: {line[n : n + linededup.SHINGLE] for n in range(max(1, len(line) - linededup.SHINGLE + 1))} for line in lines}
    for a, b in itertools.combinations_with_replacement(lines, 2):
        one, other = linededup.shingles(a), linededup.shingles(b)
        assert (len(one), len(other), len(one & other)) == (len(plain[a]), len(plain[b]), len(plain[a] & plain[b])), (a, b)


def test_texts_are_cut_into_lines_once(spark, monkeypatch):
    """Signatures, candidates and places read written lines: no plan after the first cuts texts."""
    cut, resolve = [], linededup.resolve

    def seen(members, *rest):
        cut.append("Generate" in members._jdf.queryExecution().optimizedPlan().toString())
        return resolve(members, *rest)

    monkeypatch.setattr(linededup, "resolve", seen)
    df = spark.createDataFrame([(1, "a line here\nb line there"), (2, "b line there\nc")], "doc_id long, text string")
    assert {(r["doc"], tuple(r["removed"])) for r in linededup.removals(df).collect()} == {(1, ()), (2, (0,))}
    assert cut == [False]
