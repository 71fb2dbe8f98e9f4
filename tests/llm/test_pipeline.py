"""Each stage on what its predecessor kept, and the whole."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as pipeline
import pytest
from brute import words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        result = pipeline.saved(stage(spark, docs, FOLDER))
        out.append((name, docs, result))
        docs = result
    return out


def test_columns_and_order(stages):
    assert [name for name, *_ in stages] == ["quality", "lines", "near_duplicates", "benchmark_leaks", "packed"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_each_stage_decides(spark, stages):
    by = {name: (before, after) for name, before, after in stages}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = map(ids, by["quality"])
    good = {i for i in before if labels.get(i) == (1, 0)}
    assert len(good - after) <= 0.05 * len(good) and {i for i in before - after if i in labels} - good
    for name in ("lines", "near_duplicates", "benchmark_leaks"):
        before, after = map(ids, by[name])
        assert after <= before
    before, after = by["lines"]
    texts = lambda df: [line for r in df.collect() for line in (r["text"] or "").split("\n") if line.strip()]
    assert len(set(texts(after))) == len(texts(after)) < len(texts(before))


def test_run_packs_what_is_left(spark, stages):
    _, docs, packed = stages[-1]
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    whole = pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, packed.collect()))


def marks(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def nothing_known(spark, tmp_path_factory):
    """A folder with empty labels and an empty benchmark."""
    folder = tmp_path_factory.mktemp("empty")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_edge_cases_in_every_stage(spark, documents):
    """Nulls, empty and very long texts, repeated rows, more columns: nothing crashes, nothing is made up."""
    docs = documents.unionByName(documents.where("doc_id IN (5, 7) OR doc_id IS NULL"))
    before = marks(docs)
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.dtypes == docs.dtypes, name
        if name != "lines":
            assert marks(after) <= before, name
    packed = pipeline.packed(spark, docs, FOLDER).collect()
    count = lambda t: len(words(t))
    assert sum(r["size"] for r in packed) == sum(n * count(t) for (_, t), n in before.items())
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(i for i, _ in before.elements())


def test_lines_and_near_duplicates_on_edge_cases(spark, documents):
    kept = {r["doc_id"]: r["text"] for r in pipeline.lines(spark, documents, FOLDER).where("doc_id IN (4, 5, 6, 10)").collect()}
    assert kept[4] is None and kept[5] == "" and kept[6] == " \t\n"
    assert len(kept[10].split("\n")) == 2  # five equal lines, then another one
    stay = marks(pipeline.near_duplicates(spark, documents, FOLDER))
    assert [i for i, _ in stay if i in (1, 2, 3)] == [1] and [i for i, _ in stay if i in (4, 5, 6)] == [4]


def test_empty_tables_in_every_stage(spark, documents, nothing_known):
    for name, stage in pipeline.STAGES:
        assert stage(spark, documents.limit(0), FOLDER).count() == 0, name
    for stage in (pipeline.quality, pipeline.benchmark_leaks):
        assert marks(stage(spark, documents, nothing_known)) == marks(documents)
