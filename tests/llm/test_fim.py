from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import connect, differences
from tallyhall.llm import fim


def brute(doc_id, text):
    """The contract, step by step: units by a loop."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_edges(spark, documents):
    """Null, empty, very long and repeated texts, letters beyond ASCII, marks in the text, missing ids, odd extra columns."""
    odd = [(100, "a <P> b"), (101, "<M>"), (102, "𝒳é\U0001f600 a\r\n\x00b"), (None, None), (None, "x1y" * 9), (-7, "ab cd"), (-7, "ab cd")]
    odd += [(200 + n, "word " * n + "Ü,ß") for n in range(150)]
    extra = spark.createDataFrame([(i, t, 1, "n") for i, t in odd], "doc_id long, text string, n int, form string")
    docs = documents.select("doc_id", "text", "n", F.col("words").alias("form")).unionByName(extra)
    found = fim.transform(docs)
    told = found.select("*", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: str(r)
    assert sorted((tuple(r)[:6] for r in told), key=key) == sorted((brute(*g) for g in given), key=key)
    assert sorted(r["back"] for r in told) == sorted(t or "" for _, t in given)
    assert {r["form"] for r in told} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("text", ["ab, c\n" * 200_000, "a" * 1_000_000, "," * 300_000])
def test_long_text(text):
    assert (6, *fim.cut(text, 6)) == brute(6, text)


def test_query_equals_sql(spark, folder):
    name = "op13_fill_in_middle"
    assert differences(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) == []
