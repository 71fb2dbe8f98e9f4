"""Ids against the tokenizer itself, read back from the files."""

from __future__ import annotations

import zlib
from array import array

import public_tokenizers
from pyspark.sql import functions as F
from tallyhall.llm import queries, token_orc
from tallyhall.session import shared_dir
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = array("I", [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def found(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op8_token_orc(spark, folder)) == expected(rows)


def test_edge_cases(spark, documents):
    out = shared_dir(spark)
    token_orc.write_token_orc(documents, out, PATH)
    assert found(token_orc.token_index(spark, out)) == expected(documents.select("doc_id", "text").collect())
    one = token_orc.read_token_orc(spark, out).where(F.col("doc_id") == 12)
    assert "EqualTo(doc_id,12)" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_a_third_of_the_rows_without_id(spark):
    """They are split over tasks, and the order by id and text holds over all files."""
    rows = [(None, f"text {n % 40} {'x' * 80} {n}") for n in range(400)] + [(n, f"other {n}") for n in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = shared_dir(spark)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # else Spark merges so few rows into one task
    spark.conf.set(merge, "false")
    try:
        token_orc.write_token_orc(df, out, PATH)
    finally:
        spark.conf.unset(merge)
    assert found(token_orc.token_index(spark, out)) == expected(rows)
    files = token_orc.read_token_orc(spark, out).where("doc_id IS NULL").select(F.input_file_name()).distinct()
    assert files.count() > 1


def test_no_rows(spark, documents):
    out = shared_dir(spark)
    token_orc.write_token_orc(documents.limit(0), out, PATH)
    assert token_orc.token_index(spark, out).count() == 0


def test_blanks_in_every_place():
    memo = token_orc.PieceMemo(PATH)
    texts = [
        "a b", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "a\n b", "\n", "it's they'll.", "x, y! z?", "é b c", "a\tb c\r\nd",
        "</s> <|endoftext|> x", "1,000.5 a1.b2", "a\x1cb c\x1c d", "  ", "A.\nB. C", "　x y", "'s 's", "a. b.. c.", "日本 語。 x",
    ]
    for text in texts:
        assert array("I", memo.encode(text)).tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_are_single_ids(spark):
    """Against the tokenizer as it is loaded, no flag changed."""
    untouched = Tokenizer.from_file(PATH)
    end = "<|endoftext|>"
    texts = [end, f"a{end}b c", f"a {end} b", f"{end}{end}", f"x\n{end}\n y  z", f"no tokens <|endof text|> here{end[:-1]}", f" {end}", f"it{end}'s"]
    memo = token_orc.PieceMemo(PATH)
    for text in texts:
        assert array("I", memo.encode(text)).tolist() == untouched.encode(text, add_special_tokens=False).ids, text
    out = shared_dir(spark)
    token_orc.write_token_orc(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), out, PATH)
    wanted, start = [], 0
    for n, text in enumerate(texts):
        ids = array("I", [*untouched.encode(text, add_special_tokens=False).ids, 0])
        wanted.append((n, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found(token_orc.token_index(spark, out)) == wanted


def test_ids_are_read_once(spark):
    """Lengths and checksums are written; starts are found without another look at the ids."""
    out = shared_dir(spark)
    token_orc.write_token_orc(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"), out, PATH)
    index = token_orc.token_index(spark, out)
    assert found(index) == expected([(1, "a b"), (2, "c")])
    assert "MapInArrow" not in index._jdf.queryExecution().optimizedPlan().toString()
