"""Archives written and read back, against hashes made in Python."""

from __future__ import annotations

import hashlib
import os

import zstandard
from tallyhall.llm import queries, warc
from tallyhall.session import shared_dir


def expected(rows, least=1000):
    payloads = [(i, (h or "").encode()) for i, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = max(i, first.get(p, i))
    out = []
    for i, p in payloads:
        again = len(p) >= least and p in first and first[p] != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()
    assert found(queries.op2_warc(spark, folder)) == expected(rows)


def test_edge_cases(spark):
    big, bigger = "é" * 600, "P*M\x18\0\0\0\0" * 300 + "\r\n\r\nWARC/1.1"
    rows = [(1, big), (2, big), (3, big), (4, "small"), (5, "small"), (6, None), (7, ""), (None, big), (None, bigger), (8, bigger), (8, bigger), (9, bigger), (10, "x" * 3_000_000)]
    pages = spark.createDataFrame([(i, "http://a/ b\r\n" if n % 2 else None, h, "z") for n, (i, h) in enumerate(rows)], "page_id long, url string, html string, payload string")
    out = shared_dir(spark)
    warc.write_archives(warc.roles(pages), out)
    back = warc.read_archives(spark, out)
    assert found(back) == expected(rows)
    texts = {r["page_id"]: bytes(r["payload"]) for r in back.collect() if r["record_type"] == "response" and r["page_id"]}
    assert texts[10] == b"x" * 3_000_000 and texts[9] == bigger.encode()


def test_files_are_plain_zstandard(spark, folder):
    """Any reader that knows the dictionary's frame can read a file."""
    out = shared_dir(spark).removeprefix("file://")
    warc.write_archives(warc.roles(spark.read.parquet(f"{folder}/pages.parquet")), out)
    name = next(n for n in sorted(os.listdir(out)) if n.endswith(".warc.zst"))
    data = open(f"{out}/{name}", "rb").read()
    size = int.from_bytes(data[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    whole = reader.stream_reader(data[8 + size :], read_across_frames=True).read()
    assert data[:4] == warc.DICTIONARY_FRAME and whole.count(b"WARC/1.1\r\n") == len(list(warc.frames(data)))
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in warc.frames(data))
    assert len(data) - size < plain


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    out = shared_dir(spark)
    warc.write_archives(warc.roles(pages), out)
    assert warc.read_archives(spark, out).count() == 0
