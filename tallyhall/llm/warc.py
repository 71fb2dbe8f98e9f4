"""Web archives of Zstandard frames that share a dictionary.

An archive file is a skippable frame holding the dictionary, then one frame per WARC record.
Spark's text writer commits the files, so that any store it can write to will do and a task
that runs twice leaves one file. Its row separator is an empty skippable frame, which a
reader of Zstandard passes over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.session import saved

# First bytes of the skippable frame that holds a dictionary, and of an ordinary skippable frame.
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The dictionary is built from so many records, chosen by hash of the id, none larger than this.
SAMPLE_RECORDS = 400
SAMPLE_RECORD_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
# Shared digests, about 60 bytes each, are sent to every task up to this number.
BROADCAST_DIGESTS = 200_000
# A reader feeds a frame's bytes to the decompressor in steps of so many.
STEP = 16 << 10
# Tasks hand on records in groups of about so many bytes.
FLUSH_BYTES = 4 << 20


def roles(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, a row per page.

    Of pages with equal payloads of at least `least_bytes`, the one with the largest page_id is
    the response and the others are revisits of it; smaller payloads are always responses. Rows
    that repeat the largest page_id are responses too; a missing page_id is a revisit of any
    other. Missing html is an empty payload.

    A payload held by a third of all pages meets in the counts only, which are merged before
    they are shuffled. Digests that pages share are saved and counted: up to BROADCAST_DIGESTS of them go to
    every task, so that payloads stay where they are; more are joined by a shuffle, whose large side Spark may split.
    """
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    large = read.where(F.col("payload_bytes") >= least_bytes)
    shared = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    shared = saved(shared.where("n > 1").drop("n"))
    few = shared.count() <= BROADCAST_DIGESTS
    joined = read.join(F.broadcast(shared) if few else shared, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload, payload_bytes, digest, refers_to, date: str) -> bytes:
    """One WARC record, a response with its payload or a revisit without."""
    revisit = payload is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    block = http.encode() + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: DataFrame, date: str) -> bytes:
    """A dictionary trained on a bounded sample of records; empty without any.

    Too few or too small samples for training give their bytes themselves as the dictionary.
    """
    sample = records.where(F.length("payload") <= SAMPLE_RECORD_BYTES)
    chosen = sample.orderBy(F.xxhash64("page_id", "payload_digest"), "page_id").limit(SAMPLE_RECORDS)
    rows = chosen.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to").collect()
    samples = [record(*(bytes(x) if isinstance(x, bytearray) else x for x in row), date) for row in rows]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _writer(dictionary: bytes, level: int, date: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=True)
        out = [DICTIONARY_FRAME + struct.pack("<I", len(dictionary)) + dictionary]
        for batch in batches:
            size = 0
            rows = batch.astype(object).where(batch.notna(), None).itertuples(index=False)
            for page_id, url, payload, n, digest, refers_to in rows:
                ids = [None if x is None else int(x) for x in (page_id, refers_to)]
                out.append(packer.compress(record(ids[0], url, payload, int(n), digest, ids[1], date)))
                size += len(out[-1])
                if size > FLUSH_BYTES:
                    yield pd.DataFrame({"frame": out})
                    out, size = [], 0
            if out:
                yield pd.DataFrame({"frame": out})
                out = []

    return write


def write_archives(records: DataFrame, out: str, name: str = "pages", level: int = 3, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write records (as from roles()) to out/<name>-NNNNN.warc.zst, one file per task."""
    dictionary = build_dictionary(records, date)
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
    # Ids travel as text: a missing one would turn a column of numbers into floating point.
    thin = records.select(*[F.col(c).cast("string") if c in ("page_id", "refers_to") else F.col(c) for c in columns])
    frames = thin.mapInPandas(_writer(dictionary, level, date), "frame binary")
    frames.select(F.col("frame").cast("string").alias("frame")).write.option("lineSep", EMPTY_FRAME).text(out)
    spark = records.sparkSession
    files = spark._jvm.org.apache.hadoop.fs
    folder = files.Path(out)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in store.listStatus(folder):
        part = re.match(r"part-(\d+)-", entry.getPath().getName())
        if part:
            store.rename(entry.getPath(), files.Path(folder, f"{name}-{part[1]}.warc.zst"))


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive file, decompressed one by one."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = data[at : at + 4]
        if magic[1:] == DICTIONARY_FRAME[1:] and 0x50 <= magic[0] <= 0x5F:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if magic == DICTIONARY_FRAME and size:
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[at + 8 : at + 8 + size]))
            at += 8 + size
            continue
        frame, out = unpacker.decompressobj(), []
        while not frame.eof:
            step = data[at : at + STEP]
            if not step:
                raise ValueError("an archive file ends within a record")
            out.append(frame.decompress(step))
            at += len(step)
        at -= len(frame.unused_data)
        yield b"".join(out)


def parse(whole: bytes) -> dict:
    """Fields of a record; a response's digest and length are taken from its payload."""
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda key: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(key, ""))) else None
    revisit = fields["WARC-Type"] == "revisit"
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if not revisit and (hashlib.sha1(payload).hexdigest(), len(payload)) != (stated, size):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": stated,
        "refers_to": number("WARC-Refers-To"), "payload": None if revisit else payload,
    }


RECORD_FIELDS = {
    "page_id": "long", "url": "string", "record_type": "string", "payload_bytes": "long",
    "payload_digest": "string", "refers_to": "long", "payload": "binary",
}


def _reader(columns: list[str]):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for whole in frames(content):
                    rows.append(parse(whole))
                    size += len(whole)
                    if size > FLUSH_BYTES:
                        yield _frame(rows, columns)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows, columns)

    return read


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    kinds = {"long": "Int64"}
    return pd.DataFrame({c: pd.array([r[c] for r in rows], kinds.get(RECORD_FIELDS[c], object)) for c in columns})


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A row per record of the archives below path; payload is null for revisits."""
    columns = columns or list(RECORD_FIELDS)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).select("content")
    return files.mapInPandas(_reader(columns), ", ".join(f"{c} {RECORD_FIELDS[c]}" for c in columns))
