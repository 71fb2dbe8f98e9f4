"""Codes of whole-number vectors by codebooks of their parts, with dictionaries of values per dimension.

Vectors are gathered in blocks; each block holds, for every dimension, its distinct whole numbers in
order (the dictionary) and for every vector the place of its number there. To measure a block against
a codebook, the squared difference of every distinct number to all entries is tabulated once per
dimension; the distance of a part is then a gather from these tables per dimension, added up, and no
number is subtracted or squared twice. Blocks are written once and read by every round. A
round hands on sums and counts per block, added up by Spark: the driver sees one number per component of
the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhall.llm.common import finite
from tallyhall.session import saved

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
# Vectors in a block: what a task holds of them, and the most distinct numbers of a dimension.
BLOCK = 4096
# Whole numbers up to this size: squared differences of a few hundred dimensions add up within a long.
LARGEST = 1 << 27

# What a block is made of; distinct numbers of all dimensions one after another, how many each dimension has.
_BLOCK = pa.schema(
    [("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())),
     ("counts", pa.list_(pa.int32())), ("codes", pa.list_(pa.int16()))]
)
_BLOCK_FIELDS = "ids array<long>, labels array<long>, numbers array<long>, counts array<int>, codes array<short>"


def whole(vectors: DataFrame) -> DataFrame:
    """vec_id, label, numbers: rows whose vector can be coded, its components as floor(SCALE * x).

    Null and empty vectors, vectors that hold null or non-finite components, and vectors with a number beyond
    LARGEST are left out.
    """
    read = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("long").alias("label"),
        vectors["embedding"].cast("array<double>").alias("_vector"),
    )
    fits = F.forall("_vector", lambda x: F.abs(x) * SCALE < LARGEST)
    usable = finite(F.col("_vector")) & (F.size("_vector") > 0)
    numbers = F.transform("_vector", lambda x: F.floor(x * SCALE))
    return read.where(F.when(usable, fits).otherwise(False)).select("vec_id", "label", numbers.alias("numbers"))


def edges_of(length: int) -> list[int]:
    """Where the parts begin, and where the last ends; equal if the length is divisible by PARTS."""
    return [p * length // PARTS for p in range(PARTS + 1)]


def first_codebooks(numbers: DataFrame) -> list[np.ndarray]:
    """Per part, the parts of the ENTRIES vectors of the smallest vec_id (missing last; then smaller numbers), fewer if there are not so many.

    All vectors are as long as the first one; others have been left out.
    """
    rows = numbers.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(ENTRIES).select("numbers").collect()
    heads = np.array([r[0] for r in rows], np.int64)
    cuts = edges_of(heads.shape[1])
    return [heads[:, low:high].copy() for low, high in zip(cuts, cuts[1:])]


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, label, numbers) to blocks of up to BLOCK of them."""
    held: list[pa.RecordBatch] = []

    def block(rows: pa.Table) -> pa.RecordBatch:
        values = rows.column("numbers").combine_chunks()
        matrix = values.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        words, codes = [], np.empty(matrix.shape, np.int16)
        for at in range(matrix.shape[1]):
            found, codes[:, at] = np.unique(matrix[:, at], return_inverse=True)
            words.append(found)
        fields = [
            rows.column("vec_id").to_pylist(), rows.column("label").to_pylist(), np.concatenate(words),
            np.array([len(w) for w in words], np.int32), codes.ravel(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(fields, _BLOCK)], schema=_BLOCK)

    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows >= BLOCK:
            table = pa.Table.from_batches(held)
            yield block(table.slice(0, BLOCK))
            held = table.slice(BLOCK).to_batches()
            rows -= BLOCK
    if rows:
        yield block(pa.Table.from_batches(held))


class _Block:
    """A block in a task: ids, labels, and part distances by gathers from tables."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        field = lambda name: batch.column(name)[at].values
        self.ids, self.labels = field("ids"), field("labels")
        counts = field("counts").to_numpy()
        self.words = np.split(field("numbers").to_numpy(), np.cumsum(counts)[:-1])
        self.codes = field("codes").to_numpy().reshape(len(self.ids), len(counts))

    def distances(self, entries: np.ndarray, low: int) -> np.ndarray:
        """Squared distances (vectors x entries) of the part that begins at dimension low."""
        total = np.zeros((len(self.ids), len(entries)), np.int64)
        for at in range(entries.shape[1]):
            table = (self.words[low + at][:, None] - entries[None, :, at]) ** 2
            total += table[self.codes[:, low + at]]
        return total

    def assigned(self, books: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Per part: its number, its first dimension, the entry of each vector (ties to the lower) and the distance to it."""
        low = 0
        for part, entries in enumerate(books):
            far = self.distances(entries, low)
            nearest = far.argmin(axis=1)
            yield part, low, nearest, far[np.arange(len(far)), nearest]
            low += entries.shape[1]


def _sums(books: list[np.ndarray]):
    """Blocks to (part, entry, n, sums): what the vectors of each entry add up to."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows = _Block(batch, at)
                out = []
                for part, low, nearest, _ in rows.assigned(books):
                    for entry in np.unique(nearest):
                        own = nearest == entry
                        # Per dimension: how often each word occurs among them, times the word.
                        added = [
                            int(np.bincount(rows.codes[own, low + d], minlength=len(rows.words[low + d])) @ rows.words[low + d])
                            for d in range(books[part].shape[1])
                        ]
                        out.append((part, int(entry), int(own.sum()), added))
                fields = ((pa.int32()), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), fields)], names=["part", "entry", "n", "sums"])

    return sums


def _moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every entry the floored mean of its vectors, unused ones as they were."""
    partial = blocks.mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
    # One row per component of the codebooks: PARTS * ENTRIES * (length / PARTS) at most.
    means = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
    out = [b.copy() for b in books]
    for part, entry, at, n, value in means:
        out[part][entry, at] = value // n
    return out


def _coded(books: list[np.ndarray]):
    """Blocks to rows vec_id, label, code, error."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows = _Block(batch, at)
                codes, error = np.empty((len(rows.ids), len(books)), np.uint8), np.zeros(len(rows.ids), np.int64)
                for part, _, nearest, far in rows.assigned(books):
                    codes[:, part] = nearest
                    error += far
                text = [bytes(c).hex() for c in codes]
                yield pa.RecordBatch.from_arrays([rows.ids, rows.labels, pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return coded


def fit(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """Blocks of the coded vectors, as a written table, and the codebooks after ROUNDS rounds over all of them.

    Vectors of another length than that of the smallest vec_id are left out; without any vector there are no codebooks.
    """
    numbers = saved(whole(vectors))
    first = numbers.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(1).collect()
    if not first:
        return numbers.mapInArrow(_dictionaries, _BLOCK_FIELDS), []
    numbers = numbers.where(F.size("numbers") == len(first[0]["numbers"]))
    blocks = saved(numbers.select("vec_id", "label", "numbers").mapInArrow(_dictionaries, _BLOCK_FIELDS))
    books = first_codebooks(numbers)
    for _ in range(ROUNDS):
        books = _moved(blocks, books)
    return blocks, books


def codes(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits per part), error (squared distance to the entries), a row per vector of the blocks."""
    return blocks.mapInArrow(_coded(books), "vec_id long, label long, code string, error long")


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row per vector that can be coded (see whole() and fit()).

    label_error adds up the errors of equal labels, missing ones together; null if the sum is no long. The labels' sums are merged
    before they are shuffled and joined back, so a label of a third of all rows is no one task's. Rows that repeat a
    vec_id count as often as they occur, a missing vec_id is larger than any. An empty table gives none.
    """
    blocks, books = fit(vectors)
    coded = saved(codes(blocks, books))
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    labels = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    joined = coded.join(labels, coded["label"].eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
