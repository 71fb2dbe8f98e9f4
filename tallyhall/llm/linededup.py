"""Fuzzy duplicate lines: MinHash bands, exact Jaccard similarity, union-find, one line kept per component.

A line's shingles are runs of SHINGLE characters (code points) of the line, lower-cased,
blanks at its ends taken off; a shorter line is one shingle. Signatures are made
where the text is read, and only band keys are shuffled: text moves once, to verify
candidates. At the similarity asked for, the bands miss one pair in 5,000; at more, fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.llm.common import BLANKS
from tallyhall.llm.pairs import few_to_all, resolve
from tallyhall.session import saved

SHINGLE = 8  # a power of two: runs are hashed by doubling
BANDS, ROWS = 16, 4
SIMILARITY = 0.8
# Characters whose signatures are made at once.
BLOCK = 1 << 17
_PICK = np.random.default_rng(20240607)  # any fixed seed: signatures must agree between tasks
_FACTORS = _PICK.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _PICK.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def _run_hashes(codes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the SHINGLE code points that begin at each place (the last ones run into zeros)."""
    h = np.concatenate([codes, np.zeros(SHINGLE - 1, np.uint32)]).astype(np.uint64)
    width, factor = 1, 0x100000001B3
    while width < SHINGLE:  # hashes of runs twice as long from those of two neighbours
        longer = h[:-width] * np.uint64(factor)
        longer += h[width:]
        h, width, factor = longer, 2 * width, factor * factor % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(32)).astype(np.uint32)


def band_keys(lines: list[str]) -> np.ndarray:
    """For each line (none empty), BANDS 64-bit keys that two lines share with the probability of their similarity to the power ROWS."""
    lengths = np.array([len(line) for line in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.cumsum(lengths) - lengths
    counts = np.maximum(1, lengths - SHINGLE + 1)
    hashes = _run_hashes(codes)
    # A line shorter than a shingle is hashed with zeros behind it.
    for at in np.flatnonzero(lengths < SHINGLE):
        hashes[starts[at]] = _run_hashes(codes[starts[at] : starts[at] + lengths[at]])[0]
    # Only shingles within a line count: the last places of each line go.
    last = lengths - counts
    inside = np.ones(len(codes), bool)
    inside[np.repeat(starts + counts - np.cumsum(last) + last, last) + np.arange(last.sum())] = False
    hashes, firsts = hashes[inside], np.cumsum(counts) - counts
    least, mixed = np.empty((BANDS, ROWS, len(lines)), np.uint32), np.empty_like(hashes)
    for band, row in np.ndindex(BANDS, ROWS):
        np.multiply(hashes, _FACTORS[band * ROWS + row], out=mixed)
        np.add(mixed, _SHIFTS[band * ROWS + row], out=mixed)
        np.minimum.reduceat(mixed, firsts, out=least[band, row])
    keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[:, None], len(lines), axis=1)
    for row in range(ROWS):
        keys = (keys ^ least[:, row]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return np.ascontiguousarray(keys.T)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()

    def flushed(ids: list[int], lines: list[str]) -> pa.RecordBatch:
        keys = band_keys(lines).view(np.int64).ravel()
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(np.array(ids, np.int64), BANDS))], names=["bucket", "id"])

    for batch in batches:
        ids, lines, size = [], [], 0
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key in seen:
                continue
            if len(seen) > 500_000:  # what a task remembers of its lines is bounded
                seen.clear()
            seen.add(key)
            ids.append(key)
            lines.append(line.as_py())
            size += len(lines[-1])
            if size > BLOCK:
                yield flushed(ids, lines)
                ids, lines, size = [], [], 0
        if ids:
            yield flushed(ids, lines)


def shingles(line: str) -> set[int | str]:
    """The line's runs, each of eight Latin-1 characters as the number that its bytes make, any other as a text."""
    count = len(line) - SHINGLE + 1
    if count < 2:
        line, count = line.ljust(SHINGLE, "\n"), 1  # no line holds this character
    try:
        return set(np.ndarray((count,), "<u8", line.encode("latin-1"), strides=(1,)).tolist())
    except UnicodeEncodeError:
        numbers = np.ndarray((count,), "<u8", line.encode("latin-1", "replace"), strides=(1,))
    wide = np.concatenate([[0], np.cumsum(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") > 0xFF)])
    wide = wide[SHINGLE:] > wide[:-SHINGLE]
    return {*numbers[~wide].tolist(), *(line[n : n + SHINGLE] for n in np.flatnonzero(wide).tolist())}


def _normal(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc, row, place, id, line: every line with a word. id is a hash of the normal form of the line.

    row tells the texts of one doc_id apart; rows that repeat both are treated alike.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("row"), F.posexplode(F.split(text, "\n")).alias("place", "_line"))
    named = read.select("doc", "row", "place", _normal(F.col("_line")).alias("line")).where("line <> ''")
    return named.select("doc", "row", "place", F.xxhash64("line").alias("id"), "line")


def line_classes(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of the line ids that are similar to another one, directly or by a chain."""
    every = lines.select("id", "line")
    members = every.mapInArrow(_banded, "bucket long, id long")

    def fetch(ids: DataFrame) -> DataFrame:
        return every.join(ids, "id", "left_semi").groupBy("id", "line").agg(F.lit(1).alias("_one")).drop("_one")

    return resolve(members, fetch, shingles, similarity)


def removals(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc, row, n_lines (with a word), removed (places of the lines that go, in order): a row per distinct doc_id and text.

    Of all occurrences of a component's lines, in all documents, the one in the smallest doc_id
    (then row, then place) stays; a missing doc_id is smaller than any. Documents without any
    line with a word have no row.
    """
    # Written once: texts are cut into lines once for signatures, candidates and places.
    lines = saved(occurrences(docs))
    classes = few_to_all(saved(line_classes(lines, similarity)))
    thin = lines.select(F.coalesce("doc", F.lit(-(1 << 63))).alias("doc"), "row", "place", "id")
    named = saved(
        thin.join(classes, thin["id"] == classes["node"], "left").select(
            "doc", "row", "place", F.coalesce("component", "id").alias("component")
        )
    )
    first = F.min(F.struct("doc", "row", "place")).alias("kept")
    kept = named.groupBy("component").agg(F.count("*").alias("n"), first).where("n > 1").drop("n")
    marked = named.join(kept, "component", "left")
    goes = F.when(F.struct("doc", "row", "place") != F.col("kept"), F.col("place"))
    # Rows that repeat a doc_id and text name the same places.
    places = F.size(F.collect_set("place")).alias("n_lines")
    out = marked.groupBy("doc", "row").agg(places, F.sort_array(F.collect_set(goes)).alias("removed"))
    return out.withColumn("doc", F.when(F.col("doc") != -(1 << 63), F.col("doc")))


def clean(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the lines that go, n_chars (if there) counted again; columns and other rows as they are.

    A document all of whose lines with a word go is left out: they all stand elsewhere. One
    that had no such line stays as it was.
    """
    lost = removals(docs, similarity).where(F.size("removed") > 0).toDF(*[f"_tallyhall_{c}" for c in ("doc", "row", "n", "gone")])
    row, gone = F.xxhash64(F.coalesce(docs["text"], F.lit(""))), F.col("_tallyhall_gone")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_tallyhall_doc")) & (row == F.col("_tallyhall_row"))
    joined = docs.join(lost, same, "left").where(gone.isNull() | (F.size(gone) < F.col("_tallyhall_n")))
    rest = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda _, n: ~F.array_contains(gone, n)), "\n")

    def column(name: str) -> Column:
        if name == "text":
            return F.when(gone.isNull(), docs[name]).otherwise(rest).alias(name)
        if name == "n_chars":
            return F.when(gone.isNull(), docs[name]).otherwise(F.length(rest).cast(docs.schema[name].dataType)).alias(name)
        return docs[f"`{name}`"]

    return joined.select(*[column(c) for c in docs.columns])
