"""Fill-in-middle: texts cut into prefix, middle and suffix at the ends of units, the middle told last.

A unit is a run of ASCII letters or any other single character. One fullmatch of (unit)* by the
regex library keeps every repetition of the group: match.ends(1) lists where each unit ends, so its
length is the number of units and both cuts are looked up in it, without a loop. The repetition is
possessive, as no unit can end elsewhere; so nothing is kept for going back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of a hundred documents so many stay plain at least, and of the others so many put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
# Characters of output handed on at once.
FLUSH = 4 << 20

FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 that depend on the id and the seed alone; a missing id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def cut(text: str, doc_id: int | None, seed: int = 1) -> tuple[int, str, int | None, int | None, str]:
    """n (units), form, characters of prefix and middle (None if plain), output."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= 100 - PLAIN or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (ends[at - 1] if at else 0 for at in (low, high))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SUFFIX_FIRST:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, first, second - first, output


def _cutter(seed: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
         ("middle_chars", pa.int64()), ("output", pa.string())]
    )

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.append((doc_id, *cut(text.as_py() or "", doc_id, seed)))
                size += len(found[-1][-1])
                if size > FLUSH:
                    yield rows(found)
                    found, size = [], 0
            if found:
                yield rows(found)

    return cutter


def transform(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output: a row per row of docs.

    Whole texts, no shuffle: every row is cut where it is read. Null text is empty; a text that is
    empty or holds a mark stays plain, as it could not be told back, and has null counts of
    characters. Cuts depend on the doc_id and the seed alone: rows that repeat both id and text come out
    alike, a missing id is cut as an id without digits. Other columns of docs are not read; an empty
    table gives none.
    """
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return read.mapInArrow(_cutter(seed), FIELDS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(n)) for n in (1, 2, 3))
    return (
        F.when(form == "plain", output)
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(F.concat(first, middle, second))
    )
