"""From raw documents to packed training sequences, one stage after another.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), and what it returns
is written as Parquet and read again as the next one's docs. All but the last return the
columns of documents.

In every stage a null text is an empty one, null doc_id, lang and source are values like any
other, rows that repeat a doc_id are judged one by one, further columns pass through (to the last
stage they are unknown), and empty docs give no rows. Whole texts count, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.llm import cotrain, decontam, linededup, packing, simhash
from tallyhall.llm.common import ship, table, words
from tallyhall.session import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Words in a packed sequence.
SEQUENCE_WORDS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; equal rows go or stay together. Without labels to fit on, all stay."""
    ship(spark)
    return cotrain.keep(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one line of each component of similar lines; documents left without any line go.

    The line of the smallest doc_id (a missing one first), row and place stays. Documents that had no line with a word stay as they are.
    """
    ship(spark)
    return linededup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 alike, found by SimHash and covering masks, and by bands beside.

    That of the smallest doc_id (a missing one last) stays, then of the smaller hash of the text; rows equal to it in
    both stay as well. All texts without words are one group.
    """
    ship(spark)
    return simhash.clean(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; items without words are held by none."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, piece, start, size, bin_id, offset.

    An empty document is a piece of size 0. Pieces of equal size go by doc_id, then piece. Clusters are equal texts,
    as near copies are gone by now.
    """
    ship(spark)
    parts = packing.pieces(docs, F.size(words(F.col("text"))), F.xxhash64("text"), SEQUENCE_WORDS)
    return packing.pack(saved(parts), SEQUENCE_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("packed", packed),
]

# Similarity joins and trained models have no short SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
