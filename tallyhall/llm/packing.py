"""Best-fit packing under conflicts: documents into sequences of a fixed number of words.

A document longer than a sequence is cut into whole sequences and a rest; whole sequences
fill a bin each. Pieces are packed by best fit in decreasing order of size within shards of
bounded size. A bin carries a bitmap of its sources and one of its
clusters of duplicates; a piece may not join a bin that holds its source or its cluster. The
search runs over bins in order of residual capacity, from the tightest that the piece fits,
on to the successor until one is compatible; if none is, a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.llm import simhash
from tallyhall.llm.common import words
from tallyhall.session import saved

# Parts that rows of a text are dealt to where they meet the text's cluster.
SALTS = 16
# Pieces are packed in shards of about so many: this bounds a task's memory and its search.
SHARD_PIECES = 8192


def clustered(docs: DataFrame, size: int = 5, radius: int = 3) -> DataFrame:
    """doc_id, source, length (words), cluster: a row per row of docs.

    Texts are of one cluster if the fingerprints of their `size`-word shingles are chained by differences of at
    most `radius` bits, so copies always are. A text without words has none.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    thin = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.size(words(docs["text"])).cast("long").alias("length"), F.xxhash64(text).alias("text_id"),
            F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"),
        )
    )
    keyed = docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text"))
    own = simhash.classes(keyed, size, radius).select(F.col("doc_id").alias("text_id"), F.col("component_id").alias("cluster"))
    # The smallest text of a cluster names it: only the others have to be told.
    told = saved(own.where("text_id != cluster").distinct())
    told = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = thin.join(told, ["text_id", "salt"], "left")
    return found.select("doc_id", "source", "length", F.when(F.col("length") > 0, F.coalesce("cluster", "text_id")).alias("cluster"))


def pieces(docs: DataFrame, length: Column, cluster: Column, capacity: int) -> DataFrame:
    """doc_id, source, cluster, piece, start, size: a row per piece of at most `capacity` units.

    An empty document is one piece of size 0. Null source or cluster conflicts with nothing.
    """
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        cluster.alias("cluster"), length.cast("long").alias("length"),
    )
    last = F.greatest(F.ceil(F.col("length") / capacity) - 1, F.lit(0)).cast("int")
    cut = read.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * capacity
    return cut.select("doc_id", "source", "cluster", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("length") - start).alias("size"))


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the order given; sources and clusters are bitmaps of one bit or none."""
    residuals: list[tuple[int, int]] = []  # (residual capacity, bin), sorted
    used: list[tuple[int, int]] = []  # bitmaps of each bin
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals):
            held = used[residuals[at][1]]
            if not (held[0] & source or held[1] & cluster):
                break
            at += 1
        if at < len(residuals):
            left, home = residuals.pop(at)
            used[home] = (used[home][0] | source, used[home][1] | cluster)
        else:
            left, home = capacity, len(used)
            used.append((source, cluster))
        bins.append(home)
        offsets.append(capacity - left)
        if left > size:
            insort(residuals, (left - size, home))
    return bins, offsets


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that occurs at least twice; none for the others, which conflict with nothing."""
    seen = Counter(v for v in values if v is not None)
    place = {v: 1 << n for n, v in enumerate(sorted(v for v, n in seen.items() if n > 1))}
    return [place.get(v, 0) for v in values]


PACKED = "doc_id long, piece int, start long, size long, shard long, bin long, offset long"


def _packer(capacity: int):
    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["size", "doc_id", "piece", "order"], ascending=[False, True, True, True], kind="stable")
        sources = ordered["source"].astype(object).where(ordered["source"].notna(), None)
        clusters = ordered["cluster"].astype(object).where(ordered["cluster"].notna(), None)
        bins, offsets = best_fit(ordered["size"].tolist(), _bits(sources), _bits(clusters), capacity)
        return ordered[["doc_id", "piece", "start", "size", "shard"]].assign(bin=bins, offset=offsets)

    return pack


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """doc_id, piece, start, size, bin_id ("<shard>-<bin>"), offset: where each piece (as from pieces()) lies.

    A piece of size 0 takes part as well: it has an offset but no room. Rows that repeat a
    document are separate pieces. Shards are dealt by hash of document and piece, so that hot
    sources and clusters spread evenly over them.
    """
    shards = max(1, -(-parts.count() // SHARD_PIECES))
    dealt = parts.withColumns(
        {
            "shard": F.pmod(F.xxhash64("doc_id", "piece", "source", "cluster"), F.lit(shards)).cast("long"),
            "order": F.xxhash64("cluster", "source"),
        }
    )
    packed = dealt.groupBy("shard").applyInPandas(_packer(capacity), PACKED)
    bin_id = F.concat(F.col("shard").cast("string"), F.lit("-"), F.col("bin").cast("string"))
    return packed.select("doc_id", "piece", "start", "size", bin_id.alias("bin_id"), "offset")
