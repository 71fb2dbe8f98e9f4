"""Links among the members of buckets, without writing out the pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyhall.llm.graph import components
from tallyhall.session import saved

# Members of a group are compared in blocks of about so many: a task holds two blocks.
BLOCK = 1024
# Groups of up to so many are compared set by set, larger ones by a product of matrices.
FEW = 12
# Tables of one or two longs are sent to every task up to so many rows (16 MB of longs); larger ones are joined by a shuffle.
FEW_ROWS = 1_000_000

Shingles = Callable[[str], set]


def _star(shingles: Shingles, similarity: float):
    """Pairs (centre, id) whose texts' sets of shingles have at least the similarity."""

    def star(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, left = None, set()
        for batch in batches:
            keep = []
            for x, y in zip(batch["left"], batch["right"]):
                if x != last:
                    last, left = x, shingles(x)
                right = shingles(y)
                shared = len(left & right)
                keep.append(shared >= similarity * (len(left) + len(right) - shared))
            yield batch.loc[keep, ["a", "b"]]

    return star


def joined(sets: list[set], parts: list, blocks: list, similarity: float) -> list[tuple[int, int]]:
    """Places (m, n) of sets of different parts (and, if there are two blocks, of different blocks) that are similar.

    Not every such pair, but enough to join all of them.
    """
    two = len(set(blocks)) > 1
    root = list(range(len(sets)))
    names = {p: n for n, p in reversed(list(enumerate(parts)))}
    for n, p in enumerate(parts):
        root[n] = names[p]

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    if len(sets) <= FEW:
        sizes = [len(s) for s in sets]
        found = (
            (m, n)
            for n in range(len(sets)) for m in range(n)
            if not (two and blocks[m] == blocks[n]) and find(m) != find(n)
            and min(sizes[m], sizes[n]) >= similarity * max(sizes[m], sizes[n])
            and (1 + similarity) * len(sets[m] & sets[n]) >= similarity * (sizes[m] + sizes[n]) - 1e-9
        )
    else:
        place: dict = {}
        index = np.array([place.setdefault(x, len(place)) for s in sets for x in s])
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        # Shingles of a single set add to no intersection.
        often = np.bincount(index, minlength=len(place)) > 1
        column = np.cumsum(often) - 1
        kept = often[index]
        held = np.zeros((len(sets), int(often.sum())), np.float32)
        held[row[kept], column[index[kept]]] = 1
        sizes = np.array([len(s) for s in sets], np.float64)
        shared = (held @ held.T).astype(np.float64)
        alike = (1 + similarity) * shared >= similarity * (sizes[:, None] + sizes[None, :]) - 1e-9
        if two:
            label = np.array(blocks)
            alike &= label[:, None] != label[None, :]
        found = zip(*np.nonzero(np.tril(alike, -1)))
    out = []
    for m, n in found:
        a, b = find(int(m)), find(int(n))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(m), int(n)))
    return out


def _blocked(shingles: Shingles, similarity: float):
    """Links of groups whose rows stand together: centre, i, j, block, id, component, text."""

    def links(rows: list) -> Iterator[tuple[int, int]]:
        ids, parts, blocks = [r.id for r in rows], [r.component for r in rows], [r.block for r in rows]
        for m, n in joined([shingles(r.text) for r in rows], parts, blocks, similarity):
            yield ids[m], ids[n]

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows = None, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                own = (row.centre, row.i, row.j)
                if own != key:
                    out += links(rows)
                    key, rows = own, []
                rows.append(row)
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
        out = list(links(rows))
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])

    return blocked


def few_to_all(table: DataFrame) -> DataFrame:
    """A written table of longs, marked to be sent to every task if it has at most FEW_ROWS rows."""
    return F.broadcast(table) if table.count() <= FEW_ROWS else table


def resolve(
    members: DataFrame, fetch: Callable[[DataFrame], DataFrame], shingles: Shingles, similarity: float
) -> DataFrame:
    """(node, component) for the ids that links join: ids that share a bucket and whose texts' sets of shingles are similar.

    members has columns bucket and id, two longs, and moves once; a bucket's rows, sorted, may
    spill. fetch gives (id, text) for the ids that share any bucket.

    First every member is compared with one member of its bucket, the one that shares most buckets
    with others: of a text and its copies, that is the text which they were all made from.
    This joins most of a group of copies, however large, at one comparison per member. The
    members of a centre that are still in different components are then compared among
    themselves, in blocks: a task takes two blocks and gives back no more links than it
    has members. So every link counts, and no pairs are ever rows.
    """
    own = Window.partitionBy("bucket")
    spans = members.select("bucket", "id", F.min("id").over(own).alias("low"), F.max("id").over(own).alias("high"))
    shared = saved(spans.where("low < high").select("bucket", "id").distinct())
    ids = saved(shared.select("id").distinct())
    texts = saved(fetch(few_to_all(ids)).toDF("id", "text"))
    sizes = shared.groupBy("bucket").agg(F.count("*").alias("n"))
    degrees = shared.join(sizes, "bucket").groupBy("id").agg(F.sum("n").alias("degree"))
    centres = shared.join(degrees, "id").groupBy("bucket").agg(F.max_by("id", "degree").alias("centre"))
    groups = saved(shared.join(centres, "bucket").where("id <> centre").select("centre", "id").distinct())
    pairs = groups.join(texts.toDF("id", "right"), "id").join(texts.toDF("centre", "left"), "centre")
    star = pairs.select(F.col("centre").alias("a"), F.col("id").alias("b"), "left", "right").mapInPandas(
        _star(shingles, similarity), "a long, b long"
    )
    found = saved(star)
    labels = components(found)
    placed = groups.join(labels, groups["id"] == labels["node"], "left").select(
        "centre", "id", F.coalesce("component", "id").alias("component")
    )
    spans = placed.groupBy("centre").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    mixed = saved(placed.join(spans.where("low < high").select("centre", "blocks"), "centre"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    each = mixed.select(
        "centre", "id", "component", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    keyed = each.select(
        "centre", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component"
    )
    keys = ["centre", "i", "j"]
    rows = keyed.join(texts, "id").select(*keys, "block", "id", "component", "text")
    later = rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_blocked(shingles, similarity), "a long, b long")
    # The components found first stand for their links.
    known = labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(known.unionByName(saved(later)))
