"""Nearest neighbours by robust-pruned directed graphs, one per shard of the vectors.

Equal vectors are one node, with the smallest of their ids. Nodes are dealt into shards of about SHARD
by hash. A shard's graph starts with random edges; then, in two passes, a greedy search for every
node proposes neighbours, and pruning keeps the nearest of them that no kept one is much nearer to (by the
factor RELAXED, in the second pass). Edges go both ways while a node has room. Nodes that no path
reaches are hung under their nearest reachable ones. A query is searched in every shard by a beam: of
the nodes seen, the nearest one not yet expanded is expanded until the whole beam is. Many
queries take their steps together, as whole-array work. The nodes of a beam are measured again in double
precision on the original vectors, and the best of all shards stay.

Queries are dealt in blocks to every shard, as rows; a task streams the nodes of one shard, then queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhall.llm.common import finite
from tallyhall.session import saved

# Nodes in a shard (about), edges of a node at most, nodes in a beam when building and when searching.
SHARD, EDGES, BUILD_BEAM, BEAM = 4096, 24, 40, 64
RELAXED = 1.2
# Nodes that every search starts from.
ENTRIES = 32
# Nodes or queries that take their steps together; queries that a task searches for in one shard.
TOGETHER, QUERY_BLOCK = 256, 1 << 16
_NOBODY = (1 << 63) - 1  # stands for a missing vec_id: larger than any


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in single precision; taking out the largest component first keeps squares finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return np.ascontiguousarray(scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), dtype=np.float32)


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row in double precision, the same for the same two rows wherever they stand."""
    a = left / np.abs(left).max(axis=1, keepdims=True)
    b = right / np.abs(right).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def beam_search(units: np.ndarray, edges: np.ndarray, entries: np.ndarray, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For every target the nodes of its last beam, nearest first, and all nodes it expanded; -1 fills rows.

    All beams start from the entries. edges has a row of node numbers per node, -1 where there is none.
    """
    many, n = len(targets), len(units)
    beam = min(beam, n)
    width = edges.shape[1]
    nodes, far = np.full((many, beam), -1, np.int32), np.full((many, beam), np.inf, np.float32)
    done = np.ones((many, beam), bool)
    seen = np.zeros((many, n), bool)
    first = 1 - targets @ units[entries].T
    order = np.argsort(first, axis=1, kind="stable")[:, :beam]
    start = order.shape[1]
    nodes[:, :start], far[:, :start], done[:, :start] = entries[order], np.take_along_axis(first, order, axis=1), False
    seen[:, entries] = True
    trail: list[tuple[np.ndarray, np.ndarray]] = []
    active = np.arange(many)
    while len(active):
        at = np.argmax(~done[active], axis=1)  # beams are in order of distance
        chosen = nodes[active, at]
        done[active, at] = True
        trail.append((active, chosen))
        near = edges[chosen]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        row, column = np.nonzero(fresh)
        if len(row):
            found = near[row, column]
            seen[active[row], found] = True
            new = np.full((len(active), width), np.inf, np.float32)
            new[row, column] = 1 - np.einsum("ij,ij->i", units[found], targets[active[row]])
            all_far = np.concatenate([far[active], new], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[active] = np.take_along_axis(all_far, order, axis=1)
            nodes[active] = np.take_along_axis(np.concatenate([nodes[active], near], axis=1), order, axis=1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], axis=1), order, axis=1)
        active = active[~done[active].all(axis=1)]
    nodes[np.isinf(far)] = -1
    expanded = np.full((many, len(trail)), -1, np.int32)
    for step, (rows, chosen) in enumerate(trail):
        expanded[rows, step] = chosen
    return nodes, expanded


def prune(units: np.ndarray, own: np.ndarray, proposed: np.ndarray, most: int, relaxed: float) -> np.ndarray:
    """Per node of own, at most `most` of its proposed neighbours (-1: none), the nearest first.

    A kept neighbour rules out all that are nearer to it, by the factor, than to the node.
    """
    candidates = np.sort(proposed, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == own[:, None]] = -1
    vectors = units[candidates]
    far = 2 - 2 * np.einsum("ijk,ik->ij", vectors, units[own])
    open_ = candidates >= 0
    between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    kept = np.full((len(own), most), -1, np.int32)
    rows = np.arange(len(own))
    for place in range(most):
        best = np.where(open_, far, np.inf).argmin(axis=1)
        left = open_[rows, best]
        if not left.any():
            break
        kept[left, place] = candidates[rows, best][left]
        open_ &= relaxed * relaxed * between[rows, best] > far
        open_[rows, best] = False
    return kept


def _linked_back(units: np.ndarray, edges: np.ndarray, own: np.ndarray, relaxed: float) -> None:
    """Give the new neighbours of own an edge back; nodes without room are pruned."""
    low, high = np.repeat(own, edges.shape[1]), edges[own].ravel()
    low, high = low[high >= 0], high[high >= 0]
    known = (edges[high] == low[:, None]).any(axis=1)
    low, high = low[~known], high[~known]
    order = np.argsort(high, kind="stable")
    low, high = low[order], high[order]
    targets, starts, counts = np.unique(high, return_index=True, return_counts=True)
    for begin in range(0, len(targets), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        extra = np.full((len(targets[part]), counts[part].max()), -1, np.int32)
        places = np.arange(extra.shape[1])[None, :] < counts[part][:, None]
        first = starts[begin]
        extra[places] = low[first : first + counts[part].sum()]
        every = np.concatenate([edges[targets[part]], extra], axis=1)
        crowded = (every >= 0).sum(axis=1) > edges.shape[1]
        room = np.take_along_axis(every, np.argsort(every < 0, axis=1, kind="stable"), axis=1)[:, : edges.shape[1]]
        edges[targets[part]] = room
        if crowded.any():
            full = targets[part][crowded]
            # Pruned in slices, as one node may be the neighbour of many.
            for at in range(0, len(full), 32):
                edges[full[at : at + 32]] = prune(units, full[at : at + 32], every[crowded][at : at + 32], edges.shape[1], relaxed)


def reached(edges: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which nodes a path from an entry leads to."""
    found, front = np.zeros(len(edges), bool), entries
    found[entries] = True
    while len(front):
        ahead = np.unique(edges[front])
        front = ahead[(ahead >= 0) & ~found[ahead]]
        found[front] = True
    return found


def spread(units: np.ndarray, most: int) -> np.ndarray:
    """The node nearest to the mean, then each time the one farthest from all before."""
    found = [int((units @ units.mean(axis=0)).argmax())]
    near = units @ units[found[0]]
    while len(found) < min(most, len(units)):
        found.append(int(near.argmin()))
        near = np.maximum(near, units @ units[found[-1]])
        near[found] = np.inf
    return np.array(found)


def graph(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a row per vector, -1 where there is none) and the entries, ENTRIES nodes apart from each other."""
    units, n = unit(vectors), len(vectors)
    pick = np.random.default_rng(seed)
    entries = spread(units, ENTRIES)
    edges = np.full((n, EDGES), -1, np.int32)
    some = min(EDGES // 2, n - 1)
    if some:
        edges[:, :some] = (np.arange(n)[:, None] + pick.integers(1, n, (n, some))) % n
    for relaxed in (1.0, RELAXED):
        order = pick.permutation(n)
        for at in range(0, n, TOGETHER):
            own = order[at : at + TOGETHER]
            _, expanded = beam_search(units, edges, entries, units[own], BUILD_BEAM)
            edges[own] = prune(units, own, np.concatenate([expanded, edges[own]], axis=1), EDGES, relaxed)
            _linked_back(units, edges, own, relaxed)
    # Hang every node out of reach under its nearest reachable one, in spare columns.
    lost = np.flatnonzero(~reached(edges, entries))
    while len(lost):
        homes = beam_search(units, edges, entries, units[lost[:TOGETHER]], BUILD_BEAM)[0][:, 0]
        spare = np.full((n, 1), -1, np.int32)
        homes, first = np.unique(homes, return_index=True)
        spare[homes, 0] = lost[:TOGETHER][first]
        edges = np.concatenate([edges, spare], axis=1)
        lost = np.flatnonzero(~reached(edges, entries))
    return edges, entries


def _matrix(values: pa.ListArray) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _slices(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows that agree in the named columns, cut where a batch ends."""
    for batch in batches:
        marks = list(zip(*(batch.column(n).to_pylist() for n in names)))
        starts = [n for n, mark in enumerate(marks) if not n or mark != marks[n - 1]]
        for low, high in zip(starts, [*starts[1:], len(marks)]):
            yield marks[low], batch.slice(low, high - low)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    for mark, run in groupby(_slices(batches, names), key=lambda x: x[0]):
        yield mark, (rows for _, rows in run)


def _column(rows: pa.Table, name: str) -> pa.Array:
    return rows.column(name).combine_chunks()


_INDEX_FIELDS = "dim int, shard long, ids array<long>, vector array<double>, node int, edges array<int>, entry boolean"
_INDEX = pa.schema(
    [("dim", pa.int32()), ("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("vector", pa.list_(pa.float64())),
     ("node", pa.int32()), ("edges", pa.list_(pa.int32())), ("entry", pa.bool_())]
)


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (dim, shard), run in _runs(batches, ["dim", "shard"]):
        rows = pa.Table.from_batches(list(run))
        vectors = _column(rows, "vector")
        edges, entries = graph(_matrix(vectors), seed=shard)
        n, kept = len(rows), edges >= 0
        ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(edges[kept], pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * n, pa.int32()), pa.array([shard] * n, pa.int64()), _column(rows, "ids"), vectors,
             pa.array(np.arange(n), pa.int32()), lists, pa.array(np.isin(np.arange(n), entries))],
            schema=_INDEX,
        )


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id (missing: the largest long), vector (doubles): rows whose vector is there, finite and not zero."""
    read = vectors.select(
        F.coalesce(vectors["vec_id"].cast("long"), F.lit(_NOBODY)).alias("vec_id"),
        vectors["embedding"].cast("array<double>").alias("vector"),
    )
    return read.where(finite(F.col("vector"))).where(F.exists("vector", lambda x: x != 0))


def nodes(vectors: DataFrame, most: int) -> DataFrame:
    """dim, shard, ids (the `most` smallest, in order, each id once), vector: a row per distinct vector; vectors as by usable().

    Only the smallest ids of a vector are ranked, first within tasks, and its copies are merged there too: a vector of
    a third of all rows is cut down before it is shuffled.
    """
    key = ["_a", "_b"]
    keyed = vectors.select("vec_id", "vector", F.xxhash64("vector").alias("_a"), F.xxhash64(F.lit(1), "vector").alias("_b"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))
    few = keyed.select("vec_id", *key).distinct().withColumn("_place", place).where(F.col("_place") <= most)
    ids = few.groupBy(*key).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = saved(keyed.groupBy(*key).agg(F.first("vector").alias("vector")).join(ids, key))
    shards = max(1, -(-classes.count() // SHARD))
    return classes.select(F.size("vector").alias("dim"), F.pmod("_a", F.lit(shards)).alias("shard"), "ids", "vector")


def build_index(vectors: DataFrame, k: int = 5) -> DataFrame:
    """The graphs of all shards as a written table, a row per distinct vector: dim, shard, ids, vector, node, edges, entry."""
    dealt = nodes(usable(vectors), k + 1).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "ids")
    return saved(dealt.mapInArrow(_built, _INDEX_FIELDS))


def _best(ids: list[list[int]], scores: np.ndarray, query_id: int, k: int) -> list[tuple[int, float]]:
    """The k best (id, score) but the query's own, equal scores by id."""
    found = sorted((-s, i) for own, s in zip(ids, scores) for i in own if i != query_id)
    return [(i, -s) for s, i in found[:k]]


def _searched(k: int):
    """Nodes of a shard (kind 0), then queries (kind 1), to the best of the shard for each query."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for (*place, kind), run in _runs(batches, ["dim", "shard", "block", "kind"]):
            if kind == 0:
                rows = pa.Table.from_batches(list(run))
                lists = _column(rows, "edges").to_pylist()
                edges = np.full((len(lists), max(1, *(len(x) for x in lists))), -1, np.int32)
                for at, own in enumerate(lists):
                    edges[at, : len(own)] = own
                ids, vectors = _column(rows, "ids").to_pylist(), _matrix(_column(rows, "vector"))
                units, entries = unit(vectors), np.flatnonzero(_column(rows, "entry").to_numpy(zero_copy_only=False))
                held = place
            elif held == place:  # else the shard has no vector of this length
                for rows in run:
                    yield from answers(rows, units, edges, entries, ids, vectors)

    def answers(rows: pa.RecordBatch, units, edges, entries, ids, vectors) -> Iterator[pa.RecordBatch]:
        matrix, names, out = _matrix(rows.column("vector")), zip(*(rows.column(c).to_pylist() for c in ("query_id", "twin"))), []
        names = list(names)
        for at in range(0, len(matrix), TOGETHER):
            part = matrix[at : at + TOGETHER]
            beams, _ = beam_search(units, edges, entries, unit(part), BEAM)
            for (query_id, twin), own, beam in zip(names[at : at + TOGETHER], part, beams):
                beam = beam[beam >= 0]
                scores = cosines(np.broadcast_to(own, (len(beam), len(own))), vectors[beam])
                out += [(query_id, twin, i, s) for i, s in _best([ids[b] for b in beam], scores, query_id, k)]
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "twin", "vec_id", "score"])

    return searched


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query, ties by vec_id.

    index as by build_index() with the same k or a larger one; queries has vec_id and vector, as by usable(). A candidate
    of the query's own vec_id takes no part, nor do vectors of another length.
    """
    asked = saved(queries.distinct())
    last = index.agg(F.max("shard")).first()[0] or 0
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    numbers = lambda most: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most).cast("long")))
    nothing = lambda kind: F.lit(None).cast(kind)
    left = index.select(
        "dim", "shard", numbers(blocks - 1).alias("block"), F.lit(0).alias("kind"), "node", nothing("long").alias("query_id"),
        nothing("long").alias("twin"), "vector", "ids", "edges", "entry",
    )
    right = asked.select(
        F.size("vector").alias("dim"), numbers(last).alias("shard"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block"),
        F.lit(1).alias("kind"), nothing("int").alias("node"), F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("twin"),
        "vector", nothing("array<long>").alias("ids"), nothing("array<int>").alias("edges"), nothing("boolean").alias("entry"),
    )
    keys = ["dim", "shard", "block"]
    rows = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "kind", "node")
    found = rows.mapInArrow(_searched(k), "query_id long, twin long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    named = lambda name: F.when(F.col(name) != _NOBODY, F.col(name)).alias(name)
    return best.select(named("query_id"), F.col("rank").cast("int").alias("rank"), named("vec_id"), "score")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, the k nearest others found.

    Nearness is the cosine, in double precision. Vectors that are null or zero or hold null or non-finite components
    take no part. A missing vec_id is no query; as a candidate it is larger than any. Rows that repeat id
    and vector count once; a repeated id with different vectors is a query for each of them. An empty table gives none.
    """
    index = build_index(vectors, k)
    asked = usable(vectors).where((F.col("vec_id") % every == 0) & (F.col("vec_id") != _NOBODY))
    return search(index, asked, k)
