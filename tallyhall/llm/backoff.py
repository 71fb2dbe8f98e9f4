"""Stupid-backoff scores of documents under a trigram model of the other documents.

n-grams are keyed by hashes. Documents are dealt by hash into splits of bounded size.
Each split lists its distinct n-grams with their counts, once, whatever the number of
documents that hold them, cut by key into buckets: these lists are the exploded n-grams.
A bucket sums the lists of all splits into its part of the count table and joins the sums
back to every list, key by key. The split, joined by its number with what came back, sums
scores per document. A word in a third of all documents is one row per split to its
bucket, so no key is hot.

A list is one binary value: sorted keys as differences, compressed. The number of lists is
splits x buckets; a larger split (bounded by a task's memory) makes them longer and fewer.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyhall.llm.common import lower_ascii

ORDER = 3
# Score factor for each step back to a shorter context.
ALPHA = 0.4
# UTF-8 bytes of text in a split.
SPLIT_BYTES = 8 << 20
# Scores are added up in whole units of 2**-UNIT, so their sum does not depend on any order.
UNIT = 30
# Bits of a key that are kept: of 10**13 n-grams one in 7,000 shares its key with another.
KEY_BITS = 56
_BLANKS = str.maketrans("\t\n\x0b\f\r", "     ")
# Odd multipliers that set keys of different orders and places apart.
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(key: np.ndarray, word: np.ndarray, order: int) -> np.ndarray:
    """The key of an n-gram from that of its first words and the hash of its last one."""
    x = (key + np.uint64(order)) * np.uint64(_MIX[0]) ^ word
    x ^= x >> np.uint64(29)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(32)
    x *= np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(29))


class Split:
    """The n-grams of some texts: for each order the key that ends at every word (0 where the text is too short)."""

    def __init__(self, texts: list[str]):
        ids: dict[str, int] = {}
        places, lengths = [], []
        for text in texts:
            found = [w for w in text.translate(_BLANKS).split(" ") if w]
            lengths.append(len(found))
            places += [ids.setdefault(w, len(ids)) for w in found]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in ids), dtype=np.uint64, count=len(ids))
        word = hashes[np.array(places, dtype=np.int64)] if places else np.zeros(0, np.uint64)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(word)) - starts[self.doc]
        self.keys = [_mixed(np.zeros_like(word), word, 1)]
        for order in range(2, ORDER + 1):
            before = np.concatenate([np.zeros(1, np.uint64), self.keys[-1][:-1]]) if len(word) else word
            self.keys.append(np.where(self.place >= order - 1, _mixed(before, word, order), np.uint64(0)))

    def exploded(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all n-grams of all orders, shortened to KEY_BITS, and the order and place in it of each: (order, word)."""
        has = [np.flatnonzero(self.place >= n) for n in range(ORDER)]
        every = np.concatenate([k[h] for k, h in zip(self.keys, has)]) >> np.uint64(64 - KEY_BITS)
        return every, np.concatenate([h + n * len(self.place) for n, h in enumerate(has)])


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, whose bytes are stored plane by plane: the high planes are nearly all 0."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return _packed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def unpack_keys(blob: bytes) -> np.ndarray:
    planes = _unpacked(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _lists(buckets: int):
    def lists(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = np.unique(Split(_texts(group)).exploded()[0], return_counts=True)
        # Buckets are ranges of the key's top bits, so a bucket's keys stand together.
        top = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets) >> np.uint64(32)
        edges = np.searchsorted(top, np.arange(buckets + 1, dtype=np.uint64))
        rows = [
            (key[0], b, pack_keys(keys[i:j]), _packed(counts[i:j].astype("<u4")))
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i
        ]
        return pd.DataFrame(rows, columns=["split", "bucket", "keys", "counts"])

    return lists


def _texts(group: pd.DataFrame) -> list[str]:
    """A split's texts in order of their row keys: the same in every run."""
    return group.sort_values(["doc_id", "row"], kind="stable")["text"].tolist()


def _totals(group: pd.DataFrame) -> pd.DataFrame:
    """For every list of a bucket the counts of its keys over all lists."""
    lists = [unpack_keys(b) for b in group["keys"]]
    counts = [_unpacked(b, "<u4") for b in group["counts"]]
    every, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(every)).astype("<u8")
    ends = np.cumsum([len(x) for x in lists])
    blobs = [_packed(total[part]) for part in np.split(place, ends[:-1])]
    return pd.DataFrame({"split": group["split"], "bucket": group["bucket"], "totals": blobs})


def _scores(total_words: int, leave_out: bool):
    def scores(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values(["doc_id", "row"], kind="stable")
        split = Split(docs["text"].tolist())
        every, where = split.exploded()
        answers = answers.sort_values("bucket")
        totals = np.concatenate([_unpacked(b, "<u8") for b in answers["totals"]]) if len(answers) else np.zeros(0, "<u8")
        # In a stable order by key, the n-grams of one key and document stand together.
        order = np.argsort(every, kind="stable")
        every, where = every[order], where[order]
        size = len(split.place)
        doc = split.doc[where % size] if size else where
        key_starts = np.concatenate([np.ones(min(1, len(every)), bool), every[1:] != every[:-1]])
        run_starts = key_starts | np.concatenate([np.ones(min(1, len(every)), bool), doc[1:] != doc[:-1]])
        if len(totals) != int(key_starts.sum()):
            raise ValueError("a split's n-grams changed between two runs over its documents")
        count = totals[np.cumsum(key_starts) - 1].astype(np.int64)
        if leave_out:
            run = np.cumsum(run_starts) - 1
            count -= np.bincount(run)[run]
        # Per order, the count of the n-gram that ends at each word, over the other documents.
        flat = np.zeros(ORDER * size, np.int64)
        flat[where] = count
        rest = flat.reshape(ORDER, size)
        words = np.maximum(1, total_words - split.lengths[split.doc] * leave_out)
        # From the shortest context up: the longest n-gram that the others hold decides.
        score = np.log(np.maximum(rest[0], 1) / words)
        for order in range(1, ORDER):
            before = np.concatenate([np.zeros(1, np.int64), rest[order - 1][:-1]]) if len(words) else words
            seen = rest[order] > 0
            direct = np.log(np.maximum(rest[order], 1) / np.maximum(before, 1))
            score = np.where(split.place < order, score, np.where(seen, direct, math.log(ALPHA) + score))
        units = np.rint(score * (1 << UNIT)).astype(np.int64)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, split.doc, units)
        return pd.DataFrame({"doc_id": docs["doc_id"].to_numpy(), "n_words": split.lengths, "units": sums})

    return scores


def score(docs: DataFrame, leave_out: bool = True) -> DataFrame:
    """doc_id, n_words, log_score (natural logarithm, summed over words), mean_log_score; a row per row of docs.

    A word's score is count(n-gram) / count(context) for the longest n-gram, up to ORDER words
    within the document, that occurs in the other documents (with `leave_out` unset, in
    all), times ALPHA for each step back; a word that no other document has counts as
    occurring once among all words. Words are lower-cased from A-Z. A document without
    words scores 0, its mean is null. Rows that repeat a document count each other.
    """
    read = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        lower_ascii(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    ).withColumn("row", F.xxhash64("text"))
    blanks = F.regexp_count(F.col("text"), F.lit(r"[^ \t\n\x0b\f\r]+"))
    size = read.agg(F.sum(F.octet_length("text").cast("long")), F.sum(blanks.cast("long"))).first()
    splits = max(1, -(-(size[0] or 0) // SPLIT_BYTES))
    dealt = read.withColumn("split", F.pmod(F.xxhash64("doc_id", "row"), F.lit(splits)).cast("int"))
    lists = dealt.groupBy("split").applyInPandas(_lists(splits), "split int, bucket int, keys binary, counts binary")
    answers = lists.groupBy("bucket").applyInPandas(_totals, "split int, bucket int, totals binary")
    scored = dealt.groupBy("split").cogroup(answers.groupBy("split")).applyInPandas(
        _scores(int(size[1] or 0), leave_out), "doc_id string, n_words long, units long"
    )
    log_score = F.col("units") / float(1 << UNIT)
    return scored.select(
        F.when(F.col("doc_id") != "", F.col("doc_id").cast("long")).alias("doc_id"), "n_words", log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"),
    )
