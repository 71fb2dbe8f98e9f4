"""Near duplicates by SimHash, found by covering locality-sensitive hashing.

Masks of a covering code: every bit gets a non-zero vector of radius + 1 bits, and table v
keeps the bits whose vector has an odd inner product with v. Any `radius` vectors leave some
v orthogonal to all of them, so two fingerprints that differ in at most `radius` bits agree
under the mask of that table: no pair within the radius is missed.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.llm.common import BLANKS, lower_ascii, words
from tallyhall.llm.graph import components
from tallyhall.llm.pairs import resolve
from tallyhall.session import saved

BITS = 64
_LOWER_BLANKS = str.maketrans(string.ascii_uppercase + BLANKS, string.ascii_lowercase + " " * len(BLANKS))
# Buckets of up to so many fingerprints are compared pair by pair: at most half as many pairs as this per member.
SMALL_BUCKET = 128
# Near duplicates meet in one of so many bands of so many MinHashes: a pair that is 0.8 alike misses all with a chance below 1e-9.
BANDS, ROWS = 40, 4
# Words whose signatures are made at once, and words whose hashes a worker remembers.
BLOCK_WORDS, MEMO_WORDS = 1 << 15, 1_000_000
_PICK = np.random.default_rng(20240611)  # any fixed seed: signatures must agree between tasks
_FACTORS = _PICK.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_rows(docs: DataFrame, keys: list[str], size: int) -> DataFrame:
    """keys, part, h, first: the hash of every run of `size` words, repeats included, lower-cased from A-Z.

    part is the partition that a row was read in.
    Fewer words make one shingle of all; a text without words has one row with a null h. Just
    one row of each row of docs has first = 1.
    """
    read = docs.select(*keys, words(lower_ascii(F.col("text"))).alias("_words"))
    n = F.size("_words")
    each = read.select(*keys, "_words", F.posexplode_outer("_words").alias("_at", "_word"))
    at = F.coalesce(F.col("_at"), F.lit(0))
    inner = each.where((at <= n - size) | (at == 0))
    run = [F.get(F.col("_words"), F.col("_at") + k) for k in range(1, size)]
    # concat_ws leaves out the places beyond the end of a short text.
    h = F.when(F.col("_at").isNotNull(), F.xxhash64(F.concat_ws(" ", "_word", *run)))
    return inner.select(*keys, F.spark_partition_id().alias("part"), h.alias("h"), (at == 0).cast("int").alias("first"))


def majority_bits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fingerprint, copies (the sum of first): per key, the bits set in over half of its hashes h.

    Two counters of 32 bits share a long, so 32 sums count all bits; they are summed within each partition
    that rows were read in before anything is shuffled. So a counter holds no more than the shingles that one
    partition has of one key: equal rows, however many in all, add up in counters of 64 bits.
    """
    lane = 0x0000000100000001
    sums = rows.groupBy(*keys, "part").agg(
        F.count("h").alias("n"),
        F.sum("first").alias("copies"),
        *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(lane))).alias(f"c{k}") for k in range(32)],
    )
    counts = [F.shiftrightunsigned(F.col(f"c{b % 32}"), 32 * (b // 32)).bitwiseAND(F.lit(0xFFFFFFFF)) for b in range(BITS)]
    whole = sums.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("copies").alias("copies"), *[F.sum(c).alias(f"b{b}") for b, c in enumerate(counts)]
    )
    bits = [F.when(2 * F.col(f"b{b}") > F.col("n"), F.lit(_flag(b))).otherwise(F.lit(0)) for b in range(BITS)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return whole.select(*keys, out.cast("long").alias("fingerprint"), "copies")


def _flag(bit: int) -> int:
    """The bit alone, as a signed long."""
    return 1 << bit if bit < 63 else -(1 << 63)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (a long), one row per row of docs; no words: 0.

    Rows of one doc_id are told apart by their text. Rows that repeat both are counted as one
    whose every shingle occurs so many times more, which sets the same bits, and given back.
    """
    none = -(1 << 63)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = read.select(F.coalesce("doc_id", F.lit(none)).alias("id"), F.xxhash64("text").alias("row"), "text")
    prints = majority_bits(shingle_rows(keyed, ["id", "row"], size), ["id", "row"])
    return prints.select(
        F.when(F.col("id") != none, F.col("id")).alias("doc_id"), "fingerprint", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    ).drop("_copy")


def masks(radius: int) -> list[int]:
    """The covering code's masks, as signed longs."""
    if radius <= 5:
        vectors = [1 + b % ((1 << (radius + 1)) - 1) for b in range(BITS)]
    elif radius <= 7:  # a first-order Reed-Muller code, for 7 with a bent function: every mask keeps 28 bits or more
        bent = lambda b: (b & b >> 1 & 0b010101).bit_count() & 1
        vectors = [1 | b << 1 | (bent(b) << 7 if radius == 7 else 0) for b in range(BITS)]
    else:
        raise ValueError("a radius of 8 or more needs too many tables")
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << b for b in range(BITS) if (vectors[b] & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def distance(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def buckets(prints: DataFrame, radius: int, keys: list[str] = ["fingerprint"]) -> DataFrame:  # noqa: B006
    """table, masked, keys: a row per row of prints and table."""
    codes = [F.struct(F.lit(t).alias("table"), F.lit(m).alias("mask")) for t, m in enumerate(masks(radius))]
    each = prints.select("*", F.inline(F.array(*codes)))
    return each.select("table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("masked"), *keys)


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """a, b: links that join exactly the fingerprints (distinct, column fingerprint) that a chain of
    differences of at most `radius` bits joins.

    Buckets of up to SMALL_BUCKET fingerprints are compared pair by pair. In larger ones every
    member is linked by way of points between: two fingerprints within the radius have a point
    that one reaches by changing at most radius // 2 bits and the other by the rest. The first kind of
    row at a point, all within the radius of each other and of the second kind, stands for
    it; the work is in proportion to the members, whatever their number.
    """
    every = saved(buckets(prints, radius))
    sizes = every.groupBy("table", "masked").agg(
        F.count("*").alias("n"), F.bit_or("fingerprint").alias("any"), F.bit_and("fingerprint").alias("all")
    )
    shared = saved(every.join(sizes.where("n > 1"), ["table", "masked"]))
    small = shared.where(F.col("n") <= SMALL_BUCKET).select("table", "masked", "fingerprint")
    other = small.withColumnRenamed("fingerprint", "b")
    near = small.withColumnRenamed("fingerprint", "a").join(other, ["table", "masked"]).where(F.col("a") < F.col("b"))
    found = near.where(distance("a", "b") <= radius).select("a", "b").distinct()
    large = shared.where(F.col("n") > SMALL_BUCKET).select(
        "table", "masked", "fingerprint", F.col("any").bitwiseXOR(F.col("all")).alias("active")
    )
    return found.unionByName(_by_way_of(large, radius))


def _changed(rows: DataFrame, most: int) -> DataFrame:
    """Rows with every point that changes at most `most` of the active bits of the fingerprint."""
    out = rows.select("table", "masked", "fingerprint", "active", F.col("fingerprint").alias("point"), F.lit(-1).alias("last"))
    whole = out
    for _ in range(most):
        bits = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(_flag(b)).alias("flag")) for b in range(BITS)])
        each = out.select("*", F.inline(bits)).where((F.col("bit") > F.col("last")) & (F.col("active").bitwiseAND(F.col("flag")) != 0))
        out = each.select(
            "table", "masked", "fingerprint", "active", F.col("point").bitwiseXOR(F.col("flag")).alias("point"), F.col("bit").alias("last")
        )
        whole = whole.unionByName(out)
    return whole


def _by_way_of(large: DataFrame, radius: int) -> DataFrame:
    few, many = radius // 2, radius - radius // 2
    reached = _changed(large, many).withColumn("changes", distance("fingerprint", "point"))
    points = ["table", "masked", "point"]
    centres = reached.where(F.col("changes") <= few).groupBy(*points).agg(F.min("fingerprint").alias("a"))
    return (
        reached.join(centres, points).where(F.col("a") != F.col("fingerprint"))
        .select("a", F.col("fingerprint").alias("b")).distinct()
    )


def classes(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links reach.

    One row per row of docs. Documents of one fingerprint are one class from the start, so only
    distinct fingerprints are bucketed: a text copied into a third of all documents is one.
    Null text has no words. A missing doc_id takes part but is the smallest of none.
    """
    prints = saved(fingerprints(docs, size))
    firsts = saved(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    joined = components(links(firsts.select("fingerprint"), radius))
    homes = firsts.join(joined, firsts["fingerprint"] == joined["node"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    least = homes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = homes.join(least, "component").select("fingerprint", "component_id")
    out = prints.join(named, "fingerprint")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _words_of(text: str) -> list[str]:
    return [w for w in text.translate(_LOWER_BLANKS).split(" ") if w]


def band_keys(texts: list[np.ndarray], size: int) -> np.ndarray:
    """For each text (hashes of its words), BANDS keys that two texts share with the probability of their similarity to the power ROWS.

    The similarity is that of the sets of runs of `size` words; fewer words are one run, padded with zeros.
    """
    padded = [np.pad(t, (0, max(0, size - len(t)))) for t in texts]
    lengths = np.array([len(t) for t in padded])
    words, counts = np.concatenate(padded), lengths - size + 1
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        runs = (runs ^ words[k : k + len(runs)]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(29)
    inside = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    runs = runs[(inside < np.repeat(counts, lengths))[: len(runs)]]
    firsts = np.cumsum(counts) - counts
    keys, mixed = np.empty((len(texts), BANDS), np.uint64), np.empty_like(runs)
    for band in range(BANDS):
        key = np.full(len(texts), band, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            np.multiply(runs, _FACTORS[row], out=mixed)
            np.bitwise_xor(mixed, mixed >> np.uint64(32), out=mixed)
            np.multiply(mixed, _FACTORS[row - 1], out=mixed)
            key = (key ^ np.minimum.reduceat(mixed, firsts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys


def _banded(size: int):
    """Rows (text_id, text) to (bucket, id); a task leaves out most copies of a text."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        memo: dict[str, int] = {}

        def hashed(word: str) -> int:
            h = memo.get(word)
            if h is None:
                h = memo[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            return h

        def flushed(ids: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
            keys = band_keys(texts, size).view(np.int64).ravel()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(np.array(ids, np.int64), BANDS))], names=["bucket", "id"])

        for batch in batches:
            ids, texts, many = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key in seen:
                    continue
                if len(seen) > 500_000:  # what a task remembers of its texts and words is bounded
                    seen.clear()
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                seen.add(key)
                ids.append(key)
                texts.append(np.array([hashed(w) for w in _words_of(text.as_py())], np.uint64))
                many += len(texts[-1])
                if many > BLOCK_WORDS:
                    yield flushed(ids, texts)
                    ids, texts, many = [], [], 0
            if ids:
                yield flushed(ids, texts)

    return banded


def _word_runs(size: int):
    def runs(text: str) -> set[int]:
        found = _words_of(text)
        return {hash(tuple(found[n : n + size])) for n in range(max(1, len(found) - size + 1))}

    return runs


def meetings(keyed: DataFrame, print_size: int = 3, radius: int = 3) -> DataFrame:
    """bucket, id: texts (text_id, text) that meet by their fingerprints of `print_size`-word shingles, as in classes().

    Any two whose fingerprints differ in at most `radius` bits share a bucket. A bucket is a fingerprint's, and
    holds its texts and those of the fingerprints that links() finds from it: two within the radius are
    linked with each other, or in a large bucket of the masks both with one that stands between them.
    """
    prints = majority_bits(shingle_rows(keyed.select("text_id", "text"), ["text_id"], print_size), ["text_id"])
    prints = saved(prints.select("text_id", "fingerprint"))
    found = links(prints.select("fingerprint").distinct(), radius)
    homes = prints.select(F.col("fingerprint").alias("home"), "text_id")
    away = prints.join(found, prints["fingerprint"] == found["b"]).select(F.col("a").alias("home"), "text_id")
    return homes.unionByName(away).select(F.xxhash64(F.lit("fingerprint"), "home").alias("bucket"), F.col("text_id").alias("id"))


def near_duplicates(
    docs: DataFrame, size: int = 5, similarity: float = 0.8, print_size: int = 3, radius: int = 3
) -> DataFrame:
    """doc_id, text_id, component_id, stays: a row per distinct doc_id and text; text_id is a hash of the text.

    Documents are compared if their fingerprints (of runs of `print_size` words) differ in at most `radius` bits,
    found by covering masks, and, as similar texts may lie beyond, also if they share a band of MinHashes of their
    `size`-word shingles, whatever the kind of edit that parts them. They are linked if the Jaccard similarity
    of their sets of shingles is at least `similarity`. component_id is
    the smallest doc_id of the component, and the smallest document (by doc_id, then text_id;
    missing ids last) stays.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = read.withColumn("text_id", F.xxhash64("text"))
    banded = keyed.select("text_id", "text").mapInArrow(_banded(size), "bucket long, id long")
    members = banded.unionByName(meetings(keyed, print_size, radius))

    def fetch(ids: DataFrame) -> DataFrame:
        texts = keyed.select(F.col("text_id").alias("id"), "text").join(ids, "id", "left_semi")
        return texts.groupBy("id", "text").agg(F.lit(1).alias("_one")).drop("_one")

    joined = resolve(members, fetch, _word_runs(size), similarity)
    named = keyed.select("doc_id", "text_id").distinct()
    named = saved(
        named.join(joined, named["text_id"] == joined["node"], "left").select(
            "doc_id", "text_id", F.coalesce("component", "text_id").alias("component")
        )
    )
    none = F.lit((1 << 63) - 1)
    ranked = named.withColumn("_doc", F.coalesce("doc_id", none))
    firsts = ranked.groupBy("component").agg(F.min("_doc").alias("_doc"))
    stay = ranked.join(firsts, ["component", "_doc"]).groupBy("component", "_doc").agg(F.min("text_id").alias("_text"))
    out = ranked.join(stay.withColumnRenamed("_doc", "_first"), "component")
    return out.select(
        "doc_id", "text_id", F.when(F.col("_first") != none, F.col("_first")).alias("component_id"),
        ((F.col("_doc") == F.col("_first")) & (F.col("text_id") == F.col("_text"))).alias("stays"),
    )


def clean(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, one document of each group; rows that repeat its doc_id and text stay with it."""
    gone = near_duplicates(docs, **options).where(~F.col("stays")).select(
        F.col("doc_id").alias("_tallyhall_doc"), F.col("text_id").alias("_tallyhall_text")
    )
    text_id = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_tallyhall_doc")) & (text_id == F.col("_tallyhall_text"))
    return docs.join(gone, same, "left_anti")
