"""Benchmark items found in documents: every window as long as the item, by exact similarity.

Words are runs of letters and digits of the lower-cased text; shingles are runs of SHINGLE
words, or all words of a shorter item. A document leaks an item if a window of as many words
as the item has a weighted Jaccard similarity, shingles counted as often as they occur, of
at least `similarity` to it.

A window that similar shares a shingle with every set of the item's shingles that is larger
than the share that may differ. The rarest such set anchors an item: only texts that hold an anchor,
wherever it stands, are compared with it. Of a text only the places of shingles that some item has
are kept, once however many documents hold the text. They give the shingles that any window shares with the
item, and so its similarity, without its words. Windows are tried only where enough of these places lie
together; all that can be similar enough are, wherever the shared shingles stand in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhall.session import saved

SHINGLE = 5
# Shingles of items are broadcast up to so many (12 bytes each); more are joined by a shuffle.
BROADCAST_ANCHORS = 1_000_000


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _run_hash(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, at + k) for k in range(size)])


def _text_id(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, item (a hash of the words), words, m (how many), k (words in a shingle); items without words are left out: nothing can leak them."""
    read = benchmark.select(F.col("item_id").cast("long").alias("item_id"), normal_words(F.col("text")).alias("words"))
    read = read.withColumn("m", F.size("words")).where("m > 0")
    return read.select("item_id", F.xxhash64("words").alias("item"), "words", "m", F.least(F.lit(SHINGLE), F.col("m")).alias("k"))


def item_shingles(benchmark_items: DataFrame, sizes: list[int], similarity: float) -> DataFrame:
    """item, m, k, h, c (how often it occurs in the item), anchor (whether it is one of the rarest, as many as one must be shared of)."""
    distinct = benchmark_items.select("item", "words", "m", "k").distinct()
    parts = []
    for k in sizes:
        rows = distinct.where(F.col("k") == k).select("item", "words", "m", F.posexplode("words").alias("ipos", "_word"))
        rows = rows.where(F.col("ipos") <= F.col("m") - k)
        parts.append(rows.select("item", "m", "ipos", F.lit(k).alias("k"), _run_hash(F.col("words"), F.col("ipos"), k).alias("h")))
    grams = parts[0]
    for part in parts[1:]:
        grams = grams.unionByName(part)
    counted = grams.groupBy("h").agg(F.count("*").alias("n"))
    each = grams.join(counted, "h").groupBy("item", "m", "k").agg(F.sort_array(F.collect_list(F.struct("n", "h", "ipos"))).alias("all"))
    total = F.size("all")
    needed = total - F.ceil(total * similarity - 1e-9).cast("int") + 1
    flagged = each.select("item", "m", "k", needed.alias("needed"), F.posexplode("all").alias("rank", "one"))
    return flagged.groupBy("item", "m", "k", F.col("one.h").alias("h")).agg(
        F.count("*").cast("int").alias("c"), F.max(F.col("rank") < F.col("needed")).alias("anchor")
    )


def places(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """text_id, n (words of the text), k, h, at: where texts hold shingles of items."""
    read = docs.select(_text_id(docs).alias("text_id"), normal_words(docs["text"]).alias("_words"))
    vocabulary = shingles.select("k", "h").distinct()
    few = vocabulary.count() <= BROADCAST_ANCHORS
    n = F.size("_words")
    each = read.select("text_id", "_words", F.posexplode("_words").alias("at", "_word"))
    out = None
    for k in sizes:
        own = vocabulary.where(F.col("k") == k).select("h")
        runs = each.where(F.col("at") <= n - k).select(
            "text_id", n.alias("n"), F.lit(k).alias("k"), _run_hash(F.col("_words"), F.col("at"), k).alias("h"), "at"
        )
        hits = runs.join(F.broadcast(own) if few else own.hint("shuffle_merge"), "h").select("text_id", "n", "k", "h", "at")
        out = hits if out is None else out.unionByName(hits)
    return out.distinct()


def _windows(pairs: DataFrame, similarity: float) -> DataFrame:
    """pairs with start and near: windows that may be similar enough, and the shared places that may lie in them.

    A pair's places (at, prev) are in order; a window of t of the text's shingles must hold at least
    similarity * (t + total) / (1 + similarity) of them.
    """
    total, size = F.col("m") - F.col("k") + 1, F.size("places")
    least = F.ceil(F.lit(similarity) * total - 1e-9).cast("int")
    keys = ["text_id", "item", "m", "k", "n"]
    need = F.greatest(F.ceil(2 * similarity / (1 + similarity) * total - 1e-9).cast("int"), F.lit(1))
    each = pairs.select(*keys, "places", total.alias("total"), need.alias("need"), F.posexplode("places").alias("i", "place"))
    # Whole windows in which place i is the first.
    before = F.coalesce(F.get("places", F.col("i") - 1)["at"], F.lit(-1))
    far = F.get("places", F.col("i") + F.col("need") - 1)["at"]
    low, high = F.greatest(before + 1, far - F.col("total") + 1), F.least(F.col("place.at"), F.col("n") - F.col("m"))
    first = each.select(*keys, low.alias("low"), high.alias("high"), F.when(far.isNotNull() & (low <= high), F.slice("places", F.col("i") + 1, F.col("total"))).alias("near"))
    # Windows clipped at the beginning, at the end.
    spare = total - least
    left = pairs.where((spare > 0) & (size >= least)).select(*keys, (-spare).alias("low"), F.lit(-1).alias("high"), F.slice("places", F.lit(1), total).alias("near"))
    room = F.col("n") - F.col("m")
    right = pairs.where(size >= least).select(
        *keys, F.greatest(room + 1, F.lit(0)).alias("low"), (room + spare).alias("high"),
        F.slice("places", F.greatest(size - total + 1, F.lit(1)), total).alias("near"),
    )
    every = first.where("near IS NOT NULL").unionByName(left).unionByName(right).where("low <= high")
    return every.select(*keys, F.explode(F.sequence("low", "high")).alias("start"), "near")


def leaking_texts(docs: DataFrame, listed: DataFrame, similarity: float) -> DataFrame:
    """text_id, item, similarity, start of the best window, for texts that leak an item; listed as by items()."""
    sizes = sorted(r[0] for r in listed.select("k").distinct().collect())  # at most SHINGLE numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], "text_id long, item long, similarity double, start int")
    shingles = saved(item_shingles(listed, sizes, similarity))
    found = saved(places(docs, shingles, sizes))
    anchors = shingles.where("anchor").select("k", "h", "item")
    candidates = found.join(anchors, ["k", "h"]).select("text_id", "k", "item").distinct()
    own = candidates.join(found, ["text_id", "k"]).join(shingles.select("item", "m", "h", "c"), ["item", "h"])
    dealt = own.repartition("text_id", "item")
    keys = ["text_id", "item", "m", "k", "n"]
    # A place counts in a window unless as many places of its shingle as the item has stand before it there.
    runs = dealt.groupBy(*keys, "h", "c").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    each = runs.select(*keys, "c", "ats", F.posexplode("ats").alias("i", "at"))
    marked = each.select(*keys, F.struct("at", F.get("ats", F.col("i") - F.col("c")).alias("prev")).alias("place"))
    pairs = saved(marked.groupBy(*keys).agg(F.sort_array(F.collect_list("place")).alias("places")))
    first, last = F.greatest("start", F.lit(0)), F.least(F.col("start") + F.col("m"), "n") - F.col("k")
    windows = _windows(pairs, similarity).select("text_id", "item", "m", "k", "start", "near", first.alias("first"), last.alias("last"))
    inside = lambda p: p["at"].between(F.col("first"), F.col("last")) & (p["prev"].isNull() | (p["prev"] < F.col("first")))
    shared = windows.select("text_id", "item", "start", (F.col("last") - F.col("first") + F.col("m") - F.col("k") + 2).alias("both"), F.size(F.filter("near", inside)).alias("shared"))
    scored = shared.select("text_id", "item", "start", (F.col("shared") / (F.col("both") - F.col("shared"))).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    return scored.where(F.col("similarity") >= similarity).groupBy("text_id", "item").agg(best.alias("best")).select(
        "text_id", "item", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, item_id, start (of the best window, in words; negative if cut at the beginning), similarity.

    One row per document and item that it leaks. Null texts have no words. Rows that repeat a
    doc_id are searched one by one and reported once; a missing doc_id is reported as null.
    An empty benchmark leaks nothing.
    """
    listed = saved(items(benchmark))
    sure = saved(leaking_texts(docs, listed, similarity))
    named = sure.join(listed.select("item_id", "item"), "item")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _text_id(docs).alias("text_id"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    return rows.join(named, "text_id").groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.similarity").alias("similarity")
    )


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of docs that leak no item; other rows of a leaking row's doc_id, missing or not, stay."""
    texts = leaking_texts(docs, saved(items(benchmark)), similarity).select("text_id").distinct()
    rows = docs.select(docs["doc_id"].cast("long").alias("_tallyhall_doc"), _text_id(docs).alias("text_id"))
    bad = rows.join(texts, "text_id", "left_semi").select("_tallyhall_doc", F.col("text_id").alias("_tallyhall_text")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_tallyhall_doc")) & (_text_id(docs) == F.col("_tallyhall_text"))
    return docs.join(bad, same, "left_anti")
