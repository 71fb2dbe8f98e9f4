"""Quality rules: fixed rules first, then robust multivariate outliers per language and source.

Every document's statistics are made in its own row, so no word or line is ever shuffled.
Their transformed vectors are whole numbers (units of 1/SCALE): sums over any number of rows
are exact, and the estimates don't depend on the order of tasks.

Per group the minimum-covariance-determinant estimate is sought by concentration steps from
several fixed starts: keep the share CORE of rows that lie nearest, take their mean and
covariance, and repeat; of the ends, that with the least determinant stays. The starts are
medians with median deviations, medians with the correlations of squashed values, and the
plain mean and covariance. Groups and starts are handled together, in aggregates of a row
per group and start that are merged before they are shuffled; a hot group costs no task more than others.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhall.llm.common import words
from tallyhall.session import saved

SCALE = 4096
# Share of a group's rows that an estimate rests on, and concentration steps from each start.
CORE = 0.75
STEPS = 4
# Fixed value: the CORE quantile of chi-square with as many degrees of freedom as there are statistics (5).
CORE_DISTANCE = 6.6257
# Rows beyond this squared distance are rejected: ten deviations, as the tails of ordinary text are much
# heavier than those of a normal distribution.
CUTOFF = 100.0
# Estimates of up to so many groups (about 200 bytes each, times the starts) go to every task; more are joined by a shuffle.
FEW_GROUPS = 50_000
# Groups with fewer rows are pooled, first with the other such groups of their language, then of all.
LEAST_ROWS = 100
# Standard deviation added to each statistic, in its own unit: many texts have no symbol or repeat at all,
# and a covariance must not be singular.
FLOOR = (0.25, 0.05, 0.25, 0.25, 0.10)
# Distances are ranked by their logarithm in steps of 1/BINS.
BINS = 64
NAMES = ("length", "word_length", "symbols", "lines", "repeats")
PAIRS = [(a, b) for a in range(len(NAMES)) for b in range(a + 1)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Words are runs of characters other than the six blanks. word_chars: code points in words;
    n_symbols: characters of #*$%&|<>; n_dup_lines: lines with a word that equal an earlier
    line; n_repeat_words: words in three-word windows found at least twice in the text, the
    first time included, each word counted once. Null text has no words. Rows of one doc_id
    are judged one by one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        words(F.col("text")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "").alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    word = F.col("_words")
    starts = F.when(F.size(word) < 3, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(word) - 3))
    grams = read.withColumn(
        "_grams", F.transform(starts, lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)))
    )
    counted = grams.select(
        "doc_id", "lang", "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_grams") == F.size(F.array_distinct("_grams")), F.lit(0)).otherwise(_covered("_grams"))
        .cast("long").alias("n_repeat_words"),
    )
    return counted


def _covered(grams: str) -> Column:
    """Words within windows whose hash occurs at least twice: windows sorted by hash stand beside their equals."""
    placed = F.array_sort(F.transform(F.col(grams), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = F.transform(
        F.array(placed),
        lambda p: F.array_sort(
            F.transform(
                F.filter(
                    p,
                    lambda x, n: F.coalesce(F.get(p, n - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(p, n + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    # Consecutive starts less than three apart share words.
    return F.aggregate(
        F.get(found, F.lit(0)),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )


def failed(row_words: Column, repeat_words: Column) -> Column:
    return (row_words < 50) | (100 * repeat_words > 50 * row_words)


def vectors() -> list[Column]:
    """The statistics, brought to scales on which ordinary text spreads evenly, as whole numbers."""
    n = F.col("n_words").cast("double")
    parts = (
        F.log1p(n),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(n, F.lit(1.0))),
        F.log1p(100.0 * F.col("n_symbols") / F.greatest(n, F.lit(1.0))),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.sqrt(F.col("n_repeat_words") / F.greatest(n, F.lit(1.0))),
    )
    return [F.round(x * SCALE).cast("long").alias(name) for x, name in zip(parts, NAMES, strict=True)]


def _quantiles(bins: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    """Per key the smallest bin that at least `share` of its rows reach; exact, from counts."""
    counts = bins.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy(*keys)
    ranked = counts.select(*keys, "bin", F.sum("n").over(own.orderBy("bin")).alias("upto"), F.sum("n").over(own).alias("of"))
    return ranked.where(F.col("upto") >= F.ceil(F.lit(share) * F.col("of"))).groupBy(*keys).agg(F.min("bin").alias(name))


def _per_statistic(rows: DataFrame, value) -> DataFrame:
    """group, k, bin: a row per row and statistic."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), value(k).alias("bin")) for k in range(len(NAMES))])
    return rows.select("group", F.inline(each))


def _wide(quantiles: DataFrame, name: str) -> DataFrame:
    return quantiles.groupBy("group").agg(
        *[F.max(F.when(F.col("k") == k, F.col(name))).alias(f"{name}{k}") for k in range(len(NAMES))]
    )


def _starts(rows: DataFrame) -> DataFrame:
    """group, start, mean, covariance: medians with median deviations (0), with correlations of squashed values (1), plain moments (2)."""
    half = _wide(_quantiles(_per_statistic(rows, lambda k: F.col(NAMES[k])), ["group", "k"], 0.5, "m"), "m")
    off = rows.join(half, "group")
    spread = _per_statistic(off, lambda k: F.abs(F.col(NAMES[k]) - F.col(f"m{k}")))
    mad = _wide(_quantiles(spread, ["group", "k"], 0.5, "d"), "d")
    scale = [F.sqrt(F.pow(1.4826 * F.col(f"d{k}") / SCALE, F.lit(2)) + FLOOR[k] ** 2).alias(f"scale{k}") for k in range(len(NAMES))]
    centre = saved(half.join(mad, "group").select("group", *[(F.col(f"m{k}") / SCALE).alias(f"m{k}") for k in range(len(NAMES))], *scale))
    means = [F.col(f"m{k}").alias(f"mean{k}") for k in range(len(NAMES))]
    square = lambda a, b: F.pow(F.col(f"scale{a}"), F.lit(2)) if a == b else F.lit(0.0)
    medians = centre.select("group", F.lit(0).alias("start"), *means, *[square(a, b).alias(f"cov{a}{b}") for a, b in PAIRS])
    tanh = lambda k: F.tanh((F.col(NAMES[k]) / SCALE - F.col(f"m{k}")) / F.col(f"scale{k}"))
    squashed = rows.join(centre, "group").select(
        "group", F.lit(1).alias("start"), *[F.round(tanh(k) * SCALE).cast("long").alias(name) for k, name in enumerate(NAMES)]
    )
    bent = _moments(squashed).join(centre, "group")
    likeness = lambda a, b: F.col(f"cov{a}{b}") / F.sqrt(F.col(f"cov{a}{a}") * F.col(f"cov{b}{b}"))
    together = [(likeness(a, b) * F.col(f"scale{a}") * F.col(f"scale{b}")).alias(f"cov{a}{b}") for a, b in PAIRS]
    plain = _moments(rows.select("group", F.lit(2).alias("start"), *NAMES))
    return medians.unionByName(bent.select("group", "start", *means, *together)).unionByName(plain)


def _moments(core: DataFrame) -> DataFrame:
    """Mean and covariance of the rows given by group and start, from exact sums."""
    whole = lambda x: F.sum(x.cast("decimal(20,0)")).cast("double")
    sums = core.groupBy("group", "start").agg(
        F.count("*").cast("double").alias("n"),
        *[(whole(F.col(name)) / SCALE).alias(f"s{k}") for k, name in enumerate(NAMES)],
        *[(whole(F.col(NAMES[a]) * F.col(NAMES[b])) / SCALE**2).alias(f"p{a}{b}") for a, b in PAIRS],
    )
    means = sums.select("*", *[(F.col(f"s{k}") / F.col("n")).alias(f"mean{k}") for k in range(len(NAMES))])
    cov = lambda a, b: F.col(f"p{a}{b}") / F.col("n") - F.col(f"mean{a}") * F.col(f"mean{b}")
    return means.select(
        "group", "start",
        *[f"mean{k}" for k in range(len(NAMES))],
        *[((F.greatest(cov(a, b), F.lit(0.0)) + FLOOR[a] ** 2) if a == b else cov(a, b)).alias(f"cov{a}{b}") for a, b in PAIRS],
    )


def _factored(estimates: DataFrame) -> DataFrame:
    """The covariance's lower triangular factor in place of the covariance."""
    for b in range(len(NAMES)):
        squares = [F.pow(F.col(f"l{b}{j}"), F.lit(2)) for j in range(b)]
        estimates = estimates.withColumn(f"l{b}{b}", F.sqrt(F.greatest(sum((-x for x in squares), F.col(f"cov{b}{b}")), F.lit(1e-9))))
        below = {}
        for a in range(b + 1, len(NAMES)):
            known = [F.col(f"l{a}{j}") * F.col(f"l{b}{j}") for j in range(b)]
            below[f"l{a}{b}"] = sum((-x for x in known), F.col(f"cov{a}{b}")) / F.col(f"l{b}{b}")
        estimates = estimates.withColumns(below) if below else estimates
    return estimates.select("group", "start", *[f"mean{k}" for k in range(len(NAMES))], *[f"l{a}{b}" for a, b in PAIRS])


def _least(estimates: DataFrame) -> DataFrame:
    """Of each group's estimates that with the least determinant, the smaller start of equal ones."""
    factors = _factored(estimates)
    size = sum((F.log(F.col(f"l{k}{k}")) for k in range(1, len(NAMES))), F.log(F.col("l00")))
    first = factors.groupBy("group").agg(F.min_by("start", F.struct(size.alias("size"), "start")).alias("start"))
    return estimates.join(first, ["group", "start"])


def _distances(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """Rows, once for each estimate of their group, with start, the squared Mahalanobis distance and the bin of its logarithm."""
    factors = _factored(estimates)
    near = rows.join(F.broadcast(factors) if few else factors, "group")
    for k, name in enumerate(NAMES):
        known = [F.col(f"l{k}{j}") * F.col(f"z{j}") for j in range(k)]
        near = near.withColumn(f"z{k}", sum((-x for x in known), F.col(name) / SCALE - F.col(f"mean{k}")) / F.col(f"l{k}{k}"))
    square = sum((F.pow(F.col(f"z{k}"), F.lit(2)) for k in range(1, len(NAMES))), F.pow(F.col("z0"), F.lit(2)))
    kept = near.select(*rows.columns, "start", square.alias("square"))
    return kept.withColumn("bin", F.floor(F.log(F.col("square") + 1e-6) * BINS))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, distance, kept; one row per row of docs.

    base_failed: fewer than 50 words, or over half of them in repeated windows. Of the others,
    kept are those whose vector lies within CUTOFF of the estimate of their language and
    source, in units that put the CORE share of the group where a normal distribution has it.
    Null language or source counts as an empty one. A pool of fewer than LEAST_ROWS rows says
    nothing about its rows: all are kept, with a null distance.
    """
    counted = statistics(docs).withColumn("base_failed", failed(F.col("n_words"), F.col("n_repeat_words")))
    every = saved(counted.select("*", *vectors()))
    good = every.where("NOT base_failed")
    sizes = good.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    pools = sizes.where(small).groupBy("lang").agg(F.sum("n").alias("pool"))
    sizes = sizes.join(pools, "lang", "left").select(
        "lang", "source",
        F.when(~small, F.xxhash64(F.lit(0), "lang", "source"))
        .when(F.col("pool") >= LEAST_ROWS, F.xxhash64(F.lit(1), "lang"))
        .otherwise(F.lit(0)).alias("group"),
    )
    rows = saved(every.join(sizes, ["lang", "source"], "left").withColumn("group", F.when(~F.col("base_failed"), F.col("group"))))
    fit = rows.where(F.col("group").isNotNull()).select("group", *NAMES)
    sums = fit.groupBy("group").agg(F.count("*").alias("n"))
    large = saved(sums.where(F.col("n") >= LEAST_ROWS).select("group"))
    few = large.count() <= FEW_GROUPS
    known = lambda table: F.broadcast(table) if few else table
    fit = fit.join(known(large), "group", "left_semi")
    estimates, keys = saved(_starts(fit)), ["group", "start"]
    for _ in range(STEPS):
        away = _distances(fit, estimates, few)
        limit = _quantiles(away, keys, CORE, "limit")
        estimates = saved(_moments(away.join(known(limit), keys).where(F.col("bin") <= F.col("limit"))))
    estimates = saved(_least(estimates))
    limit = _quantiles(_distances(fit, estimates, few), ["group"], CORE, "limit")
    scaled = _factored(estimates).join(limit, "group").withColumn("unit", F.exp((F.col("limit") + 1) / BINS) / CORE_DISTANCE)
    near = rows.join(known(saved(scaled)), "group", "left")
    for k, name in enumerate(NAMES):
        before = [F.col(f"l{k}{j}") * F.col(f"z{j}") for j in range(k)]
        near = near.withColumn(f"z{k}", sum((-x for x in before), F.col(name) / SCALE - F.col(f"mean{k}")) / F.col(f"l{k}{k}"))
    square = sum((F.pow(F.col(f"z{k}"), F.lit(2)) for k in range(1, len(NAMES))), F.pow(F.col("z0"), F.lit(2)))
    return near.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (square / F.col("unit")).alias("distance"),
        (~F.col("base_failed") & F.coalesce(square / F.col("unit") <= CUTOFF, F.lit(True))).alias("kept"),
    )
