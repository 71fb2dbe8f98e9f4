"""Distinct counts and quantiles from sketches that merge: approximate, kept beside the exact ones.

A sketch is a small binary value. Sketches of parts, such as days, are merged into that of the whole, so
a new part is added without reading the others again. Exact operators stay the default everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Distinct counts: 2**LOG_K registers, a standard error of about 0.83 / sqrt(2**LOG_K).
LOG_K = 14
DISTINCT_ERROR = 0.83 / 2 ** (LOG_K / 2)
# Quantiles: with this size, ranks are off by less than RANK_ERROR with 99 % confidence.
KLL_K, RANK_ERROR = 800, 0.004


def distinct_sketch(value: Column | str) -> Column:
    """Aggregate: a sketch of the distinct non-null values."""
    return F.hll_sketch_agg(value, F.lit(LOG_K))


def merged(sketch: Column | str) -> Column:
    """Aggregate: the sketch of all values that any of the sketches has seen."""
    return F.hll_union_agg(sketch)


def estimate(sketch: Column | str) -> Column:
    """How many distinct values a sketch has seen, about; none for a missing sketch."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long")


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """by, sketch: a row per group, NaN and missing values left out; groups without values have no row."""
    read = df.select(*[F.col(f"`{c}`") for c in by], F.col(f"`{value}`").cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    return read.groupBy(*[f"`{c}`" for c in by]).agg(F.expr(f"kll_sketch_agg_double(_v, {KLL_K})").alias("sketch")).where("sketch IS NOT NULL")


def quantiles(sketches: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """by, a value per probability, n (values seen), from sketches merged over all other columns.

    Every value returned is one of the data, whose rank is off by less than RANK_ERROR (99 % confidence).
    """
    grouped = sketches.groupBy(*[f"`{c}`" for c in by]).agg(F.expr("kll_merge_agg_double(sketch)").alias("_s")).where("kll_sketch_get_n_double(_s) > 0")
    found = [F.expr(f"kll_sketch_get_quantile_double(_s, {float(p)!r}D)").alias(name) for name, p in probs.items()]
    return grouped.select(*[f"`{c}`" for c in by], *found, F.expr("kll_sketch_get_n_double(_s)").alias("n"))


def within(about: Column, exact: Column) -> Column:
    """Whether an estimate is within five standard errors of the exact count (and half a unit)."""
    return F.abs(about - exact) <= F.lit(5 * DISTINCT_ERROR) * exact + 0.5
