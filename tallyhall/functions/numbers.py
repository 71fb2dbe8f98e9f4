"""Column expressions for coercion, ratios, means and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def double_sql(text: str) -> str:
    """SQL: a text as DOUBLE if it reads as a finite number.

    A cast alone would take 'nan', 'inf' and '12d' as well. In SQL, NaN is above infinity.
    """
    number = f"try_cast({text} AS double)"
    return (
        f"CASE WHEN abs({number}) < double('inf') AND right(rtrim({text}), 1) NOT IN ('d', 'D', 'f', 'F') "
        f"THEN {number} END"
    )


def to_double(text: str) -> Column:
    """Text (a SQL expression) to DOUBLE; null where it is not a finite number."""
    return F.expr(double_sql(text))


def to_long(text: str) -> Column:
    """Text (a SQL expression) to BIGINT, dropping any fraction; null where not a number.

    Plain integers take the first branch.
    """
    return F.expr(f"coalesce(try_cast({text} AS bigint), try_cast({double_sql(text)} AS bigint))")


def pct(part: Column, whole: Column) -> Column:
    """part as a percentage of whole; null when whole is 0 or null."""
    return F.try_divide(part.cast("double") * F.lit(100), whole)


def mean(value: Column) -> Column:
    """Mean of the non-null values, from an exact decimal sum where it fits.

    A sum of doubles changes in its last digits with task order; a sum of decimals with
    eighteen places does not. Values or sums beyond its twenty whole digits fall back on
    the plain mean.
    """
    exact = value.try_cast("decimal(38,18)")
    total = F.when(F.count(exact) == F.count(value), F.try_sum(exact)).cast("double")
    return F.coalesce(F.try_divide(total, F.count(value)), F.avg(value))


def cut_right(value: Column, low: float, bands: Sequence[tuple[float, str]]) -> Column:
    """Label for right-closed bands (low, e1], (e1, e2] ...; null outside."""
    out = F.when(value <= F.lit(low), F.lit(None).cast("string"))
    for edge, label in bands:
        out = out.when(value <= F.lit(edge), F.lit(label))
    return out


def cut_left(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """Label for left-closed bands below each edge; an edge of None is open."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in bands:
        out = out.otherwise(F.lit(label)) if edge is None else out.when(value < F.lit(edge), F.lit(label))
    return out


def ordinal(label: Column, order: Sequence[str]) -> Column:
    """1-based place of a label in an explicit order; null if not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), label), F.lit(0)).cast("int")
