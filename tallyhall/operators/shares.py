"""Small operators on result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyhall.functions.numbers import pct


def share(result: DataFrame, count: str, name: str) -> DataFrame:
    """Add each row's percentage of the column total.

    For results with a row per group, never for rows of a base table: the total
    is a window over all rows.
    """
    return result.withColumn(name, pct(F.col(count), F.sum(count).over(Window.partitionBy())))


def multi_row_gate(result: DataFrame) -> DataFrame:
    """The result if it has more than one row, else nothing."""
    n = F.count("*").over(Window.partitionBy())
    return result.withColumn("_rows", n).where(F.col("_rows") > 1).drop("_rows")
