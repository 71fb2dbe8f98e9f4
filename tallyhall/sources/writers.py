"""Writers for cleaned tables, results, the cleaning log and the summary. All overwrite, tables of the catalog by day."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
PARTITIONED_BY = {"behavior": "date"}


def write_cleaned(df: DataFrame, cleaned_dir: str, table: str) -> None:
    """A cleaned table as Parquet; behaviour events in one folder per date.

    The rebalance hint evens out file sizes: days of any size are split or
    merged at run time, so a heavy day does not end up in one task.
    """
    day = PARTITIONED_BY.get(table)
    out = df.hint("rebalance", day) if day else df.hint("rebalance")
    writer = out.write.mode("overwrite")
    if day:
        writer = writer.partitionBy(day)
    writer.parquet(f"{cleaned_dir}/{table}")


def write_cleaned_csv(df: DataFrame, path: str) -> None:
    """A cleaned table as gzip CSV with a header, for other tools."""
    df.write.mode("overwrite").options(header=True, compression="gzip", escape='"').csv(path)


def write_result(df: DataFrame, results_dir: str, name: str, as_csv: bool = False) -> int:
    """A named result as Parquet (and CSV), counted while it is written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{results_dir}/{name}")
    if as_csv:
        saved = df.sparkSession.read.parquet(f"{results_dir}/{name}")
        saved.write.mode("overwrite").csv(f"{results_dir}/csv/{name}", header=True)
    return seen.get["rows"]


def write_entry(spark: SparkSession, ledger: str, name: str, rows: int) -> None:
    """Enter an answered question in a ledger, a folder of its own each: questions that end together do not meet."""
    spark.createDataFrame(pa.table({"name": [name], "rows": [rows]})).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{name}")


def write_log(report: DataFrame, path: str) -> None:
    """The cleaning log as one CSV file, in order; it has 21 rows."""
    ordered = report.coalesce(1).sortWithinPartitions("seq").drop("seq")
    ordered.write.mode("overwrite").csv(path, header=True)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").json(path)


def add_to_table(df: DataFrame, table: str, day: str, path: str | None = None) -> None:
    """Put the days of df into a table of the catalog, which is made if it isn't there (at path, if given).

    A folder per day: days that the table holds already are replaced as a whole, others stay, so that a
    load can be run again. Columns are matched by name; one that the table lacks ends the run.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.limit(0).write.format("parquet").partitionBy(day)
        (writer.option("path", path) if path else writer).saveAsTable(table)
    columns = spark.table(table).columns
    unknown = set(df.columns) - set(columns)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    rows = df.select(*columns).hint("rebalance", day)
    # insertInto takes the mode from the session alone.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def save_view(df: DataFrame, name: str) -> None:
    """Offer a table to SQL under a name, replacing an earlier one."""
    df.createOrReplaceTempView(name)
