"""Readers for raw files, the cleaned layer, saved results and the summary."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.functions.numbers import to_double
from tallyhall.functions.text import BLANK, PANDAS_NA, blank_out, strip
from tallyhall.operators.sentiment import PHRASE_WORDS
from tallyhall.schemas import CLEANED, RAW, texts

# Names that change between the cleaned layer and the analysis tables, and the
# columns the analysis keeps. None keeps everything.
RENAMED = {
    "listings": {"neighbourhood_cleansed": "neighbourhood"},
    "reviews": {"Date": "review_date", "Rating": "rating"},
}
ANALYSIS_COLUMNS = {
    "listings": (
        "id", "host_id", "host_name", "host_is_superhost", "host_listings_count", "host_scale",
        "neighbourhood", "room_type", "property_type", "accommodates", "bedrooms", "beds", "price",
        "price_winsor", "minimum_nights", "number_of_reviews", "number_of_reviews_ltm",
        "review_scores_rating", "availability_365", "estimated_revenue_l365d", "occupancy_ratio",
    ),
    "reviews": (
        "business_id", "business_name", "review_date", "rating", "review_len", "word_count",
        "elite_flag", "sentiment", "sentiment_label",
    ),
}


def read_behavior_csv(
    spark: SparkSession, path: str | Sequence[str], na_tokens: Iterable[str] = PANDAS_NA
) -> DataFrame:
    """Headerless CSV of five text columns. Plain files are split among tasks."""
    df = spark.read.schema(texts(*RAW["behavior"])).csv(path, header=False)
    return _without_na(df, na_tokens)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    dataset: str,
    na_tokens: Iterable[str] = PANDAS_NA,
    partitions: int | None = None,
) -> DataFrame:
    """CSV with a header, plain or gzip, cells may span lines; the dataset's columns as text.

    Columns are found by header name, so a file may hold others in any order. Several
    files must agree in their headers: one that doesn't ends the run, it isn't read by place.
    Such a file is one task each: give `partitions` to spread few large files.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    header = reader.csv(path).schema
    df = reader.schema(header).option("enforceSchema", False).csv(path).select(*RAW[dataset])
    if partitions:
        df = df.repartition(partitions)
    return _without_na(df, na_tokens)


def _without_na(df: DataFrame, na_tokens: Iterable[str]) -> DataFrame:
    marks = tuple(na_tokens)
    return df.select(*[blank_out(F.col(c), marks).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, paths: dict[str, str], partitions: int | None = None) -> dict[str, DataFrame]:
    """All raw datasets from their files."""
    return {
        name: read_behavior_csv(spark, path)
        if name == "behavior"
        else read_csv(spark, path, name, partitions=partitions)
        for name, path in paths.items()
    }


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated token and mean valence; further columns and unreadable valences are ignored.

    A valence that six decimal places do not hold ends the run.
    """
    raw = spark.read.schema(texts("token", "valence")).csv(path, sep="\t", quote="")
    exact, number = F.col("valence").try_cast("decimal(18,6)"), to_double("valence")
    misfit = F.raise_error(F.concat(F.lit("valence with more digits than are kept: "), "valence"))
    kept = F.when(exact.isNull() | (exact.cast("double") != number), misfit.cast("decimal(18,6)")).otherwise(exact)
    return raw.select("token", F.when(number.isNotNull(), kept).alias("valence")).dropna()


def read_modifiers(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated token and kind: 1 strengthens what follows, -1 weakens it, 0 negates it."""
    raw = spark.read.schema(texts("token", "kind")).csv(path, sep="\t", quote="")
    return raw.select(F.lower("token").alias("token"), F.col("kind").try_cast("int").alias("kind")).where("kind IN (-1, 0, 1)")


def read_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated phrase and mean valence, as read_lexicon(); blanks between words count as one.

    A phrase of fewer than two or more than four words ends the run.
    """
    read = read_lexicon(spark, path).withColumn("token", F.lower(F.regexp_replace(strip(F.col("token")), f"{BLANK}+", " ")))
    misfit = F.raise_error(F.concat(F.lit("phrase of fewer than two or more than four words: "), "token"))
    return read.withColumn("token", F.when(F.size(F.split("token", " ")).isin(*PHRASE_WORDS), F.col("token")).otherwise(misfit.cast("string")))


def load_table(
    spark: SparkSession, cleaned_dir: str, table: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """A cleaned table, all columns or some."""
    reader = spark.read.schema(CLEANED[table]) if table in CLEANED else spark.read
    df = reader.parquet(f"{cleaned_dir}/{table}")
    return df.select(*cols) if cols else df


def renamed(df: DataFrame, table: str) -> DataFrame:
    """A cleaned table under its analysis names."""
    return df.withColumnsRenamed(RENAMED.get(table, {}))


def for_analysis(df: DataFrame, table: str) -> DataFrame:
    """A cleaned table under its analysis names and columns."""
    cols = ANALYSIS_COLUMNS.get(table)
    return renamed(df, table).select(*cols) if cols else renamed(df, table)


def load_analysis(spark: SparkSession, cleaned_dir: str, table: str) -> DataFrame:
    return for_analysis(load_table(spark, cleaned_dir, table), table)


def load_result(spark: SparkSession, results_dir: str, name: str) -> DataFrame:
    """A saved result by its name."""
    return spark.read.parquet(f"{results_dir}/{name}")


def read_ledger(spark: SparkSession, ledger: str, names: Sequence[str]) -> dict[str, int]:
    """Rows of each of the named results that the ledger holds, an entry cut off while it was written not counted."""
    files = spark._jvm.org.apache.hadoop.fs
    there = []
    for name in names:  # no more than there are questions
        done = files.Path(f"{ledger}/{name}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            there.append(f"{ledger}/{name}")
    entries = spark.read.schema("name STRING, rows LONG").parquet(*there).collect() if there else []
    return {r["name"]: r["rows"] for r in entries}


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The cleaning summary: one row, a struct per dataset."""
    return spark.read.option("multiLine", True).json(path)
