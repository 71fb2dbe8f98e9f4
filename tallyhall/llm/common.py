"""Text expressions and working tables shared by the operators."""

from __future__ import annotations

import string
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhall.session import CHECKPOINT_KEY, shared_dir

# The characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters other than the six blanks; null text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANKS}]+"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character untouched.

    Text of ASCII alone takes the fast built-in; elsewhere that would change other letters too.
    """
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(mapped)


def finite(vector: Column) -> Column:
    """Whether an array of doubles is there and all its components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNull(), False).otherwise(F.coalesce(whole, F.lit(False)))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, checkpointed in the shared folder: loops stay short and survive lost executors."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(df.sparkSession.conf.get(CHECKPOINT_KEY, None) or shared_dir(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: their Python workers import it by name."""
    context = spark.sparkContext
    if getattr(context, "_tallyhall_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tallyhall-code-")) / "tallyhall.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallyhall_shipped = True
