"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, app: str = "tallyhall") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to a folder on this machine: elsewhere
    the executors could not see it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyhall-")
    return f"{base.rstrip('/')}/tallyhall-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The same rows from a table written to the shared folder.

    For a costly input that is read several times: written once, it is not
    computed again, and a lost executor costs no more than re-reading a file.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
