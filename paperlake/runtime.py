"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table that is broadcast or travels inside a plan. Larger ones take
# the form without a broadcast and give the same result.
MAX_INLINE_ROWS = 10_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "paperlake", **conf: str) -> SparkSession:
    """A session with the settings the library expects.

    Shuffle partitions are left to the cluster unless given: AQE coalesces a
    high number, it cannot split a low one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    A temporary local folder is used only by a local master without that
    setting, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="paperlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, bound: int = MAX_INLINE_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be within ``bound`` rows.

    Otherwise it is returned unmarked and the join is shuffled, with AQE
    splitting skewed partitions. The rows are written to the work folder, so
    the count costs no second run, nothing stays in memory, and a later call
    sees later data.
    """
    kept = cut_lineage(df, "small-side")
    return F.broadcast(kept) if kept.count() <= bound else kept
