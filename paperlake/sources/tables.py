"""Parquet tables: scans with fixed columns, refresh and versioned replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paperlake import schemas


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table with explicit columns; filters and pruning reach the files."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def scan_papers(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.PAPERS)


def scan_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.EMBEDDINGS)


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.GENERATION_LOG)


def _clustered(df: DataFrame, cluster_by: list[str] | None) -> DataFrame:
    """Rows ordered by range across and inside files, so that file statistics prune scans.

    End the list with a unique column: a value held by very many rows is then
    still split over several files.
    """
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df


def reload_table(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a table that ``df`` does not read from; returns the new content."""
    _clustered(df, cluster_by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str = "pmid") -> DataFrame:
    """Catalog table bucketed and sorted by id. Two of them with equal bucket counts join without a shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions below ``root``, oldest first, on any Hadoop file system."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    found = [int(n[2:]) for n in names if n.startswith("v=")]
    return sorted(v for v in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}/_SUCCESS")))


def write_version(df: DataFrame, root: str, cluster_by: list[str] | None = None) -> str:
    """Write ``df``, which may read the current version, as the next one.

    Readers see it once its _SUCCESS marker is there; a failed job changes
    nothing. Papers are best clustered by ``["pub_date", "pmid"]``, as most
    reports look at recent dates, embeddings by ``["pmid"]``.
    """
    path = f"{root}/v={max(versions(df.sparkSession, root), default=0) + 1}"
    _clustered(df, cluster_by).write.mode("overwrite").parquet(path)
    return path


def read_latest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Newest complete version; an empty table when there is none."""
    found = versions(spark, root)
    if not found:
        return spark.createDataFrame([], schema)
    return scan(spark, f"{root}/v={found[-1]}", schema)
