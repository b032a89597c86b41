"""Parquet tables dealt into buckets by a hash of their key, so that an upsert rewrites what it touches.

A table is a folder with one partition folder for each bucket. An upsert reads
and replaces the buckets of the batch's keys only, by Spark's dynamic partition
overwrite. The new buckets are written whole to the work folder before any old
one goes: a failed merge changes nothing, and whoever loses the driver while
buckets are being replaced repeats ``publish`` with the staged rows.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.operators import upsert
from paperlake.runtime import cut_lineage


@dataclass(frozen=True)
class BucketedTable:
    """Place and layout. The number of buckets is part of the folder's name, as another one is another layout.

    A bucket should hold some hundred megabytes: the cost of an upsert is that
    of the buckets it touches.
    """

    root: str
    schema: T.StructType
    key: str = "pmid"
    buckets: int = 256

    @property
    def path(self) -> str:
        return f"{self.root}/{self.key}-{self.buckets}"

    def bucket(self) -> Column:
        """Bucket of a row; rows without key share the one of the hash of null."""
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def scan(self, spark: SparkSession) -> DataFrame:
        """All rows with ``bucket``; a filter on it prunes folders."""
        return spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.scan(spark).select(*self.schema.fieldNames())


def create(df: DataFrame, table: BucketedTable) -> None:
    """Write ``df``, which does not read ``table``, as its whole content."""
    rows = df.select(*table.schema.fieldNames(), table.bucket().alias("bucket"))
    (rows.repartition("bucket").sortWithinPartitions("bucket", table.key)
     .write.mode("overwrite").partitionBy("bucket").parquet(table.path))


def publish(staged: DataFrame, table: BucketedTable) -> None:
    """Replace every bucket that occurs in ``staged`` by its rows there; repeating it changes nothing."""
    (staged.repartition("bucket").sortWithinPartitions("bucket", table.key)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table.path))


def merge_batch(table: BucketedTable, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Apply ``merge(rows of the touched buckets, incoming)`` and return the staged rows.

    ``merge`` may add and change rows of the batch's keys; it must keep all
    others. The batch is written to the work folder first and read from there.
    The numbers of the touched buckets, at most ``table.buckets``, pass through
    the driver into the scan's filter. An empty batch touches nothing.
    """
    spark = incoming.sparkSession
    batch = cut_lineage(incoming, "batch")
    touched = [r["bucket"] for r in batch.select(table.bucket().alias("bucket")).distinct().collect()]
    current = table.scan(spark).filter(F.col("bucket").isin(touched)).select(*table.schema.fieldNames())
    merged = merge(current, batch).select(*table.schema.fieldNames(), table.bucket().alias("bucket"))
    staged = cut_lineage(merged, "buckets")
    if touched:
        publish(staged, table)
    return staged


def upsert_papers(table: BucketedTable, incoming: DataFrame, now, **kw) -> DataFrame:
    """``upsert.upsert_papers`` on the touched buckets."""
    return merge_batch(table, incoming, lambda current, batch: upsert.upsert_papers(current, batch, now, **kw))


def upsert_embeddings(table: BucketedTable, incoming: DataFrame) -> DataFrame:
    """``upsert.upsert_embeddings`` on the touched buckets."""
    return merge_batch(table, incoming, upsert.upsert_embeddings)
