"""A search index with the latest entries first, stored as the batches that brought them.

An entry keeps its order key for good: the number of its batch and its place in
it. Putting a batch in front writes that batch alone. Which entries are live and
the dense ``pos`` of each are worked out when the index is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.operators.numbering import number_rows
from paperlake.operators.upsert import latest_by_key

ORDER_KEY = T.StructType([T.StructField("place", T.LongType()), T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class FrontIndex:
    """Place and columns. ``schema`` holds the columns of an entry, ``slug`` among them, without ``pos``."""

    root: str
    schema: T.StructType

    def scan(self, spark: SparkSession) -> DataFrame:
        """All entries that ever came, with ``place`` and ``batch``; a filter on ``batch`` prunes folders."""
        return spark.read.schema(T.StructType([*self.schema, *ORDER_KEY])).parquet(self.root)

    def live(self, spark: SparkSession) -> DataFrame:
        """The entry of the last batch for every slug; entries without slug share one."""
        return latest_by_key(self.scan(spark), "slug", [F.desc("batch")])


def _write(entries: DataFrame, table: FrontIndex) -> None:
    (entries.select(*table.schema.fieldNames(), "place", "batch").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(table.root))


def create(index: DataFrame, table: FrontIndex) -> None:
    """Store ``index``, unique by slug and ordered by ``pos``, as batch 0."""
    _write(index.withColumn("place", F.col("pos").cast("long")).withColumn("batch", F.lit(0).cast("long")), table)


def push_front(table: FrontIndex, arrivals: DataFrame, batch: int) -> None:
    """Put ``arrivals`` in front as batch number ``batch``, the latest by ``pos`` first.

    Of several arrivals with one slug the latest counts; one without ``pos``
    counts last for its slug and comes first in its batch, as in
    ``upsert.upsert_index_front``. Nothing stored is read or rewritten. A batch
    that is repeated after a failure, under its number, replaces what it left.
    An empty batch changes nothing.
    """
    if batch < 1:
        raise ValueError("batches are numbered from 1; 0 is the index they are put in front of")
    newest = latest_by_key(arrivals, "slug", [F.desc("pos")])
    _write(newest.withColumn("place", -F.col("pos").cast("long")).withColumn("batch", F.lit(batch).cast("long")), table)


def export(spark: SparkSession, table: FrontIndex, block: int = 10_000) -> DataFrame:
    """Live entries with ``pos`` from 1, without a global sort: places are sorted in blocks of a batch."""
    bucket = [-F.col("batch"), F.floor(F.col("place") / block)]
    return number_rows(table.live(spark), bucket, [-F.col("batch"), F.col("place")], "pos").drop("batch", "place")


def compact(spark: SparkSession, table: FrontIndex, root: str) -> FrontIndex:
    """A copy at ``root`` with the live entries only, their order keys unchanged, so later batches fit it."""
    copy = FrontIndex(root, table.schema)
    _write(table.live(spark), copy)
    return copy
