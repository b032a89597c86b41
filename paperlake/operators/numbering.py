"""Consecutive numbers over a whole table without one global sort task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, bucket: list[Column], order: list[Column], name: str = "id",
                start: Column | int = 1) -> DataFrame:
    """Add dense numbers following ``order``.

    ``bucket`` must sort consistently with ``order`` (be a coarser form of its
    leading part). NULL is a bucket of its own and comes first, as in Spark's
    ascending order. Rows are counted per bucket, the buckets get their offsets
    from a running sum, and only rows of one bucket are sorted together. Choose
    buckets that stay small: a hash prefix, or a position divided by a block
    size.
    """
    keys = [f"_b{i}" for i in range(len(bucket))]
    tagged = df.select("*", *(c.alias(k) for c, k in zip(bucket, keys)))
    running = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket, not per record
    offsets = (tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before")))
    within = Window.partitionBy(*keys).orderBy(*order)
    base = start if isinstance(start, Column) else F.lit(start)
    ranked = tagged.withColumn("_rn", F.row_number().over(within))
    offsets = offsets.withColumnsRenamed({k: f"{k}o" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}o")) for k in keys))
    return (ranked.join(offsets, same)
            .withColumn(name, (base + F.col("_before") + F.col("_rn") - 1).cast("long"))
            .drop(*keys, *(f"{k}o" for k in keys), "_rn", "_before"))


def number_by_hash(df: DataFrame, key: Column, name: str = "id", start: Column | int = 1, digits: int = 4) -> DataFrame:
    """Dense numbers in the order of the md5 of ``key``, which must be unique per row; NULL keys come first.

    ``digits`` hexadecimal digits of the hash name the bucket: 65536 buckets
    unless told otherwise. More digits give smaller sorts; the numbers are the
    same.
    """
    hashed = df.withColumn("_h", F.md5(key.cast("string")))
    return number_rows(hashed, [F.substring("_h", 1, digits)], [F.col("_h")], name, start).drop("_h")
