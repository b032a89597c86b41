"""A filter of fixed size over 64-bit hashes, gathered as a bitmap.

The bitmap has ``BITS`` bits whatever the table holds, so what the driver
gathers and the tasks receive is bounded. It only spares a shuffle rows that
a following exact join would drop: where it fills up it lets more rows pass
and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25
_PAGE = 1 << 15  # bits of one value of bitmap_construct_agg


def gather(df: DataFrame, column: str) -> np.ndarray:
    """Bytes of the bitmap of a hash column; nulls are left out."""
    place = F.pmod(F.col(column), F.lit(BITS))
    pages = (df.filter(F.col(column).isNotNull())
             .groupBy(F.floor(place / _PAGE).cast("int").alias("page"))
             .agg(F.bitmap_construct_agg(place % _PAGE).alias("bits")).collect())
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for page, bits in pages:
        out[page * _PAGE // 8:(page + 1) * _PAGE // 8] = np.frombuffer(bits, dtype=np.uint8)
    return out


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.astype(np.int64) & (BITS - 1))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def only(bitmap: np.ndarray, column: str, wanted: bool):
    """Rows whose hash in ``column`` is in the bitmap, or with ``wanted=False`` the others; for ``mapInArrow``."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(holds(bitmap, batch.column(column).to_numpy()) == wanted))

    return run


def meet(rows: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left-joined with ``few`` on ``keys``, shuffling only rows that may have a match.

    For wide rows of which some have a match: the others pass in place. The
    join is a sort-merge join at every size, which splits hot keys.
    """
    place = F.xxhash64(*keys)
    bitmap = gather(few.select(place.alias("_place")), "_place")
    marked = rows.withColumn("_place", place)
    held = marked.mapInArrow(only(bitmap, "_place", True), marked.schema).drop("_place").join(few.hint("merge"), keys, "left")
    rest = marked.mapInArrow(only(bitmap, "_place", False), marked.schema).drop("_place")
    added = [F.lit(None).cast(few.schema[c].dataType).alias(c) for c in few.columns if c not in keys]
    return held.select(*rows.columns, *(c for c in few.columns if c not in keys)).unionByName(rest.select("*", *added))
