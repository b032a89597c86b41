"""Splitting groups into bounded cells so that no task meets a whole hot group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import small_side

BLOCK_ROWS = 8192
SIDES = 8
GRID_ROWS = 100_000


def to_cells(df: DataFrame, group: list[str], row_key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``df`` placed into the cells of a grid over each group.

    A group above ``block_rows`` is cut by hash into blocks of about that size;
    cell (i, j) holds block i (side 0) and block j (side 1), cell (i, i) block i
    alone. Every two rows of a group meet in exactly one cell and no cell holds
    more than about two blocks, however large the group is. The output is
    partitioned and sorted by ``cell``. Rows alone in their group can meet
    nothing and are dropped before the shuffle; so are rows with a NULL group.
    """
    if group:
        pairing = (df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                   .select(*group, F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")))
        sized = df.join(small_side(pairing), group)
    else:
        blocks = df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int")).scalar()
        sized = df.withColumn("_blocks", blocks)
    placed = (sized.withColumn("_block", F.pmod(F.xxhash64(row_key), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    name = F.concat_ws("\u0001", *(F.col(g).cast("string") for g in group), low.cast("string"), high.cast("string"))
    return (placed.withColumn("cell", F.md5(name))
            .withColumn("lone", (F.col("_block") == F.col("_other")).cast("int"))
            .withColumn("side", F.when(F.col("_block") <= F.col("_other"), 0).otherwise(1))
            .drop("_blocks", "_block", "_other")
            .repartition("cell").sortWithinPartitions("cell"))


def to_rect_cells(left: DataFrame, right: DataFrame, group: str, row_key: str,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cells in which every left row (side 0) of a group meets every right row (side 1) once.

    Both sides of a group are cut by hash into blocks of about ``block_rows``.
    Groups lacking one side give no cells. ``left`` and ``right`` have the same
    columns.
    """
    def blocks(df, name):
        return df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    sizes = small_side(blocks(left, "_left").join(blocks(right, "_right"), group))

    def side(df, number, own, other):
        return (df.join(sizes, group)
                .withColumn("_own", F.pmod(F.xxhash64(row_key), F.col(own)).cast("int"))
                .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .withColumn("side", F.lit(number)))

    both = (side(left, 0, "_left", "_right").withColumn("_l", F.col("_own")).withColumn("_r", F.col("_other"))
            .unionByName(side(right, 1, "_right", "_left").withColumn("_l", F.col("_other"))
                         .withColumn("_r", F.col("_own"))))
    name = F.concat_ws("\u0001", *(F.col(c).cast("string") for c in (group, "_l", "_r")))
    return (both.withColumn("cell", F.md5(name)).select(*left.columns, "cell", "side")
            .repartition("cell").sortWithinPartitions("cell"))


def to_grid(left: DataFrame, right: DataFrame, row_key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cells in which every left row (side 0) meets every right row (side 1) once, for a join of all with all.

    Both sides are cut by hash into blocks, ``SIDES`` of them at most as long as
    these have no more than ``GRID_ROWS`` rows (a short left side leaves its share of the cells to
    the right one). So a row is copied a fixed number of times,
    however small ``block_rows`` is, and a task holds two blocks. The sides have the same columns.
    """
    def blocks(rows: int, most: int) -> int:
        return max(1, min(-(-rows // block_rows), most), -(-rows // GRID_ROWS))

    n_left, n_right = left.count(), right.count()
    down = blocks(n_left, SIDES)
    across = blocks(n_right, max(SIDES, SIDES * SIDES // down))

    def side(df, number, own, other):
        return (df.withColumn("side", F.lit(number)).withColumn("_own", F.pmod(F.xxhash64(row_key), F.lit(own)).cast("int"))
                .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))))

    both = (side(left, 0, down, across).withColumn("cell", F.col("_own") * across + F.col("_other"))
            .unionByName(side(right, 1, across, down).withColumn("cell", F.col("_other") * across + F.col("_own"))))
    # one cell a task: they are alike in size, and few
    return both.drop("_own", "_other").repartitionById(down * across, F.col("cell"))
