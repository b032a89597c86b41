"""A stored index of three-character runs, so that a rare keyword reads few texts.

``build`` deals the rows into parts of a bounded number of rows, writes them by
part, and beside them postings: for every run of three characters and every
part the places of the rows that hold it. ``search`` intersects the postings of
the keyword's runs, reads the parts with a surviving row only, and tests those
rows with the same exact match as a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import kernels
from paperlake.operators.lookup import keyword_match
from paperlake.runtime import MAX_INLINE_ROWS, cut_lineage

GRAM_BUCKETS = 64
STRIPES = 8
_POSTING = "bucket int, gram bigint, part int, places array<int>"


def _fields(columns, terms: str | None) -> Column:
    """All lower-cased texts of a row as one list without nulls."""
    texts = F.array(*(F.lower(c) for c in columns))
    if terms:
        texts = F.concat(texts, F.transform(F.coalesce(terms, F.array().cast("array<string>")), F.lower))
    return F.array_compact(texts)


def build(rows: DataFrame, root: str, part_rows: int = 50_000, columns=("title", "abstract"),
          terms: str | None = "mesh_terms") -> None:
    """Write texts and postings of ``rows`` below ``root``.

    Rows are dealt out in turn, so copies and repeated ids fill no part more
    than others. Null texts and tags have no runs. The postings come from the
    written rows, part by part, in the task that reads them; they are shuffled
    once, by bucket of the run and by stripe of the parts, so that a run that
    every part holds is spread over ``STRIPES`` tasks.
    """
    parts = max(1, -(-rows.count() // part_rows))
    dealt = (rows.repartition(parts).withColumn("part", F.spark_partition_id())
             .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).cast("int")))
    dealt.write.partitionBy("part").parquet(f"{root}/texts")
    stored = texts(rows.sparkSession, root, rows)
    postings = (stored.select("part", "place", _fields(columns, terms).alias("fields"))
                .mapInArrow(kernels.gram_postings(GRAM_BUCKETS), _POSTING))
    (postings.repartition("bucket", F.col("part") % STRIPES).sortWithinPartitions("bucket", "gram", "part")
     .write.partitionBy("bucket").parquet(f"{root}/postings"))


def texts(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """The stored rows with ``part`` and ``place``; ``rows`` gives the columns."""
    schema = T.StructType([*rows.schema, T.StructField("place", T.IntegerType()), T.StructField("part", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{root}/texts")


def candidates(spark: SparkSession, root: str, keyword: str) -> DataFrame:
    """(part, place, runs): rows holding every three-character run of ``keyword``, which has three characters or more."""
    grams = kernels.gram_codes(keyword.lower())
    buckets = sorted({int(g) % GRAM_BUCKETS for g in grams})
    found = (spark.read.schema(_POSTING).parquet(f"{root}/postings")
             .filter(F.col("bucket").isin(buckets) & F.col("gram").isin([int(g) for g in grams]))
             .select("part", F.explode("places").alias("place")))
    return found.groupBy("part", "place").agg(F.count(F.lit(1)).alias("runs")).filter(F.col("runs") == len(grams))


def search(spark: SparkSession, root: str, rows: DataFrame, keyword: str, columns=("title", "abstract"),
           terms: str | None = "mesh_terms") -> DataFrame:
    """Rows of the index whose texts or tags hold ``keyword``, as ``rows.filter(keyword_match(keyword))`` gives them.

    ``rows`` gives the columns, its content is not read. Up to
    ``MAX_INLINE_ROWS`` candidates are broadcast and prune the parts that are
    read; for a keyword with more of them the join is shuffled and every part is
    read. Keywords of one or two characters have no run and scan the stored
    texts.
    """
    exact = keyword_match(keyword, columns, terms)
    stored = texts(spark, root, rows)
    if len(keyword) >= 3:
        kept = cut_lineage(candidates(spark, root, keyword), "candidates")
        # the filter holds for every row; Spark prunes parts only by a filtered side
        few = kept.filter(F.col("runs") >= 1)
        side = F.broadcast(few) if kept.count() <= MAX_INLINE_ROWS else few
        stored = stored.join(side, ["part", "place"], "left_semi")
    return stored.filter(exact).select(*rows.columns)
