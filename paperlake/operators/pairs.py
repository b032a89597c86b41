"""Pairs of papers on one topic, and pairs with opposing conclusions.

Two papers share a topic when they have the same category and at least one tag
in common. Nothing here lists all pairs of a topic: similarity, polarity and
the top-n are applied where the two rows meet, and hot tags are cut into
bounded cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake import kernels, vocab
from paperlake.functions import text as T
from paperlake.operators.cells import BLOCK_ROWS, to_cells
from paperlake.runtime import cut_lineage, small_side

PROBE_ROWS = 512
RANGES = 5


def topic_sizes(papers: DataFrame) -> DataFrame:
    """Papers and unordered pairs per (category, tag), counted without listing a pair."""
    return (papers.filter(F.col("category").isNotNull())
            .select("category", F.explode(F.array_distinct("mesh_terms")).alias("term"))
            .groupBy("category", "term").agg(F.count(F.lit(1)).alias("n_papers"))
            .withColumn("n_pairs", (F.col("n_papers") * (F.col("n_papers") - 1) / 2).cast("long")))


def _with_vectors(papers: DataFrame, embeddings: DataFrame) -> DataFrame:
    vectors = embeddings.filter(F.exists("embedding", lambda x: x != 0)).select(
        "pmid", F.col("embedding").alias("vec"))
    return (papers.filter(F.col("category").isNotNull() & (F.size("mesh_terms") > 0))
            .join(vectors, "pmid").withColumnRenamed("pmid", "id")
            .withColumn("terms", F.array_distinct("mesh_terms")))


def topic_pairs(papers: DataFrame, embeddings: DataFrame, min_similarity: float = 0.5,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Topic pairs whose vectors are at least ``min_similarity`` alike, with shared tags.

    A pair with several common tags is reported by the cell of the first one
    only, so no pass over the result is needed to remove repeats.
    """
    narrow = cut_lineage(_with_vectors(papers.select("pmid", "category", "mesh_terms"), embeddings)
                         .select("id", "category", "vec", "terms"), "topic-rows")
    rows = narrow.select("id", "category", "vec", "terms", F.explode("terms").alias("term"))
    cells = to_cells(rows, ["category", "term"], "id", block_rows)
    return cells.select("cell", "lone", "side", "id", "term", "terms", "vec").mapInArrow(
        kernels.near_pairs(min_similarity),
        "pmid1 string, pmid2 string, similarity double, shared_terms array<string>")


def contradiction_pairs(papers: DataFrame, embeddings: DataFrame, min_similarity: float = 0.5,
                        positive=tuple(vocab.POSITIVE_WORDS), negative=tuple(vocab.NEGATIVE_WORDS),
                        min_score: float = 0.3, top: int = 20, block_rows: int = BLOCK_ROWS,
                        probe_rows: int = PROBE_ROWS) -> DataFrame:
    """The ``top`` opposing pairs by (score desc, pmid1, pmid2).

    Scores are 1.0 (both papers carry words of both kinds) or 0.5, and ties go
    by id, so the list is filled from the lowest ids of the higher score on
    (:func:`_first_pairs`) and ends as soon as nothing can enter it. With
    ``probe_rows=0`` all candidates are compared, in cells per (category, tag).
    Both ways are exact.
    """
    pos, neg = T.polarity_flags(T.text_of(), list(positive), list(negative))
    flagged = papers.select("pmid", "category", "mesh_terms", "evidence_level",
                            T.prefix(F.col("title"), 80).alias("title"), pos.alias("pos"), neg.alias("neg"))
    # The texts are read once; every later step reads this narrow table. Filtering by the flags
    # comes after, else the word tests would run in the filter and again in the projection.
    rows = cut_lineage(_with_vectors(flagged, embeddings), "pair-candidates").filter("pos or neg")
    narrow = rows.select("id", "category", "vec", "terms", "pos", "neg")
    if probe_rows:
        best, missing = papers.sparkSession.createDataFrame([], _FOUND), top
        for tier, held in ((1.0, narrow.filter("pos and neg")), (0.5, narrow)):
            if tier > min_score and missing > 0:
                found = _first_pairs(held, tier, missing, min_similarity, block_rows, probe_rows)
                best, missing = best.unionByName(found), missing - found.count()
    else:
        best = _first(_in_cells(narrow, min_similarity, min_score, top, None, block_rows), top)
    return _describe(cut_lineage(best, "best-pairs"), rows).orderBy(*_order())


_FOUND = "pmid1 string, pmid2 string, similarity double, contradiction_score double"


def _order():
    return [F.desc("contradiction_score"), F.col("pmid1"), F.col("pmid2")]


def _first(found: DataFrame, top: int) -> DataFrame:
    return found.dropDuplicates(["pmid1", "pmid2"]).orderBy(*_order()).limit(top)


def _in_cells(rows: DataFrame, min_similarity: float, min_score: float, top: int, tier: float | None, block_rows: int) -> DataFrame:
    cells = to_cells(rows.withColumn("term", F.explode("terms")), ["category", "term"], "id", block_rows)
    return (cells.select("cell", "lone", "side", "id", "category", "terms", "vec", "pos", "neg")
            .mapInArrow(kernels.opposing_in_cells(min_similarity, min_score, top, tier), _FOUND))


def _first_pairs(rows: DataFrame, tier: float, top: int, min_similarity: float, block_rows: int, probe_rows: int) -> DataFrame:
    """The ``top`` pairs with score ``tier`` by (pmid1, pmid2), from rising ranges of pmid1.

    A range of the lowest ids not yet seen is compared with all rows from its
    first id on, in one scan without a shuffle. That finds every pair whose
    lower id is in the range, so once ``top`` pairs are found, a later range
    has none that sorts before them. Ranges double from ``probe_rows`` to
    ``probe_rows * 2^(RANGES - 1)`` ids, which bounds what travels to the
    tasks. If they do not fill the list, the rows above the last range are
    compared in cells per (category, tag).
    """
    found, last = None, None
    for step in range(RANGES):
        size = probe_rows << step
        ahead = rows if last is None else rows.filter(F.col("id") > F.lit(last))
        # the ids are found first, so that the tasks send no vectors to the one that merges them
        lowest = ahead.select("id").orderBy("id").limit(size)
        chunk = ahead.join(F.broadcast(lowest), "id", "left_semi").toArrow()
        if not chunk.num_rows:
            break
        scan = ahead.mapInArrow(kernels.opposing_to_chunk(chunk, min_similarity, 0.0, top, tier), _FOUND)
        found = cut_lineage(_first(scan if found is None else scan.unionByName(found), top), "lead")
        if found.count() == top or chunk.num_rows < size:
            return found
        last = max(chunk.column("id").to_pylist())
    if found is None:
        return rows.sparkSession.createDataFrame([], _FOUND)
    rest = _in_cells(rows.filter(F.col("id") > F.lit(last)), min_similarity, 0.0, top, tier, block_rows)
    return cut_lineage(_first(rest.unionByName(found), top), "lead")


def _describe(best: DataFrame, rows: DataFrame) -> DataFrame:
    """Titles, tags and evidence levels of the two papers of a short list of pairs."""
    ids = best.select(F.explode(F.array("pmid1", "pmid2")).alias("id")).distinct()
    info = rows.select("id", "title", "category", "terms", "evidence_level").join(small_side(ids), "id", "left_semi")

    def side(n: int) -> DataFrame:
        return info.select(F.col("id").alias(f"pmid{n}"), F.col("title").alias(f"title{n}"),
                           F.col("terms").alias(f"_terms{n}"), F.col("evidence_level").alias(f"_level{n}"),
                           *(["category"] if n == 1 else []))

    return (best.join(side(1), "pmid1").join(side(2), "pmid2")
            .select("pmid1", "pmid2", "title1", "title2", "category",
                    F.array_sort(F.array_intersect("_terms1", "_terms2")).alias("shared_terms"),
                    "similarity", "contradiction_score",
                    F.array("_level1", "_level2").alias("evidence_levels")))
