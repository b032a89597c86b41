"""Choice of the next theme: evidence rank, fallback, primary and source papers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions import text as T
from paperlake.functions.vectors import cosine
from paperlake.operators.lookup import distinct_used, theme_record, unused_papers


def evidence_weight(levels=tuple(vocab.EVIDENCE_ORDER)):
    chain = F
    for place, level in enumerate(levels):
        chain = chain.when(F.col("evidence_level") == level, F.lit(len(levels) - place))
    return chain.otherwise(F.lit(0))


def _open(papers: DataFrame, embeddings: DataFrame, used: DataFrame, as_of, days: int) -> DataFrame:
    """Recent unused papers that have an embedding row.

    An inner join on the unique id, so Spark may broadcast the few recent
    papers instead of shuffling every embedding id.
    """
    recent = papers.filter(F.col("pub_date") >= T.days_before(as_of, days))
    return unused_papers(recent, used).join(embeddings.select("pmid"), "pmid")


def evidence_rank(papers: DataFrame, embeddings: DataFrame, used: DataFrame, as_of, days: int = 30,
                  limit: int = 20, levels=tuple(vocab.EVIDENCE_ORDER)) -> DataFrame:
    """Strict tier: strongest evidence first, then newest."""
    strict = _open(papers.filter(F.col("evidence_level").isin(*levels)), embeddings, used, as_of, days)
    return (strict.withColumn("weight", evidence_weight(levels))
            .orderBy(F.desc("weight"), F.desc("pub_date"), "pmid").limit(limit))


def fallback_recent(papers: DataFrame, embeddings: DataFrame, used: DataFrame, as_of, days: int = 30,
                    limit: int = 20, fallback_limit: int = 10) -> DataFrame:
    """The strict tier, or if it is empty the newest papers of any evidence; with ``tier`` and ``rank``."""
    strict = evidence_rank(papers, embeddings, used, as_of, days, limit).withColumn("tier", F.lit(0))
    newest = (_open(papers, embeddings, used, as_of, days).withColumn("weight", F.lit(0))
              .orderBy(F.desc("pub_date"), "pmid").limit(fallback_limit).withColumn("tier", F.lit(1)))
    # at most limit + fallback_limit rows from here on
    both = strict.unionByName(newest)
    order = Window.orderBy(F.desc("weight"), F.desc("pub_date"), "pmid")
    return (both.withColumn("_best", F.min("tier").over(Window.partitionBy()))
            .filter(F.col("tier") == F.col("_best")).drop("_best")
            .withColumn("rank", F.row_number().over(order)))


def pick_theme(papers: DataFrame, embeddings: DataFrame, log: DataFrame, as_of, exclude_recent_weeks: int = 4,
               days: int = 30, min_similarity: float = 0.6, more_sources: int = 5) -> DataFrame:
    """One row: topic, source ids (primary first), primary id, reasoning, category, evidence level.

    No row when nothing recent is left.
    """
    used = distinct_used(log, as_of, exclude_recent_weeks)
    narrow = papers.select("pmid", "title", "category", "mesh_terms", "evidence_level", "pub_date")
    short = fallback_recent(narrow, embeddings, used, as_of, days).filter(F.col("rank") <= 1 + more_sources)
    # the short list goes to the vectors, not the vectors to the short list
    with_vectors = embeddings.select("pmid", "embedding").join(F.broadcast(short), "pmid")
    entry = F.struct("rank", "pmid", "title", "category", "mesh_terms", "evidence_level", "embedding")
    one = (with_vectors.agg(F.sort_array(F.collect_list(entry)).alias("_all"))
           .filter(F.size("_all") > 0).withColumn("_first", F.get("_all", F.lit(0))))
    near = F.filter("_all", lambda x: (x["rank"] > 1)
                    & (cosine(F.col("_first.embedding"), x["embedding"]) > F.lit(min_similarity)))
    sources = F.concat(F.array("_first.pmid"), F.transform(near, lambda x: x["pmid"]))
    picked = one.select(sources.alias("source_pmids"), F.col("_first.pmid").alias("primary_pmid"),
                        "_first.title", "_first.category", "_first.mesh_terms", "_first.evidence_level")
    return theme_record(picked).select("topic", "source_pmids", "primary_pmid", "reasoning", "category",
                                       "evidence_level")
