"""The weekly run: a drop of fetched papers to the best candidates and the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.functions import text as T
from paperlake.operators.rules import first_rule_match, score_topn
from paperlake.operators.upsert import upsert_papers


def prepare_fetched(fetched: DataFrame, now) -> DataFrame:
    """Category, evidence level and times for records coming from ``parse_paper_xml``."""
    stamp = F.lit(now).cast("timestamp")
    return (fetched.withColumn("category", first_rule_match(F.col("mesh_terms")))
            .withColumn("evidence_level", T.classify_evidence(T.text_of()))
            .withColumn("created_at", stamp).withColumn("updated_at", stamp))


def weekly_candidates(fetched: DataFrame, as_of, top_n: int = 3, **vocabulary) -> DataFrame:
    """Best papers of the drop with the slug of their article."""
    best = score_topn(fetched.withColumn("pub_date", F.col("raw_pub_date")), as_of, top_n, **vocabulary)
    return best.select("pmid", "title", "score", T.slug(F.col("title")).alias("slug"))


def store_fetched(papers: DataFrame, fetched: DataFrame, now) -> DataFrame:
    return upsert_papers(papers, prepare_fetched(fetched, now).select(*papers.columns), now)
