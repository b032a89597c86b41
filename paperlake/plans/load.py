"""Bulk load: pages to papers, embeddings and search index, with rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.operators.embed import embed_papers
from paperlake.operators.upsert import (latest_by_key, replace_index_rows, upsert_embeddings, upsert_papers)
from paperlake.runtime import cut_lineage
from paperlake.sources.feeds import flatten_sources
from paperlake.sources.pages import extract_pages


def load_sources(docs: DataFrame, column: str, doc_key: str, now) -> DataFrame:
    """New content of the sources table: all entries of the nested JSON documents, stamped."""
    return flatten_sources(docs, column, doc_key).withColumn("created_at", F.lit(now).cast("timestamp"))


@dataclass
class Loaded:
    papers: DataFrame
    embeddings: DataFrame
    search_index: DataFrame
    rejects: DataFrame


def load_articles(pages: DataFrame, papers: DataFrame, embeddings: DataFrame, search_index: DataFrame, now,
                  model: str = "hash-384", html: str = "html", **page_options) -> Loaded:
    """New content of the three tables after loading ``pages``; bad pages become rejects with a reason.

    The extracted records feed three tables, so they are written once to the
    shared folder instead of parsing the pages three times.
    """
    as_of = F.to_date(F.lit(now).cast("timestamp"))
    records = cut_lineage(extract_pages(pages, as_of, html=html, **page_options), "page-records")
    good = latest_by_key(records.filter(F.col("problem").isNull()), "slug", [F.desc("pub_date"), F.desc("title")])
    stamp = F.lit(now).cast("timestamp")
    new_papers = good.withColumn("created_at", stamp).withColumn("updated_at", stamp)
    return Loaded(
        papers=upsert_papers(papers, new_papers, now),
        embeddings=upsert_embeddings(embeddings, embed_papers(good, model, now)),
        search_index=replace_index_rows(search_index, good),
        rejects=records.filter(F.col("problem").isNotNull()).select("slug", "problem"),
    )
