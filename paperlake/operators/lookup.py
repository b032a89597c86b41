"""Filters, lookups and joins on the paper tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions import text as T
from paperlake.functions.jsontext import decode_list


# ---- filters ---------------------------------------------------------------

def paper_by_id(papers: DataFrame, pmid: str) -> DataFrame:
    return papers.filter(F.col("pmid") == F.lit(pmid))


def papers_by_category(papers: DataFrame, category: str, limit: int = 100) -> DataFrame:
    """Newest papers of one category."""
    return (papers.filter(F.col("category") == F.lit(category))
            .orderBy(F.desc_nulls_last("pub_date"), "pmid").limit(limit))


def recent_papers(papers: DataFrame, as_of, days: int = 7, limit: int = 100) -> DataFrame:
    """Newest papers of the last ``days`` days; later dates count as recent too."""
    return (papers.filter(F.col("pub_date") >= T.days_before(as_of, days))
            .orderBy(F.desc("pub_date"), "pmid").limit(limit))


def keyword_match(keyword: str, columns=("title", "abstract"), terms: str | None = "mesh_terms") -> Column:
    """Case-insensitive substring in any column or tag; NULL counts as no match."""
    needle = F.lit(keyword.lower())
    tests = [F.coalesce(F.contains(F.lower(c), needle), F.lit(False)) for c in columns]
    if terms:
        tests.append(F.coalesce(F.exists(terms, lambda t: F.contains(F.lower(t), needle)), F.lit(False)))
    return reduce(lambda a, b: a | b, tests)


def focus_papers(papers: DataFrame, term: str = vocab.FOCUS_TERM, category: str | None = None) -> DataFrame:
    """Papers mentioning ``term``; a category limits all of the tests."""
    found = papers.filter(keyword_match(term))
    return found if category is None else found.filter(F.col("category") == F.lit(category))


def category_filter(rows: DataFrame, chosen: str) -> DataFrame:
    """All rows for ``all``, else those of one category."""
    return rows if chosen == "all" else rows.filter(F.col("category") == F.lit(chosen))


def evidence_candidates(papers: DataFrame, used: DataFrame, as_of, days: int = 30,
                        levels=tuple(vocab.EVIDENCE_ORDER)) -> DataFrame:
    """Recent papers of a strict evidence level that no log row has used."""
    strict = papers.filter((F.col("pub_date") >= T.days_before(as_of, days))
                           & F.col("evidence_level").isin(*levels))
    return unused_papers(strict, used)


# ---- generation log --------------------------------------------------------

def distinct_used(log: DataFrame, as_of=None, weeks: int | None = None) -> DataFrame:
    """Ids of papers in log rows, optionally only rows of the last ``weeks`` weeks."""
    if weeks is not None:
        log = log.filter(F.col("created_at") >= T.days_before(as_of, 7 * weeks))
    return log.select(F.explode("source_pmids").alias("pmid")).distinct()


def is_processed(papers: DataFrame, log: DataFrame) -> DataFrame:
    """Every paper id with a flag telling whether any log row has used it."""
    used = distinct_used(log).withColumn("_used", F.lit(True))
    return (papers.select("pmid").join(used, "pmid", "left")
            .select("pmid", F.coalesce("_used", F.lit(False)).alias("processed")))


def log_by_week(log: DataFrame, week: str) -> DataFrame:
    """First log row of a week; JSON text in ``source_pmids`` is decoded."""
    row = log.filter(F.col("week") == F.lit(week)).orderBy("id").limit(1)
    if dict(log.dtypes)["source_pmids"] == "string":
        row = row.withColumn("source_pmids", decode_list(F.col("source_pmids")))
    return row


# ---- joins -----------------------------------------------------------------

def papers_with_embeddings(papers: DataFrame, embeddings: DataFrame) -> DataFrame:
    return papers.join(embeddings, "pmid")


def papers_in_set(papers: DataFrame, ids) -> DataFrame:
    """Papers whose id is in a list or in the ``pmid`` column of a table."""
    if isinstance(ids, DataFrame):
        return papers.join(ids.select("pmid"), "pmid", "left_semi")
    return papers.filter(F.col("pmid").isin(list(ids)))


def unused_papers(papers: DataFrame, used: DataFrame) -> DataFrame:
    return papers.join(used.select("pmid"), "pmid", "left_anti")


def shared_terms(a: Column, b: Column) -> Column:
    """Terms two lists have in common, sorted; empty when none."""
    return F.array_sort(F.array_intersect(a, b))


# ---- projections -----------------------------------------------------------

def theme_record(row: DataFrame, fallback_category: str = vocab.DEFAULT_LABEL[0],
                 fallback_level: str = "RCT", fallback_field: str = "関連分野") -> DataFrame:
    """Topic and reasoning text of the paper a theme rests on."""
    category = F.when(F.col("category") != "", F.col("category"))
    level = F.when(F.col("evidence_level") != "", F.col("evidence_level"))
    subject = F.coalesce(F.get("mesh_terms", F.lit(0)), T.prefix(F.col("title"), 30))
    topic = F.concat(F.coalesce(category, F.lit(fallback_category)), F.lit(": "), subject)
    # Wording of the reasoning sentence.
    reasoning = F.concat(F.lit("最新の"), F.coalesce(level, F.lit(fallback_level)), F.lit("研究「"),
                         T.prefix(F.col("title"), 50), F.lit("...」に基づき、"),
                         F.coalesce(category, F.lit(fallback_field)), F.lit("のエビデンスを解説"))
    return row.withColumn("topic", topic).withColumn("reasoning", reasoning)
