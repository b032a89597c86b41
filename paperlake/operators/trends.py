"""Monthly trends and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions import text as T
from paperlake.operators.lookup import keyword_match

DAYS_PER_MONTH = 30


def _since(papers: DataFrame, as_of, months: int) -> DataFrame:
    return papers.filter(F.col("pub_date") >= T.days_before(as_of, months * DAYS_PER_MONTH))


def keyword_trend(papers: DataFrame, keyword: str, as_of, months: int = 12) -> DataFrame:
    """Papers per month that mention ``keyword``, and their total."""
    monthly = (_since(papers, as_of, months).filter(keyword_match(keyword))
               .groupBy(T.month_key(F.col("pub_date")).alias("month"))
               .agg(F.count(F.lit(1)).alias("n")))
    # the window runs over the months, a handful of rows
    return (monthly.withColumn("total", F.sum("n").over(Window.partitionBy()))
            .withColumn("keyword", F.lit(keyword)).orderBy("month"))


def term_months(papers: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Mentions per lower-cased tag and month; repeats inside one paper count."""
    return (_since(papers, as_of, months)
            .select(F.explode(F.transform("mesh_terms", lambda t: F.lower(t))).alias("term"),
                    T.month_key(F.col("pub_date")).alias("month"))
            .groupBy("term", "month").agg(F.count(F.lit(1)).alias("n")))


def trending_topics(papers: DataFrame, as_of, months: int = 6, min_papers: int = 2, top: int = 20) -> DataFrame:
    """Tags by growth from their first to their last observed month."""
    per_term = (term_months(papers, as_of, months).groupBy("term")
                .agg(F.sum("n").alias("total_papers"), F.count(F.lit(1)).alias("_months"),
                     F.min_by("n", "month").alias("_first"), F.max_by("n", "month").alias("_last"),
                     F.map_from_entries(F.sort_array(F.collect_list(F.struct("month", "n"))))
                     .alias("monthly_counts")))
    return (per_term.filter((F.col("total_papers") >= min_papers) & (F.col("_months") >= 2))
            .select(F.col("term").alias("keyword"), "total_papers",
                    ((F.col("_last") - F.col("_first")) / F.col("_first")).alias("growth_rate"),
                    "monthly_counts")
            .orderBy(F.desc("growth_rate"), "keyword").limit(top))


def category_trend(papers: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Papers per category and month; papers without a category are left out."""
    return (_since(papers, as_of, months).filter(F.col("category").isNotNull())
            .groupBy("category", T.month_key(F.col("pub_date")).alias("month"))
            .agg(F.count(F.lit(1)).alias("n")))


def category_trend_lists(papers: DataFrame, as_of, months: int = 6) -> DataFrame:
    """The same as one row per category with its months in order."""
    return (category_trend(papers, as_of, months).groupBy("category")
            .agg(F.sort_array(F.collect_list(F.struct("month", "n"))).alias("monthly_counts")))


def focus_ratio(papers: DataFrame, term: str = vocab.FOCUS_TERM, by_category: bool = False,
                category: str | None = None) -> DataFrame:
    """Share of papers mentioning ``term``, in one pass; 0.0 for no papers."""
    if category is not None:
        papers = papers.filter(F.col("category") == F.lit(category))
    grouped = papers.groupBy("category") if by_category else papers.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(keyword_match(term)).alias("matching"),
    ).withColumn("ratio", F.coalesce(F.try_divide(F.col("matching"), F.col("total")), F.lit(0.0)))


def focus_ratio_all(papers: DataFrame, term: str = vocab.FOCUS_TERM, total: str = "all") -> DataFrame:
    """:func:`focus_ratio` of every category and, named ``total``, of all papers, in one pass."""
    # texts are matched before the grouping; the totals are made from one row per category
    per = papers.select("category", keyword_match(term).alias("_hit")).groupBy("category").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_hit").alias("_m"))
    return (per.rollup("category").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum("_m"), F.lit(0)).alias("matching"),
                                       F.grouping("category").alias("_sum"))
            .withColumn("category", F.when(F.col("_sum") == 1, F.lit(total)).otherwise(F.col("category"))).drop("_sum")
            .withColumn("ratio", F.coalesce(F.try_divide(F.col("matching"), F.col("total")), F.lit(0.0))))


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
