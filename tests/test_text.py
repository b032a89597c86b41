import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperlake.functions import text as T

AS_OF = dt.date(2026, 7, 31)


def one(spark, expr, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("txt, points, label", [
    ("a meta-analysis of a randomized controlled trial", 20, "meta-analysis"),
    ("systematic review", 20, "meta-analysis"),
    ("randomized and controlled guideline", 15, "RCT"),
    ("randomized only, clinical trial", 10, "trial"),
    ("new guideline for review", 15, "guideline"),
    ("a review", 5, "review"),
    ("nothing", 0, None),
])
def test_evidence(spark, txt, points, label):
    assert one(spark, T.evidence_bonus(F.col("t")), t=txt) == points
    assert one(spark, T.classify_evidence(F.col("t")), t=txt) == label


@pytest.mark.parametrize("raw, bonus", [
    ("2026-07-31", 30), ("2026-07-21", 20), ("2026-07-01", 0), ("2020-01-01", 0), ("2026-08-10", 40),
    ("2026-Jul-15", 0), ("2026-00-00", 0), ("", 0), ("2026-07-21T10:00", 20),
])
def test_recency(spark, raw, bonus):
    assert one(spark, T.recency_bonus(F.col("d"), AS_OF), d=raw) == bonus


def test_recency_of_missing_date(spark):
    assert spark.range(1).select(T.recency_bonus(F.lit(None), AS_OF).alias("x")).first()["x"] == 0


def test_relevance_counts_each_keyword_once(spark):
    score = T.relevance_score(T.text_of(F.col("t"), F.col("a")), F.col("d"), AS_OF)
    # hypertension 10, aging inside imaging 10, diet 5, japanese 10, review 5, 30 days
    got = one(spark, score, t="Hypertension hypertension imaging", a="Japanese diet review", d="2026-07-31")
    assert got == 10 + 10 + 5 + 10 + 5 + 30


def test_whole_words(spark):
    text = T.text_of(F.col("t"), F.lit(None).cast("string"))
    assert one(spark, T.keyword_points(text, ["aging"], [], words_only=True), t="imaging") == 0
    assert one(spark, T.keyword_points(text, ["aging"], [], words_only=True), t="healthy aging.") == 10


@pytest.mark.parametrize("flags, score", [
    ((True, False, False, True), 0.5), ((True, True, True, True), 1.0), ((True, False, True, False), 0.0),
    ((False, True, True, False), 0.5), ((False, False, True, True), 0.0),
])
def test_polarity(spark, flags, score):
    expr = T.polarity_score(*(F.lit(f) for f in flags))
    assert one(spark, expr, unused=1) == score


@pytest.mark.parametrize("txt, day", [
    ("2026-07-15 news", dt.date(2026, 7, 15)), ("2026年7月5日の記事", dt.date(2026, 7, 5)),
    ("2026年07月15日", dt.date(2026, 7, 15)), ("2026/07/15", dt.date(2026, 7, 15)),
    ("heart・2026-07-15", AS_OF), ("2026-13-45", AS_OF), ("", AS_OF),
])
def test_page_date(spark, txt, day):
    assert one(spark, T.page_date(F.col("t"), AS_OF), t=txt) == day


@pytest.mark.parametrize("url, ref", [
    ("https://doi.org/10.1001/jama.1", "10.1001/jama.1"),
    ("https://pubmed.ncbi.nlm.nih.gov/123/", "PMID:123"), ("https://pubmed.ncbi.nlm.nih.gov/123", "PMID:123"),
    ("https://example.org/x", ""), ("", ""),
])
def test_source_ref(spark, url, ref):
    assert one(spark, T.source_ref(F.col("u")), u=url) == ref


def test_slug(spark):
    assert one(spark, T.slug(F.col("t")), t="  Sleep & Aging: a Review!  ") == "sleep-aging-a-review"
    assert len(one(spark, T.slug(F.col("t")), t="word " * 40)) <= 60


def test_embedding_text(spark):
    expr = T.embedding_text(F.col("t"), F.col("a"), F.array(F.lit("x"), F.lit("y")), F.col("c"))
    assert one(spark, expr, t="T", a="A", c="heart") == "Title: T\n\nAbstract: A\n\nKeywords: x, y\n\nCategory: heart"
    bare = T.embedding_text(F.col("t"), F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit(""))
    assert one(spark, bare, t="T") == "Title: T"


def test_template_is_filled_in_order(spark):
    c = {k: F.lit(k.upper()) for k in ("title", "abstract", "journal", "date", "doi", "url", "episode")}
    template = "{paper_title}/{paper_abstract}/{paper_abstract[:3000]}/{paper_tags}/{episode}"
    got = one(spark, T.fill_template(template, tags=F.array(F.lit("a"), F.lit("b")), **c), unused=1)
    assert got == "TITLE/ABSTRACT/ABSTRACT/a, b/EPISODE"


def test_read_minutes(spark):
    assert one(spark, T.read_minutes(F.col("b")), b="x" * 499) == 1
    assert one(spark, T.read_minutes(F.col("b")), b="x" * 1500) == 3
