"""The given tables seen as paper tables: whole tables, whole texts.

Every view exists twice, as a DataFrame and as a DuckDB CTE; the registry
compares the two. Parameters replace the library's medical defaults, whose
words do not occur in this data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-12-31"
NOW = "2025-01-01 00:00:00"
FIRST_DAY = "2024-01-01"
POSITIVE = ["the", "les"]
NEGATIVE = ["with", "und", "para"]
HIGH = ["from", "der", "que"]
MEDIUM = ["this", "les"]
FOCUS = "license"
TAG_RULES = [("the", "heart"), ("und", "brain"), ("les", "gut"), ("que", "eyes")]
PRODUCTS = [("the", "first"), ("for", "second"), ("und", "third"), ("que", "fourth"), ("ing", "fifth")]
# words that between one and ten in a hundred of the given documents hold
TAGS = ("ining ingor ound queque nque sthe thedre under theron queci aique quer athe thshing therble ingnt leque ouque einge "
        "theaeati thther queeau esing oring").split()
MIN_SIMILARITY = 0.1
PAIR_SIMILARITY = 0.3

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _title(text):
    return F.split_part(text, F.lit("\n"), F.lit(1))


def _terms(text):
    """Tags: the words of a fixed vocabulary that the whole text holds, in the order of the vocabulary."""
    return F.array_intersect(F.array(*map(F.lit, TAGS)), F.split(F.lower(text), "[^a-z]+"))


def papers(spark: SparkSession, sf: str, level: bool = False) -> DataFrame:
    """Papers; the evidence level, which takes a join with the labels, only where ``level`` asks for it."""
    docs = table(spark, sf, "documents")
    if level:
        docs = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    first = F.lit(FIRST_DAY).cast("date")
    level = (F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "meta-analysis")
             .when(F.col("quality") == 1, "guideline").when(F.col("quality") == 0, "RCT")
             if level else F.lit(None).cast("string"))
    stamp = F.lit("2024-06-30 00:00:00").cast("timestamp")
    return docs.select(
        F.col("doc_id").cast("string").alias("pmid"), _title(F.col("text")).alias("title"),
        F.col("text").alias("abstract"), F.array("source").alias("authors"), F.col("source").alias("journal"),
        F.date_add(first, (F.col("doc_id") % 365).cast("int")).alias("pub_date"),
        F.concat(F.lit("10.1/"), F.col("doc_id")).alias("doi"),
        F.concat(F.lit("/article/"), F.col("doc_id"), F.lit("/")).alias("url"),
        _terms(F.col("text")).alias("mesh_terms"), F.col("lang").alias("category"),
        level.alias("evidence_level"), stamp.alias("created_at"), stamp.alias("updated_at"))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("pmid"), "embedding", F.lit("given").alias("model"),
        F.lit("2024-06-30 00:00:00").cast("timestamp").alias("created_at"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """A generation log: one row for every labelled document marked toxic."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 365).cast("int"))
    return table(spark, sf, "labels").filter("toxic = 1").select(
        F.col("doc_id").alias("id"), week(day).alias("week"), F.lit("theme").alias("theme"),
        F.array(F.col("doc_id").cast("string"), (F.col("doc_id") + 1).cast("string")).alias("source_pmids"),
        F.concat(F.lit("col-"), F.col("doc_id")).alias("article_slug"),
        day.cast("timestamp").alias("created_at"))


def week(day):
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def log_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows to append: documents labelled as low quality."""
    return table(spark, sf, "labels").filter("quality = 0").select(
        F.col("doc_id").alias("arrived"), F.lit("2025-W01").alias("week"), F.lit("new").alias("theme"),
        F.array(F.col("doc_id").cast("string")).alias("source_pmids"),
        F.concat(F.lit("new-"), F.col("doc_id")).alias("article_slug"),
        F.when(F.col("toxic") == 1, F.lit("2024-12-30 00:00:00").cast("timestamp")).alias("created_at"))


def incoming_papers(spark: SparkSession, sf: str) -> DataFrame:
    """An upsert batch: changed titles for one evidence level, and benchmark items as new papers."""
    base = papers(spark, sf, level=True)
    stamp = F.lit("2024-12-01 00:00:00").cast("timestamp")
    changed = (base.filter("evidence_level = 'meta-analysis'")
               .withColumn("title", F.concat(F.lit("Updated "), "title"))
               .withColumn("created_at", stamp).withColumn("updated_at", stamp))
    fresh = table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id")).alias("pmid"), _title(F.col("text")).alias("title"),
        F.col("text").alias("abstract"), F.array(F.lit("bench")).alias("authors"),
        F.lit("bench").alias("journal"), F.lit(AS_OF).cast("date").alias("pub_date"), F.lit("").alias("doi"),
        F.lit("").alias("url"), _terms(F.col("text")).alias("mesh_terms"), F.lit("en").alias("category"),
        F.lit(None).cast("string").alias("evidence_level"), stamp.alias("created_at"),
        stamp.alias("updated_at"))
    older = fresh.withColumn("title", F.lit("older copy")).withColumn(
        "updated_at", F.lit("2024-11-01 00:00:00").cast("timestamp"))
    return changed.unionByName(fresh).unionByName(older)


def incoming_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Reversed vectors for label 0, label 1 under new ids."""
    rows = table(spark, sf, "embeddings")
    stamp = F.lit("2024-12-01 00:00:00").cast("timestamp")
    changed = rows.filter("label = 0").select(
        F.col("vec_id").cast("string").alias("pmid"), F.reverse("embedding").alias("embedding"))
    fresh = rows.filter("label = 1").select(
        F.concat(F.lit("n"), F.col("vec_id")).alias("pmid"), "embedding")
    return changed.unionByName(fresh).withColumn("model", F.lit("second")).withColumn("created_at", stamp)


def page_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One nested source list per page, in one of the three shapes."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.regexp_extract("html", r'<html lang="(\w+)"', 1).alias("lang"),
        F.regexp_extract("url", "https?://([^/]+)", 1).alias("host"))
    scalars = F.to_json(F.create_map("lang", F.array("host")))
    objects = F.to_json(F.create_map("lang", F.array(F.struct(F.col("host").alias("name"), "url"))))
    nested = F.to_json(F.create_map("lang", F.create_map("host", "url")))
    return pages.withColumn("doc", F.when(F.contains("url", F.lit("?")), objects)
                            .when(F.contains("url", F.lit("#")), scalars).otherwise(nested))


CTE = f"""WITH papers AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS pmid, split_part(d.text, chr(10), 1) AS title, d.text AS abstract,
    [d.source] AS authors, d.source AS journal,
    CAST(DATE '{FIRST_DAY}' + CAST(d.doc_id % 365 AS INT) AS DATE) AS pub_date,
    '10.1/' || d.doc_id AS doi, '/article/' || d.doc_id || '/' AS url,
    list_filter({TAGS}, lambda w: list_contains(regexp_split_to_array(lower(d.text), '[^a-z]+'), w)) AS mesh_terms,
    d.lang AS category,
    CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'meta-analysis' WHEN l.quality = 1 THEN 'guideline'
         WHEN l.quality = 0 THEN 'RCT' END AS evidence_level,
    TIMESTAMP '2024-06-30 00:00:00' AS created_at, TIMESTAMP '2024-06-30 00:00:00' AS updated_at
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
emb AS (
  SELECT CAST(vec_id AS VARCHAR) AS pmid, CAST(embedding AS DOUBLE[]) AS embedding, 'given' AS model,
    TIMESTAMP '2024-06-30 00:00:00' AS created_at, label FROM embeddings),
gen_log AS (
  SELECT doc_id AS id, strftime(day, '%G-W%V') AS week, 'theme' AS theme,
    [CAST(doc_id AS VARCHAR), CAST(doc_id + 1 AS VARCHAR)] AS source_pmids, 'col-' || doc_id AS article_slug,
    CAST(day AS TIMESTAMP) AS created_at
  FROM (SELECT doc_id, CAST(DATE '{FIRST_DAY}' + CAST(doc_id % 365 AS INT) AS DATE) AS day
        FROM labels WHERE toxic = 1)),
incoming AS (
  SELECT pmid, 'Updated ' || title AS title, category, TIMESTAMP '2024-12-01 00:00:00' AS updated_at
  FROM papers WHERE evidence_level = 'meta-analysis'
  UNION ALL SELECT 'b' || item_id, split_part(text, chr(10), 1), 'en', TIMESTAMP '2024-12-01 00:00:00' FROM benchmark
  UNION ALL SELECT 'b' || item_id, 'older copy', 'en', TIMESTAMP '2024-11-01 00:00:00' FROM benchmark),
sources AS (
  SELECT page_id, url AS page_url, regexp_extract(html, '<html lang="(\\w+)"', 1) AS category,
    regexp_extract(url, 'https?://([^/]+)', 1) AS name,
    CASE WHEN contains(url, '?') THEN url WHEN contains(url, '#') THEN '' ELSE url END AS url FROM pages)
"""
