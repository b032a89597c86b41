"""Every operator as a query on the given tables, with the same result in DuckDB SQL.

A key may have no SQL when the result depends on a random or iterative method.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as B
from checks.bindings import AS_OF, CTE, NOW
from paperlake import kernels, schemas
from paperlake.functions import jsontext, text, vectors
from paperlake.operators import cluster, embed, ivf, lookup, pairs, rules, similar, textindex, trends, upsert
from paperlake.plans import load, theme, weekly
from paperlake.runtime import work_dir
from paperlake.sources import buckets, feeds, frontindex, markup, pages, tables
from paperlake.streaming import intake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, cte: bool = True):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = (CTE if cte else "") + sql
        return function

    return register


def _join(column):
    return F.array_join(column, ",")


# ---- sources and sinks -----------------------------------------------------

@query("""SELECT pmid, title, abstract, journal, pub_date, array_to_string(mesh_terms, ',') AS terms, category,
  evidence_level FROM papers""")
def scan_papers(spark, sf):
    return B.papers(spark, sf, level=True).select("pmid", "title", "abstract", "journal", "pub_date",
                                      _join("mesh_terms").alias("terms"), "category", "evidence_level")


@query("""SELECT pmid, model, CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(embedding), 6) + 0.0 AS total FROM emb""")
def scan_embeddings(spark, sf):
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return B.embeddings(spark, sf).select("pmid", "model", F.size("embedding").alias("dim"),
                                          F.round(total, 6).alias("total"))


@query("SELECT id, week, theme, array_to_string(source_pmids, ',') AS pmids, article_slug FROM gen_log")
def scan_log(spark, sf):
    return B.log(spark, sf).select("id", "week", "theme", _join("source_pmids").alias("pmids"), "article_slug")


_UNESCAPE = "trim(" + "replace(" * 7 + "regexp_replace({x}, '<[^>]*>', '', 'g')" + (
    ", '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'))")


_PAGES_SQL = ("SELECT CAST(page_id AS VARCHAR) AS slug, "
       + _UNESCAPE.format(x="regexp_extract(html, '(?s)<article[^>]*>.*?<h1[^>]*>(.*?)</h1>', 1)") + f""" AS title,
  'health' AS category, DATE '{AS_OF}' AS pub_date, '' AS abstract, '' AS doi,
  'site/' || page_id || '/' AS url, '' AS tags, '' AS body FROM pages""")


def _page_records(extract, spark, sf):
    rows = B.table(spark, sf, "pages").withColumn("slug", F.col("page_id").cast("string"))
    return extract(rows, AS_OF, url_base="site/").select(
        "slug", "title", "category", "pub_date", "abstract", "doi", "url", _join("mesh_terms").alias("tags"),
        F.col("body_html").alias("body"))


@query(_PAGES_SQL, cte=False)
def extract_pages(spark, sf):
    return _page_records(pages.extract_pages, spark, sf)


@query(_PAGES_SQL, cte=False)
def parse_pages(spark, sf):
    return _page_records(pages.parse_pages, spark, sf)


@query("""SELECT page_id, coalesce(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
  array_to_string(regexp_extract_all(coalesce(html, ''), '<a href="([^"]*)">', 1), ' ') AS links,
  coalesce(regexp_replace(regexp_extract(html, '(?s)<article>.*?<p>(.*?)(?:<p>|</p>|</article>)', 1), '<[^>]*>', '', 'g'), '') AS first_text,
  coalesce(regexp_extract(html, '(?s)<div class="ad">.*?</div>'), '') AS ad FROM pages""", cte=False)
def page_elements(spark, sf):
    wanted = {"title": markup.Wanted("title"), "link": markup.Wanted("a", every=True),
              "text": markup.Wanted("p", within="article"), "ad": markup.Wanted("div", "ad", markup=True)}
    found = F.col("found")
    return B.table(spark, sf, "pages").select("page_id", markup.elements(F.col("html"), wanted).alias("found")).select(
        "page_id", F.coalesce(markup.first_of(found, "title")["text"], F.lit("")).alias("title"),
        F.array_join(F.transform(markup.all_of(found, "link"), lambda e: F.try_element_at(e["attributes"], F.lit("href"))), " ").alias("links"),
        F.coalesce(markup.first_of(found, "text")["text"], F.lit("")).alias("first_text"),
        F.coalesce(markup.first_of(found, "ad")["markup"], F.lit("")).alias("ad"))


@query("""SELECT row_number() OVER (ORDER BY md5(page_id || '|' || category || '|0')) AS id, category, name, url
  FROM sources""")
def flatten_sources(spark, sf):
    return feeds.flatten_sources(B.page_docs(spark, sf), "doc", "page_id")


@query("SELECT page_id, category, name, page_url AS url FROM sources WHERE category <> 'en'")
def reload_table(spark, sf):
    rows = B.page_docs(spark, sf).select("page_id", F.col("lang").alias("category"), F.col("host").alias("name"), "url")
    path = work_dir(spark, "sources")
    tables.reload_table(rows, path)
    return tables.reload_table(rows.filter("category <> 'en'"), path)


@query("""SELECT pmid AS slug, title, category, array_to_string(mesh_terms, ',') AS tags,
  strftime(pub_date, '%Y-%m-%d') AS "date", url, CAST(0 AS INTEGER) AS pos FROM papers""")
def read_search_index(spark, sf):
    article = F.struct(F.col("pmid").alias("slug"), "title", "category", F.col("pub_date").cast("string").alias("date"),
                       F.col("mesh_terms").alias("tags"), "url")
    doc = F.to_json(F.struct(F.lit("1.0").alias("version"), F.array(article).alias("articles")))
    return feeds.parse_search_index(B.papers(spark, sf).select(doc.alias("doc")), "doc").select(
        "slug", "title", "category", _join("tags").alias("tags"), "date", "url", "pos")


@query(r"""SELECT pmid, regexp_replace(title, '</?(?:i|b|u|em|strong|sup|sub|mml:[A-Za-z]+)(?:\s[^<>]*)?/?>', '', 'g') AS title,
  regexp_replace(abstract, '</?(?:i|b|u|em|strong|sup|sub|mml:[A-Za-z]+)(?:\s[^<>]*)?/?>', '', 'g') AS abstract, journal, strftime(pub_date, '%Y-%m-%d') AS raw_pub_date,
  pub_date, doi, 'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' AS url,
  array_to_string(mesh_terms, ',') AS terms FROM papers""")
def parse_paper_xml(spark, sf):
    papers = B.papers(spark, sf)
    rows = feeds.parse_xml_column(papers.select(_as_xml().alias("xml")), "xml")
    return feeds.parse_paper_xml(rows).select("pmid", "title", "abstract", "journal", "raw_pub_date", "pub_date", "doi",
                                              "url", _join("mesh_terms").alias("terms"))


def _as_xml():
    def esc(value):
        value = F.replace(value, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(value, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def tag(name, value, attrs=""):
        return F.concat(F.lit(f"<{name}{attrs}>"), value, F.lit(f"</{name}>"))

    day = F.concat(tag("Year", F.date_format("pub_date", "yyyy")), tag("Month", F.date_format("pub_date", "M")),
                   tag("Day", F.date_format("pub_date", "d")))
    heads = F.array_join(F.transform("mesh_terms", lambda t: F.concat(
        F.lit("<MeshHeading><DescriptorName>"), F.upper(t), F.lit("</DescriptorName></MeshHeading>"))), "")
    return tag("PubmedArticle", F.concat(
        tag("MedlineCitation", F.concat(
            tag("PMID", F.col("pmid"), ' Version="1"'),
            tag("Article", F.concat(
                tag("Journal", F.concat(tag("JournalIssue", tag("PubDate", day)), tag("Title", F.col("journal")))),
                tag("ArticleTitle", esc(F.col("title"))),
                tag("Abstract", tag("AbstractText", esc(F.col("abstract")))))),
            tag("MeshHeadingList", heads))),
        tag("PubmedData", tag("ArticleIdList", F.concat(
            tag("ArticleId", F.col("pmid"), ' IdType="pubmed"'), tag("ArticleId", F.col("doi"), ' IdType="doi"'))))))


_UPSERTED = f"""
new AS (SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY updated_at DESC) = 1),
merged AS (
  SELECT coalesce(n.pmid, p.pmid) AS pmid, CASE WHEN n.pmid IS NULL THEN p.title ELSE n.title END AS title,
    CASE WHEN n.pmid IS NULL THEN p.category ELSE n.category END AS category,
    coalesce(p.created_at, TIMESTAMP '2024-12-01 00:00:00') AS created_at,
    CASE WHEN n.pmid IS NULL THEN p.updated_at WHEN p.pmid IS NULL THEN n.updated_at
         ELSE TIMESTAMP '{NOW}' END AS updated_at
  FROM papers p FULL OUTER JOIN new n ON n.pmid = p.pmid)
"""


@query("," + _UPSERTED + """SELECT pmid, title, category, strftime(created_at, '%Y-%m-%d') AS created,
  strftime(updated_at, '%Y-%m-%d') AS updated FROM merged""")
def upsert_papers(spark, sf):
    return upsert.upsert_papers(B.papers(spark, sf, level=True), B.incoming_papers(spark, sf), NOW).select(
        "pmid", "title", "category", F.date_format("created_at", "yyyy-MM-dd").alias("created"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


@query("," + _UPSERTED + """SELECT pmid, title, category, strftime(created_at, '%Y-%m-%d') AS created,
  strftime(updated_at, '%Y-%m-%d') AS updated FROM merged""")
def upsert_buckets(spark, sf):
    """The same upsert on a table in buckets, of which only those of the batch are replaced."""
    table = buckets.BucketedTable(work_dir(spark, "papers"), schemas.PAPERS, buckets=64)
    buckets.create(B.papers(spark, sf, level=True), table)
    buckets.upsert_papers(table, B.incoming_papers(spark, sf), NOW)
    return table.read(spark).select("pmid", "title", "category", F.date_format("created_at", "yyyy-MM-dd").alias("created"),
                                    F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


_EMB_UPSERT = """,
new_emb AS (
  SELECT pmid, list_reverse(embedding) AS embedding, 'second' AS model FROM emb WHERE label = 0
  UNION ALL SELECT 'n' || pmid, embedding, 'second' FROM emb WHERE label = 1),
all_emb AS (SELECT pmid, embedding, model FROM emb WHERE pmid NOT IN (SELECT pmid FROM new_emb)
  UNION ALL SELECT * FROM new_emb)
"""


@query(_EMB_UPSERT + "SELECT pmid, model, round(embedding[1], 6) + 0.0 AS first FROM all_emb")
def upsert_embeddings(spark, sf):
    return upsert.upsert_embeddings(B.embeddings(spark, sf), B.incoming_embeddings(spark, sf)).select(
        "pmid", "model", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


@query("," + _UPSERTED + """SELECT (SELECT count(*) FROM incoming) AS processed, count(*) AS stored FROM merged""")
def ingest_papers(spark, sf):
    stored, processed = upsert.ingest_papers(B.papers(spark, sf, level=True), B.incoming_papers(spark, sf), NOW)
    return stored.agg(F.count(F.lit(1)).alias("stored")).select(processed.scalar().alias("processed"), "stored")


@query(""", entries AS (
  SELECT 'new-' || doc_id AS article_slug, CAST(doc_id AS VARCHAR) AS pmids, '2025-W01' AS week, doc_id,
    CASE WHEN toxic = 1 THEN '2024-12-30' ELSE '2025-01-01' END AS created
  FROM labels WHERE quality = 0)
SELECT id, week, array_to_string(source_pmids, ',') AS pmids, article_slug, strftime(created_at, '%Y-%m-%d') AS created FROM gen_log
UNION ALL SELECT (SELECT max(id) FROM gen_log) + row_number() OVER (ORDER BY doc_id),
  week, pmids, article_slug, created FROM entries""")
def append_log(spark, sf):
    return upsert.append_log(B.log(spark, sf), B.log_entries(spark, sf), NOW, arrival="arrived").select(
        "id", "week", _join("source_pmids").alias("pmids"), "article_slug",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"))


_INDEX_NEW = """SELECT pmid AS slug, title, substring(abstract, 1, 200) AS description, category,
  array_to_string(mesh_terms, ',') AS tags FROM papers"""


@query(f""", old AS ({_INDEX_NEW}), fresh AS (
  SELECT pmid AS slug, 'Updated ' || title AS title, substring(abstract, 1, 200) AS description, category,
    array_to_string(mesh_terms, ',') AS tags FROM papers WHERE evidence_level = 'meta-analysis'
  UNION ALL SELECT 'b' || item_id, split_part(text, chr(10), 1), substring(text, 1, 200), 'en',
    array_to_string(list_filter({B.TAGS}, lambda w: list_contains(regexp_split_to_array(lower(text), '[^a-z]+'), w)), ',') FROM benchmark)
SELECT * FROM old WHERE slug NOT IN (SELECT slug FROM fresh) UNION ALL SELECT * FROM fresh""")
def replace_index_rows(spark, sf):
    index = upsert.index_rows(B.papers(spark, sf, level=True))
    arriving = upsert.latest_by_key(B.incoming_papers(spark, sf), "pmid", [F.desc("updated_at")])
    return upsert.replace_index_rows(index, arriving).select(
        "slug", "title", "description", "category", _join("tags").alias("tags"))


_ENTRY_RULES = "CASE " + " ".join(f"WHEN contains(lower(t), '{k}') THEN '{c}'" for k, c in B.TAG_RULES) + " END"


@query(f"""SELECT pmid AS slug, title, substring(abstract, 1, 200) AS description,
  coalesce(list_filter(list_transform(mesh_terms, lambda t: {_ENTRY_RULES}), lambda c: c IS NOT NULL)[1], 'health') AS category,
  CASE WHEN category = 'es' THEN '' ELSE array_to_string(list_reverse(mesh_terms), ',') END AS tags,
  strftime(pub_date, '%Y-%m-%d') AS "date", '/article/' || pmid || '/' AS url FROM papers""")
def index_entries(spark, sf):
    made = F.struct("title", F.substring("abstract", 1, 200).alias("lead"),
                    F.when(F.col("category") != "es", F.reverse("mesh_terms")).alias("affiliate_keywords"))
    columns = B.papers(spark, sf).select(F.col("pmid").alias("slug"), "mesh_terms", "pub_date", made.alias("parsed"))
    return upsert.index_entries(columns, tag_rules=B.TAG_RULES).withColumn("tags", _join("tags"))


@query(""", arrivals AS (SELECT pmid AS slug, 'Updated ' || title AS title, CAST(pmid AS BIGINT) AS pos FROM papers
    WHERE evidence_level = 'meta-analysis'
  UNION ALL SELECT 'b' || item_id, split_part(text, chr(10), 1), -1 - item_id FROM benchmark),
both_parts AS (SELECT 0 AS part, -pos AS place, slug, title FROM arrivals
  UNION ALL SELECT 1, CAST(pmid AS BIGINT), pmid, title FROM papers WHERE pmid NOT IN (SELECT slug FROM arrivals))
SELECT row_number() OVER (ORDER BY part, place) AS pos, slug, title FROM both_parts""")
def upsert_index_front(spark, sf):
    index = B.papers(spark, sf).select(F.col("pmid").alias("slug"), "title", F.col("pmid").cast("long").alias("pos"))
    changed = (B.papers(spark, sf, level=True).filter("evidence_level = 'meta-analysis'")
               .select(F.col("pmid").alias("slug"), F.concat(F.lit("Updated "), "title").alias("title"),
                       F.col("pmid").cast("long").alias("pos")))
    fresh = B.table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id")).alias("slug"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), (F.lit(-1) - F.col("item_id")).alias("pos"))
    return upsert.upsert_index_front(index, changed.unionByName(fresh)).select("pos", "slug", "title")


@query(""", entries AS (SELECT 0 AS batch, CAST(pmid AS BIGINT) AS place, pmid AS slug, title FROM papers
  UNION ALL SELECT 1, -CAST(pmid AS BIGINT), pmid, 'Updated ' || title FROM papers WHERE evidence_level = 'meta-analysis'
  UNION ALL SELECT 2, -CAST(pmid AS BIGINT), pmid, 'Moved ' || title FROM papers WHERE category = 'es'
  UNION ALL SELECT 2, 1 + item_id, 'b' || item_id, split_part(text, chr(10), 1) FROM benchmark),
live AS (SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY slug ORDER BY batch DESC) = 1)
SELECT row_number() OVER (ORDER BY batch DESC, place) AS pos, slug, title FROM live""")
def push_index_front(spark, sf):
    papers = B.papers(spark, sf, level=True)

    def entries(rows, word):
        return rows.select(F.col("pmid").alias("slug"), F.concat(F.lit(word), "title").alias("title"), F.col("pmid").cast("long").alias("pos"))

    fresh = B.table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id")).alias("slug"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), (F.lit(-1) - F.col("item_id")).alias("pos"))
    table = frontindex.FrontIndex(work_dir(spark, "front-index"), T.StructType([
        T.StructField("slug", T.StringType()), T.StructField("title", T.StringType())]))
    frontindex.create(entries(papers, ""), table)
    frontindex.push_front(table, entries(papers.filter("evidence_level = 'meta-analysis'"), "Updated "), 1)
    frontindex.push_front(table, entries(papers.filter("category = 'es'"), "Moved ").unionByName(fresh), 2)
    return frontindex.export(spark, table).select("pos", "slug", "title")


def _loaded(spark, sf) -> load.Loaded:
    html = B.table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id")).alias("slug"), "html")
    broken = B.table(spark, sf, "benchmark").select(F.concat(F.lit("b"), F.col("item_id")).alias("slug"),
                                                    F.lit(None).cast("string").alias("html"))
    papers = B.papers(spark, sf)
    return load.load_articles(html.unionByName(broken), papers, B.embeddings(spark, sf), upsert.index_rows(papers), NOW)


@query("""SELECT 'p' || page_id AS slug, 'stored' AS outcome, 'health' AS category FROM pages
  UNION ALL SELECT 'b' || item_id, 'no html', NULL FROM benchmark""", cte=False)
def load_articles(spark, sf):
    loaded = _loaded(spark, sf)
    new = loaded.search_index.filter(F.startswith("slug", F.lit("p"))).select("slug", F.lit("stored").alias("outcome"), "category")
    return new.unionByName(loaded.rejects.select("slug", F.col("problem").alias("outcome"),
                                                 F.lit(None).cast("string").alias("category")))


@query("""SELECT 'papers' AS table_name, (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS n
  UNION ALL SELECT 'embeddings', (SELECT count(*) FROM embeddings) + (SELECT count(*) FROM pages)
  UNION ALL SELECT 'search_index', (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages)
  UNION ALL SELECT 'sources', (SELECT count(*) FROM pages)
  UNION ALL SELECT 'rejects', (SELECT count(*) FROM benchmark)""", cte=False)
def table_counts(spark, sf):
    loaded = _loaded(spark, sf)
    return upsert.table_counts(papers=loaded.papers, embeddings=loaded.embeddings,
                               search_index=loaded.search_index, rejects=loaded.rejects,
                               sources=load.load_sources(B.page_docs(spark, sf), "doc", "page_id", NOW))


@query(""", p AS (SELECT pmid, title FROM papers UNION ALL SELECT pmid, NULL FROM papers WHERE evidence_level = 'RCT'),
e AS (SELECT pmid, model, embedding FROM emb UNION ALL SELECT 'x' || pmid, NULL, embedding[1:8] FROM emb WHERE label = 0)
SELECT 'papers.pmid unique' AS rule, count(*) AS bad_rows FROM (SELECT pmid FROM p GROUP BY pmid HAVING count(*) > 1)
UNION ALL SELECT 'embeddings.pmid unique', count(*) FROM (SELECT pmid FROM e GROUP BY pmid HAVING count(*) > 1)
UNION ALL SELECT 'log.id unique', count(*) FROM (SELECT id FROM gen_log GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'papers.pmid not null', count(*) FROM p WHERE pmid IS NULL
UNION ALL SELECT 'papers.title not null', count(*) FROM p WHERE title IS NULL
UNION ALL SELECT 'embeddings.model not null', count(*) FROM e WHERE model IS NULL
UNION ALL SELECT 'embeddings.embedding size', count(*) FROM e WHERE coalesce(len(embedding) <> 64, true)
UNION ALL SELECT 'log.week not null', count(*) FROM gen_log WHERE week IS NULL
UNION ALL SELECT 'embeddings.pmid in papers', count(*) FROM e WHERE pmid NOT IN (SELECT pmid FROM p)
UNION ALL SELECT 'sources.id unique', count(*) FROM (SELECT page_id FROM sources GROUP BY page_id HAVING count(*) > 1)
UNION ALL SELECT 'sources.category not null', 0 UNION ALL SELECT 'sources.name not null', 0
UNION ALL SELECT 'sources.url not null', count(*) FROM sources WHERE category = 'en'
UNION ALL SELECT 'search_index.slug unique', count(*) FROM (SELECT pmid FROM p GROUP BY pmid HAVING count(*) > 1)
UNION ALL SELECT 'search_index.title not null', count(*) FROM p WHERE title IS NULL""")
def check_constraints(spark, sf):
    papers, vecs = B.papers(spark, sf, level=True), B.embeddings(spark, sf)
    repeated = papers.filter("evidence_level = 'RCT'").withColumn("title", F.lit(None).cast("string"))
    odd = B.table(spark, sf, "embeddings").filter("label = 0").select(
        F.concat(F.lit("x"), F.col("vec_id")).alias("pmid"), F.slice("embedding", 1, 8).alias("embedding"),
        F.lit(None).cast("string").alias("model"), F.lit(None).cast("timestamp").alias("created_at"))
    sources = B.page_docs(spark, sf).select(F.col("page_id").alias("id"), F.col("lang").alias("category"), F.col("host").alias("name"),
                                            F.when(F.col("lang") != "en", F.col("url")).alias("url"))
    both = papers.unionByName(repeated)
    return upsert.check_constraints(both, vecs.unionByName(odd), B.log(spark, sf), 64, sources, upsert.index_rows(both))


# ---- filters and lookups ---------------------------------------------------

@query("SELECT pmid, title, category, pub_date FROM papers WHERE pmid = '7'")
def paper_by_id(spark, sf):
    return lookup.paper_by_id(B.papers(spark, sf), "7").select("pmid", "title", "category", "pub_date")


@query("""SELECT pmid, title, pub_date FROM papers WHERE category = 'fr' ORDER BY pub_date DESC, pmid LIMIT 100""")
def papers_by_category(spark, sf):
    return lookup.papers_by_category(B.papers(spark, sf), "fr").select("pmid", "title", "pub_date")


@query(f"""SELECT pmid, title, pub_date FROM papers WHERE pub_date >= DATE '{AS_OF}' - 7
  ORDER BY pub_date DESC, pmid LIMIT 100""")
def recent_papers(spark, sf):
    return lookup.recent_papers(B.papers(spark, sf), AS_OF).select("pmid", "title", "pub_date")


@query("""SELECT pmid, pmid IN (SELECT unnest(source_pmids) FROM gen_log) AS processed FROM papers""")
def is_processed(spark, sf):
    return lookup.is_processed(B.papers(spark, sf), B.log(spark, sf))


@query("""SELECT id, week, array_to_string(source_pmids, ',') AS pmids, article_slug FROM gen_log
  WHERE week = '2024-W10' ORDER BY id LIMIT 1""")
def log_by_week(spark, sf):
    stored = B.log(spark, sf).withColumn("source_pmids", jsontext.encode_list(F.col("source_pmids")))
    return lookup.log_by_week(stored, "2024-W10").select("id", "week", _join("source_pmids").alias("pmids"), "article_slug")


_MATCH = """(contains(lower(title), '{0}') OR contains(lower(abstract), '{0}')
  OR len(list_filter(mesh_terms, lambda t: contains(lower(t), '{0}'))) > 0)"""


@query("SELECT pmid, title FROM papers WHERE category = 'en' AND " + _MATCH.format(B.FOCUS))
def focus_papers(spark, sf):
    return lookup.focus_papers(B.papers(spark, sf), B.FOCUS, "en").select("pmid", "title")


@query(f"""SELECT pmid, evidence_level, pub_date FROM papers WHERE pub_date >= DATE '{AS_OF}' - 30
  AND evidence_level IN ('RCT', 'meta-analysis', 'guideline')
  AND pmid NOT IN (SELECT unnest(source_pmids) FROM gen_log)""")
def evidence_candidates(spark, sf):
    used = lookup.distinct_used(B.log(spark, sf))
    return lookup.evidence_candidates(B.papers(spark, sf, level=True), used, AS_OF).select("pmid", "evidence_level", "pub_date")


@query("SELECT pmid, " + _MATCH.format("with") + " AS matched FROM papers")
def keyword_match(spark, sf):
    return B.papers(spark, sf).select("pmid", lookup.keyword_match("With").alias("matched"))


@query("""SELECT 'all' AS chosen, pmid AS slug, category FROM papers
  UNION ALL SELECT 'de', pmid, category FROM papers WHERE category = 'de'""")
def category_filter(spark, sf):
    index = upsert.index_rows(B.papers(spark, sf)).select("slug", "category")
    parts = [lookup.category_filter(index, c).select(F.lit(c).alias("chosen"), "slug", "category") for c in ("all", "de")]
    return parts[0].unionByName(parts[1])


_THEME = """coalesce(nullif(category, ''), '健康') || ': ' || coalesce(mesh_terms[1], substring(title, 1, 30)) AS topic,
  '最新の' || coalesce(nullif(evidence_level, ''), 'RCT') || '研究「' || substring(title, 1, 50) || '...」に基づき、'
  || coalesce(nullif(category, ''), '関連分野') || 'のエビデンスを解説' AS reasoning"""


@query(f"SELECT pmid, {_THEME} FROM papers")
def theme_record(spark, sf):
    return lookup.theme_record(B.papers(spark, sf, level=True)).select("pmid", "topic", "reasoning")


# ---- joins -----------------------------------------------------------------

@query("SELECT p.pmid, p.category, CAST(len(e.embedding) AS INTEGER) AS dim FROM papers p JOIN emb e ON e.pmid = p.pmid")
def papers_with_embeddings(spark, sf):
    return lookup.papers_with_embeddings(B.papers(spark, sf), B.embeddings(spark, sf)).select(
        "pmid", "category", F.size("embedding").alias("dim"))


@query("SELECT pmid, title, category FROM papers WHERE pmid IN (SELECT pmid FROM emb WHERE label = 3)")
def papers_in_set(spark, sf):
    ids = B.table(spark, sf, "embeddings").filter("label = 3").select(F.col("vec_id").cast("string").alias("pmid"))
    return lookup.papers_in_set(B.papers(spark, sf), ids).select("pmid", "title", "category")


@query("SELECT pmid, category FROM papers WHERE pmid NOT IN (SELECT unnest(source_pmids) FROM gen_log)")
def unused_papers(spark, sf):
    return lookup.unused_papers(B.papers(spark, sf), lookup.distinct_used(B.log(spark, sf))).select("pmid", "category")


_COS = "list_cosine_similarity({a}, {b})"


@query(f""", x AS (SELECT p.pmid, p.category, list_distinct(p.mesh_terms) AS terms, e.embedding
  FROM papers p JOIN emb e ON e.pmid = p.pmid),
t AS (SELECT pmid, category, unnest(terms) AS term FROM x),
ids AS (SELECT a.pmid AS p1, b.pmid AS p2, string_agg(a.term, ',' ORDER BY a.term) AS shared FROM t a
  JOIN t b ON a.category = b.category AND a.term = b.term AND a.pmid < b.pmid GROUP BY ALL)
SELECT p1 AS pmid1, p2 AS pmid2, round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity, shared AS shared_terms
FROM ids JOIN x a ON a.pmid = p1 JOIN x b ON b.pmid = p2
WHERE {_COS.format(a="a.embedding", b="b.embedding")} >= {B.PAIR_SIMILARITY}""")
def topic_pairs(spark, sf):
    found = pairs.topic_pairs(B.papers(spark, sf), B.embeddings(spark, sf), B.PAIR_SIMILARITY)
    return found.select("pmid1", "pmid2", F.round("similarity", 6).alias("similarity"),
                        _join("shared_terms").alias("shared_terms"))


@query("""SELECT category, term, count(*) AS n_papers, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS n_pairs
  FROM (SELECT category, unnest(list_distinct(mesh_terms)) AS term FROM papers) GROUP BY ALL""")
def topic_sizes(spark, sf):
    return pairs.topic_sizes(B.papers(spark, sf))


_RELATED = f"""q AS (SELECT embedding FROM emb WHERE pmid = '0'),
near AS (SELECT pmid, {_COS.format(a="emb.embedding", b="q.embedding")} AS s FROM emb, q WHERE pmid <> '0'
  ORDER BY s DESC, pmid LIMIT 5)"""


@query(f""", {_RELATED}, short AS (SELECT * FROM near UNION ALL SELECT 'missing', -1.0)
SELECT short.pmid, coalesce(title, '') AS title, coalesce(category, '') AS category,
  coalesce(CAST(pub_date AS VARCHAR), '') AS pub_date, round(s, 6) AS similarity
FROM short LEFT JOIN papers ON papers.pmid = short.pmid""")
def recommendations_join(spark, sf):
    short = similar.related_papers(B.embeddings(spark, sf), "0")
    gone = spark.range(1).select(F.lit("missing").alias("pmid"), F.lit(-1.0).alias("similarity"))
    return similar.recommendations_join(short.unionByName(gone), B.papers(spark, sf)).withColumn(
        "similarity", F.round("similarity", 6))



_SEARCHED = ["license", "hant reth ouor", "éçeau"]


@query(" UNION ALL ".join(f"SELECT '{w}' AS keyword, pmid, title FROM papers WHERE {_MATCH.format(w)}" for w in _SEARCHED))
def keyword_search(spark, sf):
    """``keyword_match`` as a filter, by the stored index of three-character runs."""
    papers, root = B.papers(spark, sf), work_dir(spark, "textindex")
    textindex.build(papers, root, part_rows=2000)
    return reduce(DataFrame.unionByName, (textindex.search(spark, root, papers, w).select(F.lit(w).alias("keyword"), "pmid", "title")
                                          for w in _SEARCHED))


_RULES = "(VALUES " + ", ".join(f"('{k}', '{c}', {i})" for i, (k, c) in enumerate(B.TAG_RULES)) + ") r(key, cat, key_pos)"
_FIRST_RULE = f"""tags AS (SELECT pmid, unnest(mesh_terms) AS tag, generate_subscripts(mesh_terms, 1) AS tag_pos FROM papers),
hits AS (SELECT pmid, arg_min(cat, tag_pos * 1000 + key_pos) AS cat FROM tags JOIN {_RULES} ON contains(lower(tag), key) GROUP BY pmid),
ruled AS (SELECT papers.pmid, coalesce(hits.cat, 'health') AS rule_category FROM papers LEFT JOIN hits ON hits.pmid = papers.pmid)"""


@query(f", {_FIRST_RULE} SELECT * FROM ruled")
def first_rule_match(spark, sf):
    return B.papers(spark, sf).select("pmid", rules.first_rule_match(F.col("mesh_terms"), B.TAG_RULES).alias("rule_category"))


@query(f", {_FIRST_RULE} SELECT * FROM ruled")
def first_rule_match_many(spark, sf):
    """The same rules behind ten thousand others, which match no tag."""
    long = [(f"no tag {i}", "none") for i in range(10_000)] + B.TAG_RULES
    return B.papers(spark, sf).select("pmid", rules.first_rule_match_many(F.col("mesh_terms"), long).alias("rule_category"))


_PRODUCTS = "(VALUES " + ", ".join(f"('{k}', '{c}', {i})" for i, (k, c) in enumerate(B.PRODUCTS)) + ") r(key, product, key_pos)"


_MATCHED = (f""", tags AS (SELECT pmid, unnest(mesh_terms) AS tag, generate_subscripts(mesh_terms, 1) AS tag_pos FROM papers),
hits AS (SELECT pmid, key, product, key_pos, min(tag_pos) AS tag_pos FROM tags JOIN {_PRODUCTS}
  ON contains(lower(tag), key) GROUP BY ALL)
SELECT pmid, CAST(row_number() OVER (PARTITION BY pmid ORDER BY tag_pos, key_pos) AS INTEGER) AS rank,
  key AS product_key, product FROM hits""")


@query(_MATCHED)
def product_match(spark, sf):
    rows = B.papers(spark, sf).select("pmid", "mesh_terms")
    return rules.product_match(rows, "mesh_terms", B.PRODUCTS).drop("mesh_terms")


@query(_MATCHED)
def product_match_many(spark, sf):
    """The same products behind ten thousand others, which match no keyword."""
    long = [(f"no keyword {i}", "none") for i in range(10_000)] + B.PRODUCTS
    rows = B.papers(spark, sf).select("pmid", "mesh_terms")
    return rules.product_match_many(rows, "mesh_terms", long).drop("mesh_terms")



@query(f""", {_FIRST_RULE} SELECT pmid, rule_category,
  CASE rule_category WHEN 'heart' THEN '心臓・血管' WHEN 'brain' THEN '脳・認知' WHEN 'gut' THEN '腸内フローラ'
    WHEN 'eyes' THEN '目の健康' ELSE '健康' END AS name,
  CASE rule_category WHEN 'heart' THEN '❤️' WHEN 'brain' THEN '🧠' WHEN 'gut' THEN '🦠' WHEN 'eyes' THEN '👁️' ELSE '📝' END AS icon
  FROM ruled""")
def category_label(spark, sf):
    coded = B.papers(spark, sf).select("pmid", rules.first_rule_match(F.col("mesh_terms"), B.TAG_RULES).alias("rule_category"))
    name, icon = rules.category_label(F.col("rule_category"))
    return coded.select("pmid", "rule_category", name.alias("name"), icon.alias("icon"))


# ---- aggregations ----------------------------------------------------------

@query(f"""SELECT 'with' AS keyword, strftime(pub_date, '%Y-%m') AS month, count(*) AS n,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM papers
  WHERE pub_date >= DATE '{AS_OF}' - 360 AND {_MATCH.format("with")} GROUP BY month""")
def keyword_trend(spark, sf):
    return trends.keyword_trend(B.papers(spark, sf), "with", AS_OF)


@query(f""", m AS (SELECT lower(term) AS keyword, strftime(pub_date, '%Y-%m') AS month, count(*) AS n
  FROM (SELECT unnest(mesh_terms) AS term, pub_date FROM papers WHERE pub_date >= DATE '{AS_OF}' - 180) GROUP BY ALL),
g AS (SELECT keyword, CAST(sum(n) AS BIGINT) AS total_papers,
  (arg_max(n, month) - arg_min(n, month)) / arg_min(n, month) AS growth
  FROM m GROUP BY keyword HAVING sum(n) >= 2 AND count(*) >= 2 ORDER BY growth DESC, keyword LIMIT 20)
SELECT keyword, total_papers, round(growth, 6) AS growth_rate, month, n FROM g JOIN m USING (keyword)""")
def trending_topics(spark, sf):
    return trends.trending_topics(B.papers(spark, sf), AS_OF).select(
        "keyword", "total_papers", F.round("growth_rate", 6).alias("growth_rate"),
        F.explode("monthly_counts").alias("month", "n"))


@query(f"""SELECT category, strftime(pub_date, '%Y-%m') AS month, count(*) AS n FROM papers
  WHERE pub_date >= DATE '{AS_OF}' - 180 AND category IS NOT NULL GROUP BY ALL""")
def category_trend(spark, sf):
    return trends.category_trend(B.papers(spark, sf), AS_OF)


@query(f"""SELECT category, string_agg(month || '=' || n, ',' ORDER BY month) AS monthly FROM (
  SELECT category, strftime(pub_date, '%Y-%m') AS month, count(*) AS n FROM papers
  WHERE pub_date >= DATE '{AS_OF}' - 180 AND category IS NOT NULL GROUP BY ALL) GROUP BY category""")
def category_trend_lists(spark, sf):
    return trends.category_trend_lists(B.papers(spark, sf), AS_OF).select("category", F.array_join(F.transform(
        "monthly_counts", lambda m: F.concat(m["month"], F.lit("="), m["n"].cast("string"))), ",").alias("monthly"))


@query("""SELECT CAST(o_orderpriority AS VARCHAR) AS category, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n
  FROM orders WHERE o_orderdate >= DATE '2001-12-31' - 3600 GROUP BY ALL""", cte=False)
def category_trend_orders(spark, sf):
    """Monthly trend over a long range of dates: orders by priority."""
    rows = B.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("category"),
                                               F.col("o_orderdate").alias("pub_date"))
    return trends.category_trend(rows, "2001-12-31", 120)


_HIT = _MATCH.format(B.FOCUS)


@query(f"""SELECT coalesce(category, 'all') AS category, count(*) AS total, count(*) FILTER ({_HIT}) AS matching,
  round(count(*) FILTER ({_HIT}) / count(*), 6) AS ratio FROM papers GROUP BY GROUPING SETS ((category), ())""")
def focus_ratio(spark, sf):
    papers = B.papers(spark, sf)
    return trends.focus_ratio_all(papers, B.FOCUS).withColumn("ratio", F.round("ratio", 6))


@query(""", c AS (SELECT label AS cluster_id, pmid FROM emb),
r AS (SELECT c.*, title, category FROM c LEFT JOIN papers USING (pmid)),
cats AS (SELECT cluster_id, category, count(*) AS n FROM r WHERE category <> '' GROUP BY cluster_id, category
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, category) <= 3),
reps AS (SELECT cluster_id, pmid, title FROM r QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY pmid) <= 3)
SELECT cluster_id, count(*) AS size,
  (SELECT string_agg(category || '=' || n, ',' ORDER BY n DESC, category) FROM cats WHERE cats.cluster_id = r.cluster_id) AS top_categories,
  (SELECT string_agg(pmid, ',' ORDER BY pmid) FROM reps WHERE reps.cluster_id = r.cluster_id) AS representative_pmids,
  (SELECT string_agg(title, '|' ORDER BY pmid) FROM reps WHERE reps.cluster_id = r.cluster_id) AS titles
FROM r GROUP BY cluster_id""")
def cluster_summary(spark, sf):
    given = B.table(spark, sf, "embeddings").select(F.col("label").alias("cluster_id"),
                                                    F.col("vec_id").cast("string").alias("pmid"))
    return cluster.cluster_summary(given, B.papers(spark, sf)).select(
        "cluster_id", "size",
        F.array_join(F.transform("top_categories", lambda c: F.concat(c["category"], F.lit("="), c["n"].cast("string"))), ",")
        .alias("top_categories"),
        _join("representative_pmids").alias("representative_pmids"), F.array_join("titles", "|").alias("titles"))


@query(f"SELECT DISTINCT unnest(source_pmids) AS pmid FROM gen_log WHERE created_at >= DATE '{AS_OF}' - 28")
def distinct_used(spark, sf):
    return lookup.distinct_used(B.log(spark, sf), AS_OF, 4)


@query("SELECT category, count(*) AS n FROM papers GROUP BY category")
def category_counts(spark, sf):
    return trends.category_counts(upsert.index_rows(B.papers(spark, sf)))


# ---- ranking ---------------------------------------------------------------

_TEXT = "lower(title || ' ' || coalesce(abstract, ''))"
_POINTS = " + ".join([f"CAST(contains(txt, '{w}') AS INT) * 10" for w in B.HIGH]
                     + [f"CAST(contains(txt, '{w}') AS INT) * 5" for w in B.MEDIUM])
_BONUS = """CASE WHEN contains(txt, 'meta-analysis') OR contains(txt, 'systematic review') THEN 20
  WHEN contains(txt, 'randomized') AND contains(txt, 'controlled') THEN 15 WHEN contains(txt, 'guideline') THEN 15
  WHEN contains(txt, 'clinical trial') THEN 10 WHEN contains(txt, 'review') THEN 5 ELSE 0 END"""
_RECENT = f"greatest(0, 30 - CAST(DATE '{AS_OF}' - pub_date AS INT))"
_SCORE = f"({_POINTS} + {_BONUS} + {_RECENT} + CAST(contains(txt, '{B.FOCUS}') AS INT) * 10)"
_VOCABULARY = dict(high=B.HIGH, medium=B.MEDIUM, focus=B.FOCUS)


@query(f""", s AS (SELECT pmid, category, {_TEXT} AS txt, pub_date FROM papers),
scored AS (SELECT pmid, category, CAST({_SCORE} AS INTEGER) AS score FROM s)
SELECT 'overall' AS scope, pmid, category, score FROM (SELECT * FROM scored ORDER BY score DESC, pmid LIMIT 3)
UNION ALL SELECT 'category', pmid, category, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY score DESC, pmid) <= 3""")
def score_topn(spark, sf):
    papers = B.papers(spark, sf).select("pmid", "title", "abstract", "category", "pub_date")
    return rules.score_topn_with_groups(papers, AS_OF, 3, "category", **_VOCABULARY)


@query(f""", s AS (SELECT pmid, title, {_TEXT} AS txt, pub_date FROM papers)
SELECT pmid, title, CAST({_SCORE} AS INTEGER) AS score,
  trim(substring(regexp_replace(lower(title), '[^a-z0-9-]+', '-', 'g'), 1, 60), '-') AS slug
FROM s ORDER BY score DESC, pmid LIMIT 3""")
def weekly_candidates(spark, sf):
    fetched = B.papers(spark, sf).withColumn("raw_pub_date", F.col("pub_date").cast("string"))
    return weekly.weekly_candidates(fetched, AS_OF, 3, **_VOCABULARY)


_STORED = (rf"""SELECT pmid, CASE category WHEN 'en' THEN 'health' ELSE category END AS category,
  CASE category WHEN 'en' THEN regexp_replace(title, '</?(?:i|b|u|em|strong|sup|sub|mml:[A-Za-z]+)(?:\s[^<>]*)?/?>', '', 'g') ELSE title END AS title,
  CASE category WHEN 'en' THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at FROM papers""")


@query(_STORED)
def weekly_store(spark, sf):
    """The chain of a drop: article XML to records, category and evidence by rule, upsert."""
    papers = B.papers(spark, sf)
    rows = feeds.parse_xml_column(papers.filter("category = 'en'").select(_as_xml().alias("xml")), "xml")
    return weekly.store_fetched(papers, feeds.parse_paper_xml(rows), NOW).select("pmid", "category", "title", "updated_at")


@query(_STORED)
def run_intake(spark, sf):
    """The same chain from XML files that a stream takes in, into a table in buckets."""
    papers = B.papers(spark, sf)
    drop, checkpoint = work_dir(spark, "drop"), work_dir(spark, "intake")
    table = buckets.BucketedTable(work_dir(spark, "papers"), schemas.PAPERS, buckets=64)
    buckets.create(papers, table)
    rows = feeds.parse_xml_column(papers.filter("category = 'en'").select(_as_xml().alias("xml")), "xml").drop("xml", feeds.CORRUPT)
    rows.write.format("xml").option("rootTag", "PubmedArticleSet").option("rowTag", "PubmedArticle").save(drop)
    intake.run_intake(spark, drop, table, checkpoint, NOW).awaitTermination()
    return table.read(spark).select("pmid", "category", "title", "updated_at")


_OPEN = f"""used AS (SELECT DISTINCT unnest(source_pmids) AS pmid FROM gen_log WHERE created_at >= DATE '{AS_OF}' - 28),
open_papers AS (SELECT *, CASE evidence_level WHEN 'meta-analysis' THEN 3 WHEN 'guideline' THEN 2 WHEN 'RCT' THEN 1 ELSE 0 END AS weight
  FROM papers WHERE pub_date >= DATE '{AS_OF}' - {{days}} AND pmid NOT IN (SELECT pmid FROM used)
  AND pmid IN (SELECT pmid FROM emb)),
ranked AS (SELECT * FROM open_papers WHERE evidence_level IN ('RCT', 'meta-analysis', 'guideline')
  ORDER BY weight DESC, pub_date DESC, pmid LIMIT 20)"""


def _theme_inputs(spark, sf):
    return B.papers(spark, sf, level=True), B.embeddings(spark, sf), lookup.distinct_used(B.log(spark, sf), AS_OF, 4)


@query(f", {_OPEN.format(days=30)} SELECT pmid, evidence_level, pub_date, weight FROM ranked")
def evidence_rank(spark, sf):
    return theme.evidence_rank(*_theme_inputs(spark, sf), AS_OF).select("pmid", "evidence_level", "pub_date", "weight")


@query(f""", {_OPEN.format(days=30)} SELECT pmid, pub_date,
  CAST(row_number() OVER (ORDER BY pub_date DESC, pmid) AS INTEGER) AS rank
  FROM (SELECT * FROM open_papers ORDER BY pub_date DESC, pmid LIMIT 10)""")
def fallback_recent(spark, sf):
    papers, vecs, used = _theme_inputs(spark, sf)
    unrated = papers.withColumn("evidence_level", F.lit("article"))
    return theme.fallback_recent(unrated, vecs, used, AS_OF).select("pmid", "pub_date", "rank")


@query(f""", {_OPEN.format(days=30)},
numbered AS (SELECT r.*, e.embedding, row_number() OVER (ORDER BY weight DESC, pub_date DESC, r.pmid) AS rn
  FROM ranked r JOIN emb e ON e.pmid = r.pmid),
first AS (SELECT * FROM numbered WHERE rn = 1)
SELECT {_THEME}, pmid AS primary_pmid, category, evidence_level,
  (SELECT string_agg(n.pmid, ',' ORDER BY n.rn) FROM numbered n WHERE n.rn = 1 OR (n.rn <= 6
    AND {_COS.format(a="n.embedding", b="(SELECT embedding FROM first)")} > {B.MIN_SIMILARITY})) AS source_pmids
FROM first""")
def pick_theme(spark, sf):
    return theme.pick_theme(B.papers(spark, sf, level=True), B.embeddings(spark, sf), B.log(spark, sf), AS_OF,
                            min_similarity=B.MIN_SIMILARITY).withColumn("source_pmids", _join("source_pmids"))


@query("SELECT pmid, CAST(weekofyear(pub_date) AS INTEGER) AS episode FROM papers")
def iso_episode(spark, sf):
    return B.papers(spark, sf).select("pmid", text.iso_episode(F.col("pub_date")).alias("episode"))


# ---- sets ------------------------------------------------------------------

def _neighbours(spark, sf, *columns):
    """Every paper beside the one with the next id, columns suffixed 1 and 2."""
    papers = B.papers(spark, sf)
    left = papers.select(F.col("pmid").cast("long").alias("n"), F.col("pmid").alias("pmid1"),
                         *(F.col(c).alias(f"{c}1") for c in columns))
    right = papers.select((F.col("pmid").cast("long") - 1).alias("n"), F.col("pmid").alias("pmid2"),
                          *(F.col(c).alias(f"{c}2") for c in columns))
    return left.join(right, "n").drop("n")


@query("""SELECT a.pmid AS pmid1, b.pmid AS pmid2,
  array_to_string(list_sort(list_distinct(list_intersect(a.mesh_terms, b.mesh_terms))), ',') AS shared
  FROM papers a JOIN papers b ON CAST(b.pmid AS BIGINT) = CAST(a.pmid AS BIGINT) + 1""")
def shared_terms(spark, sf):
    return _neighbours(spark, sf, "mesh_terms").select(
        "pmid1", "pmid2", _join(lookup.shared_terms(F.col("mesh_terms1"), F.col("mesh_terms2"))).alias("shared"))


@query("SELECT DISTINCT unnest(source_pmids) AS pmid FROM gen_log")
def used_ids(spark, sf):
    return lookup.distinct_used(B.log(spark, sf))


@query("""SELECT pmid, category, 'old' AS origin FROM papers WHERE evidence_level IS NULL OR evidence_level <> 'RCT'
  UNION ALL SELECT pmid, category, 'new' FROM papers WHERE evidence_level = 'RCT'""")
def replace_by_key(spark, sf):
    papers = B.papers(spark, sf, level=True)
    new = papers.filter("evidence_level = 'RCT'").select("pmid", "category", F.lit("new").alias("origin"))
    return upsert.replace_by_key(papers.select("pmid", "category", F.lit("old").alias("origin")), new, "pmid")


# ---- scalar rules ----------------------------------------------------------

@query(f", s AS (SELECT pmid, {_TEXT} AS txt, pub_date FROM papers) SELECT pmid, CAST({_SCORE} AS INTEGER) AS score FROM s")
def relevance_score(spark, sf):
    return rules.with_score(B.papers(spark, sf), AS_OF, **_VOCABULARY).select("pmid", "score")


# the data has no evidence words: a phrase per label and language stands in for them
_PHRASED = """SELECT pmid, lower(title || ' ' || CASE WHEN evidence_level = 'meta-analysis' THEN
    CASE category WHEN 'en' THEN 'a Meta-Analysis' ELSE 'Systematic Review' END
  WHEN evidence_level = 'guideline' THEN 'Guideline' WHEN evidence_level = 'RCT' THEN 'randomized and controlled'
  WHEN category = 'de' THEN 'clinical trial' WHEN category = 'es' THEN 'review' ELSE '' END || ' ' || abstract) AS txt FROM papers"""


def _phrased(spark, sf):
    level, lang = F.col("evidence_level"), F.col("category")
    phrase = (F.when(level == "meta-analysis", F.when(lang == "en", "a Meta-Analysis").otherwise("Systematic Review"))
              .when(level == "guideline", "Guideline").when(level == "RCT", "randomized and controlled")
              .when(lang == "de", "clinical trial").when(lang == "es", "review").otherwise(""))
    return B.papers(spark, sf, level=True).select("pmid", text.text_of(F.concat("title", F.lit(" "), phrase)).alias("txt"))


@query(f", s AS ({_PHRASED}) SELECT pmid, CAST({_BONUS} AS INTEGER) AS bonus FROM s")
def evidence_bonus(spark, sf):
    return _phrased(spark, sf).select("pmid", text.evidence_bonus(F.col("txt")).alias("bonus"))


_LABEL = (_BONUS.replace("THEN 20", "THEN 'meta-analysis'").replace("'controlled') THEN 15", "'controlled') THEN 'RCT'")
          .replace("THEN 15", "THEN 'guideline'").replace("THEN 10", "THEN 'trial'").replace("THEN 5", "THEN 'review'")
          .replace("ELSE 0", "ELSE NULL"))


@query(f", s AS ({_PHRASED}) SELECT pmid, {_LABEL} AS label FROM s")
def classify_evidence(spark, sf):
    return _phrased(spark, sf).select("pmid", text.classify_evidence(F.col("txt")).alias("label"))


@query(f"""SELECT pmid, CASE WHEN category = 'es' THEN 0 ELSE {_RECENT} END AS bonus FROM papers""")
def recency_bonus(spark, sf):
    raw = F.when(F.col("category") == "es", F.date_format("pub_date", "yyyy-MMM-dd")).otherwise(F.col("pub_date").cast("string"))
    return B.papers(spark, sf).select("pmid", text.recency_bonus(raw, AS_OF).alias("bonus"))


def _flags(side: str) -> str:
    def any_of(words):
        return "(" + " OR ".join(f"contains(lower({side}.title || ' ' || {side}.abstract), '{w}')" for w in words) + ")"

    return f"{any_of(B.POSITIVE)} AS p_{side}, {any_of(B.NEGATIVE)} AS n_{side}"


@query(f""", f AS (SELECT a.pmid AS pmid1, b.pmid AS pmid2, {_flags('a')}, {_flags('b')}
  FROM papers a JOIN papers b ON CAST(b.pmid AS BIGINT) = CAST(a.pmid AS BIGINT) + 1)
SELECT pmid1, pmid2, greatest(0.0, CAST(0.5 * CAST(p_a AND n_b AS INT) + 0.5 * CAST(n_a AND p_b AS INT)
  - 0.2 * CAST(p_a AND p_b AND NOT n_a AND NOT n_b AS INT) AS DOUBLE)) AS score FROM f""")
def polarity_score(spark, sf):
    both = _neighbours(spark, sf, "title", "abstract")
    flags = [c for i in (1, 2) for c in text.polarity_flags(text.text_of(f"title{i}", f"abstract{i}"), B.POSITIVE, B.NEGATIVE)]
    names = ["p1", "n1", "p2", "n2"]
    rows = both.select("pmid1", "pmid2", *(c.alias(n) for c, n in zip(flags, names)))
    return rows.select("pmid1", "pmid2", text.polarity_score(*map(F.col, names)).alias("score"))


@query(r"SELECT pmid, trim(substring(regexp_replace(lower(title), '[^a-z0-9-]+', '-', 'g'), 1, 60), '-') AS slug FROM papers")
def slug(spark, sf):
    return B.papers(spark, sf).select("pmid", text.slug(F.col("title")).alias("slug"))


@query("SELECT pmid, CAST(greatest(1, length(abstract) // 500) AS INTEGER) AS minutes FROM papers")
def read_minutes(spark, sf):
    return B.papers(spark, sf).select("pmid", text.read_minutes(F.col("abstract")).alias("minutes"))


@query(f"SELECT pmid, CASE category WHEN 'es' THEN DATE '{AS_OF}' ELSE pub_date END AS day FROM papers")
def page_date(spark, sf):
    lang = F.col("category")
    shown = (F.when(lang == "en", F.concat(F.date_format("pub_date", "yyyy-MM-dd"), F.lit(" x")))
             .when(lang == "de", F.date_format("pub_date", "yyyy/MM/dd"))
             .when(lang == "fr", F.date_format("pub_date", "yyyy'年'MM'月'dd'日'")).otherwise(F.lit("undated")))
    return B.papers(spark, sf).select("pmid", text.page_date(shown, AS_OF).alias("day"))


@query("""SELECT pmid, CASE category WHEN 'en' THEN '10.1/' || pmid WHEN 'de' THEN 'PMID:' || pmid
  WHEN 'fr' THEN 'PMID:' || pmid ELSE '' END AS ref FROM papers""")
def source_ref(spark, sf):
    lang, pmid = F.col("category"), F.col("pmid")
    url = (F.when(lang == "en", F.concat(F.lit("https://doi.org/10.1/"), pmid))
           .when(lang == "de", F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")))
           .when(lang == "fr", F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid))
           .otherwise(F.concat(F.lit("https://example.org/"), pmid)))
    return B.papers(spark, sf).select("pmid", text.source_ref(url).alias("ref"))


_EMBED_TEXT = """concat_ws(chr(10) || chr(10), CASE WHEN title <> '' THEN 'Title: ' || title END,
  CASE WHEN abstract <> '' THEN 'Abstract: ' || abstract END,
  CASE WHEN len(mesh_terms) > 0 THEN 'Keywords: ' || array_to_string(mesh_terms, ', ') END,
  CASE WHEN category <> '' THEN 'Category: ' || category END)"""


@query(f"SELECT pmid, {_EMBED_TEXT} AS embedding_text FROM papers")
def embedding_text(spark, sf):
    return embed.with_embedding_text(B.papers(spark, sf)).select("pmid", "embedding_text")


@query("SELECT pmid, CAST(to_json(mesh_terms) AS VARCHAR) AS encoded FROM papers")
def json_encode(spark, sf):
    return B.papers(spark, sf).select("pmid", jsontext.encode_list(F.col("mesh_terms")).alias("encoded"))


@query("""SELECT pmid, CASE category WHEN 'es' THEN '' ELSE array_to_string(mesh_terms, ',') END AS decoded,
  CASE category WHEN 'es' THEN 0 ELSE len(mesh_terms) END::INTEGER AS n FROM papers""")
def json_decode(spark, sf):
    stored = F.when(F.col("category") != "es", F.to_json("mesh_terms"))
    back = jsontext.decode_list(stored)
    return B.papers(spark, sf).select("pmid", _join(back).alias("decoded"), F.size(back).alias("n"))


@query("""SELECT event_id, CASE event_type WHEN 'purchase' THEN NULL ELSE CAST(props ->> '$.k' AS INTEGER) END AS k,
  CASE event_type WHEN 'purchase' THEN 'rejected' WHEN 'click' THEN 'clean' ELSE 'repaired' END AS status FROM events""", cte=False)
def repair_json(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    messy = (F.when(kind == "click", F.concat(F.lit("Here it is:\n```json\n"), props, F.lit("\n```\n")))
             .when(kind == "purchase", F.replace(props, F.lit("}"), F.lit("")))
             .when(kind == "view", F.replace(props, F.lit("{"), F.lit('{"s": "two\nlines", ')))
             .otherwise(F.concat(F.lit("```\n"), F.replace(props, F.lit("}"), F.lit(",\n}")), F.lit("\n```"))))
    events = B.table(spark, sf, "events").select("event_id", messy.alias("raw"))
    fixed = jsontext.repair_json(events, "raw", T.StructType.fromDDL("k INT, s STRING"))
    return fixed.select("event_id", F.col("parsed.k").alias("k"), "status")


_TEMPLATE = "#{episode} {paper_title} | {paper_abstract} | {paper_journal} {paper_date} {paper_doi} {paper_url} [{paper_tags}]"


@query("""SELECT pmid, '#' || CAST(weekofyear(pub_date) AS VARCHAR) || ' ' || title || ' | ' || substring(abstract, 1, 3000) || ' | ' || journal
  || ' ' || CAST(pub_date AS VARCHAR) || ' ' || doi || ' ' || url || ' [' || array_to_string(mesh_terms, ', ') || ']' AS prompt
  FROM papers""")
def fill_template(spark, sf):
    c = F.col
    return B.papers(spark, sf).select("pmid", text.fill_template(
        _TEMPLATE, title=c("title"), abstract=c("abstract"), journal=c("journal"), date=c("pub_date"), doi=c("doi"),
        url=c("url"), tags=c("mesh_terms"), episode=text.iso_episode(c("pub_date"))).alias("prompt"))


@query("SELECT pmid, strftime(pub_date, '%Y-%m') AS month FROM papers")
def month_key(spark, sf):
    return B.papers(spark, sf).select("pmid", text.month_key(F.col("pub_date")).alias("month"))


@query("""SELECT pmid, substring(title, 1, 80) AS t80, substring(title, 1, 50) AS t50, substring(title, 1, 30) AS t30,
  substring(abstract, 1, 200) AS a200 FROM papers""")
def prefix_cut(spark, sf):
    cuts = [("title", 80, "t80"), ("title", 50, "t50"), ("title", 30, "t30"), ("abstract", 200, "a200")]
    return B.papers(spark, sf).select("pmid", *(text.prefix(F.col(c), n).alias(a) for c, n, a in cuts))


# ---- vectors ---------------------------------------------------------------

@query(f"""SELECT a.pmid AS pmid1, b.pmid AS pmid2, round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity
  FROM emb a JOIN emb b ON CAST(b.pmid AS BIGINT) = CAST(a.pmid AS BIGINT) + 1""")
def cosine(spark, sf):
    vecs = B.table(spark, sf, "embeddings")
    left = vecs.select(F.col("vec_id").alias("n"), F.col("vec_id").cast("string").alias("pmid1"), F.col("embedding").alias("v1"))
    right = vecs.select((F.col("vec_id") - 1).alias("n"), F.col("vec_id").cast("string").alias("pmid2"), F.col("embedding").alias("v2"))
    return left.join(right, "n").select("pmid1", "pmid2", F.round(vectors.cosine(F.col("v1"), F.col("v2")), 6).alias("similarity"))


_CENTROIDS = """flat AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM emb),
cen AS (SELECT label AS cid, list(m ORDER BY pos) AS centroid FROM (SELECT label, pos, avg(x) AS m FROM flat GROUP BY ALL) GROUP BY label)"""


@query(f""", {_CENTROIDS}
SELECT pmid, round({_COS.format(a="embedding", b="(SELECT centroid FROM cen WHERE cid = 0)")}, 6) AS similarity FROM emb
ORDER BY {_COS.format(a="embedding", b="(SELECT centroid FROM cen WHERE cid = 0)")} DESC, pmid LIMIT 10""")
def similar_topk(spark, sf):
    centre = cluster.centroids_by(B.table(spark, sf, "embeddings"), "label").filter("cid = 0").select("centroid").scalar()
    return similar.similar_topk(B.embeddings(spark, sf), centre, 10).withColumn("similarity", F.round("similarity", 6))


@query(f", {_RELATED} SELECT pmid, round(s, 6) AS similarity FROM near")
def related_papers(spark, sf):
    return similar.related_papers(B.embeddings(spark, sf), "0").withColumn("similarity", F.round("similarity", 6))


@query(f""", {_RELATED} SELECT near.pmid, coalesce(title, '') AS title, coalesce(category, '') AS category,
  coalesce(CAST(pub_date AS VARCHAR), '') AS pub_date, round(s, 6) AS similarity
  FROM near LEFT JOIN papers ON papers.pmid = near.pmid""")
def recommendations(spark, sf):
    return similar.recommendations(B.papers(spark, sf), B.embeddings(spark, sf), "0").withColumn(
        "similarity", F.round("similarity", 6))


@query(f"""SELECT a.pmid, CAST(row_number() OVER w AS INTEGER) AS rank, b.pmid AS related,
  round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity
  FROM emb a JOIN emb b ON a.pmid <> b.pmid
  WINDOW w AS (PARTITION BY a.pmid ORDER BY {_COS.format(a="a.embedding", b="b.embedding")} DESC, b.pmid)
  QUALIFY row_number() OVER w <= 5""")
def related_all(spark, sf):
    return similar.related_all(B.embeddings(spark, sf)).withColumn("similarity", F.round("similarity", 6))


@query(f"""SELECT a.pmid, CAST(row_number() OVER w AS INTEGER) AS rank, b.pmid AS related,
  round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity
  FROM emb a JOIN emb b ON a.pmid <> b.pmid
  WINDOW w AS (PARTITION BY a.pmid ORDER BY {_COS.format(a="a.embedding", b="b.embedding")} DESC, b.pmid)
  QUALIFY row_number() OVER w <= 5""")
def related_all_pivots(spark, sf):
    """The same with small blocks, hence many pivots."""
    return similar.related_all(B.embeddings(spark, sf), block_rows=128).withColumn(
        "similarity", F.round("similarity", 6))


ANN = {"dim": 64, "tables": 8, "bits": 4}


def _ann_sql() -> str:
    """Codes of all vectors from the same planes, and pairs whose codes differ in at most two signs."""
    planes = ", ".join(f"({t}, {b}, [{', '.join(map(repr, plane.tolist()))}])"
                       for t, table in enumerate(similar.hash_planes(**ANN)) for b, plane in enumerate(table))
    return f""", planes(grp, bit, plane) AS (VALUES {planes}),
codes AS (SELECT pmid, grp, sum(CASE WHEN list_dot_product(embedding, CAST(plane AS DOUBLE[])) > 0 THEN 1 << bit ELSE 0 END)::BIGINT AS code
  FROM emb, planes GROUP BY pmid, grp),
near AS (SELECT DISTINCT a.pmid AS p, b.pmid AS q FROM codes a JOIN codes b ON a.grp = b.grp AND a.pmid <> b.pmid
  AND bit_count(xor(a.code, b.code)) <= 2)"""


@query(_ann_sql() + f""" SELECT a.pmid, CAST(row_number() OVER w AS INTEGER) AS rank, b.pmid AS related,
  round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity
  FROM near JOIN emb a ON a.pmid = p JOIN emb b ON b.pmid = q
  WINDOW w AS (PARTITION BY a.pmid ORDER BY {_COS.format(a="a.embedding", b="b.embedding")} DESC, b.pmid)
  QUALIFY row_number() OVER w <= 5""")
def ann_topk(spark, sf):
    return similar.ann_topk(B.embeddings(spark, sf), **ANN).withColumn("similarity", F.round("similarity", 6))


@query()
def ann_recall(spark, sf):
    """Recall of ``ann_topk`` for the ids divisible by 100, searched exactly against all rows."""
    vectors = B.embeddings(spark, sf)
    asked = F.col("pmid").cast("long") % 100 == 0
    return similar.recall(similar.ann_topk(vectors, **ANN, asked=asked), similar.related_all(vectors, asked=asked))


# an index whose centroids and codewords SQL computes too: the centroids of the labels, and what the vectors of
# the ids below 16 leave of their own centroid, in eight parts
INDEX = {"probes": 6, "size": 30}
_INDEX_SQL = f""", {_CENTROIDS},
u AS (SELECT pmid, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS v FROM (SELECT pmid, CAST(embedding AS DOUBLE[]) AS e FROM emb)),
own AS (SELECT pmid, arg_min(cid, {{d: d, cid: cid}}) AS cid FROM (SELECT pmid, cid, list_distance(v, centroid) AS d FROM u, cen) GROUP BY pmid),
rest AS (SELECT pmid, cid, v, centroid, list_transform(range(1, 65), lambda i: v[i] - centroid[i]) AS r FROM u JOIN own USING (pmid) JOIN cen USING (cid)),
parts AS (SELECT pmid, m, r[8 * m + 1:8 * m + 8] AS w FROM rest, range(8) t(m)),
book AS (SELECT m, CAST(pmid AS INTEGER) AS j, w FROM parts WHERE CAST(pmid AS BIGINT) < 16),
code AS (SELECT p.pmid, p.m, arg_min(b.j, {{d: list_distance(p.w, b.w), j: b.j}}) AS j FROM parts p JOIN book b ON p.m = b.m GROUP BY p.pmid, p.m),
words AS (SELECT pmid, flatten(list(w ORDER BY m)) AS rr FROM code JOIN book USING (m, j) GROUP BY pmid),
hat AS (SELECT pmid, cid, list_transform(range(1, 65), lambda i: centroid[i] + rr[i]) AS x FROM rest JOIN words USING (pmid)),
probe AS (SELECT pmid, v, cid FROM u, cen QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY round(list_dot_product(v, centroid), 9) DESC, cid) <= {INDEX["probes"]}),
short AS (SELECT q.pmid AS p, h.pmid AS o FROM probe q JOIN hat h ON q.cid = h.cid
  QUALIFY row_number() OVER (PARTITION BY q.pmid ORDER BY h.pmid = q.pmid, round(list_dot_product(q.v, h.x), 9) DESC, h.pmid) <= {INDEX["size"]})"""


def _given_index(spark, sf):
    """The index of the embeddings with the centroids and codewords of ``_INDEX_SQL``."""
    table, rows = B.table(spark, sf, "embeddings"), B.embeddings(spark, sf)
    coarse = np.array([r["centroid"] for r in cluster.centroids_by(table, "label").orderBy("cid").collect()])
    first = kernels.matrix(table.filter("vec_id < 16").orderBy("vec_id").select("embedding").toArrow().column("embedding"))
    rest = first - coarse[kernels.nearest_rows(first, coarse)]
    return ivf.build(rows, ivf.Model(coarse, rest.reshape(len(first), 8, -1).transpose(1, 0, 2)))


@query(_INDEX_SQL + f""" SELECT a.pmid, CAST(row_number() OVER w AS INTEGER) AS rank, b.pmid AS related,
  round({_COS.format(a="a.embedding", b="b.embedding")}, 6) + 0.0 AS similarity
  FROM short JOIN emb a ON a.pmid = p JOIN emb b ON b.pmid = o WHERE p <> o
  WINDOW w AS (PARTITION BY a.pmid ORDER BY {_COS.format(a="a.embedding", b="b.embedding")} DESC, b.pmid)
  QUALIFY row_number() OVER w <= 5""")
def ann_index_topk(spark, sf):
    return ivf.index_topk(_given_index(spark, sf), 5, **INDEX).withColumn("similarity", F.round("similarity", 6))


@query(_INDEX_SQL + f""" SELECT b.pmid, round({_COS.format(a="a.embedding", b="b.embedding")}, 6) AS similarity
  FROM (SELECT h.pmid FROM probe q JOIN hat h ON q.cid = h.cid WHERE q.pmid = '0' ORDER BY round(list_dot_product(q.v, h.x), 9) DESC, h.pmid LIMIT {INDEX["size"]}) s
  JOIN emb b ON b.pmid = s.pmid, (SELECT embedding FROM emb WHERE pmid = '0') a
  ORDER BY {_COS.format(a="a.embedding", b="b.embedding")} DESC, b.pmid LIMIT 10""")
def ann_index_nearest(spark, sf):
    """Nearest to one stored paper, reading only the probed lists."""
    vector = B.embeddings(spark, sf).filter("pmid = '0'").agg(F.max("embedding")).first()[0]
    return ivf.nearest(_given_index(spark, sf), vector, 10, **INDEX).withColumn("similarity", F.round("similarity", 6))


TRAINED = {"probes": 24, "size": 40}


@query()
def ann_index_recall(spark, sf):
    """Recall of a trained index for the ids divisible by 100, and the shares of all pairs it decodes and compares in full."""
    rows = B.embeddings(spark, sf)
    index = ivf.build(rows, ivf.train(rows, lists=32))
    asked = F.col("pmid").cast("long") % 100 == 0
    found = similar.recall(ivf.index_topk(index, 5, asked=asked, **TRAINED), similar.related_all(rows, asked=asked))
    return found.crossJoin(F.broadcast(ivf.index_costs(index, asked=asked, **TRAINED)))


def _k_means_sql(k: int = 5, runs: int = 10, seed: int = 42, rounds: int = 30, pool: int = 8, least: int = 2) -> str:
    """Restarts of k-means, one table expression for every round; ends with the clusters of the cheapest run."""
    out = f""", pool AS MATERIALIZED (SELECT run, place, embedding FROM (SELECT run, pmid, embedding, row_number() OVER (
    PARTITION BY run ORDER BY md5(concat_ws(':', {seed}, run, pmid)), pmid) AS place
  FROM emb, range({runs}) AS r(run)) WHERE place <= {pool * k}),
pick0 AS (SELECT run, 0 AS label, embedding FROM pool WHERE place = 1)"""
    for i in range(1, k):
        out += f""", pick{i} AS MATERIALIZED (SELECT * FROM pick{i - 1} UNION ALL
  SELECT run, {i} AS label, arg_min(embedding, {{far: -far, place: place}}) FROM (
    SELECT p.run, p.place, any_value(p.embedding) AS embedding, min(list_distance(p.embedding::DOUBLE[], s.embedding::DOUBLE[])) AS far
    FROM pool p JOIN pick{i - 1} s ON p.run = s.run GROUP BY p.run, p.place) WHERE far > 0 GROUP BY run)"""
    out += f""", c0 AS MATERIALIZED (SELECT run, label, embedding::DOUBLE[] AS centre FROM pick{k - 1}
  WHERE label < (SELECT min(n) FROM (SELECT count(*) AS n FROM pick{k - 1} GROUP BY run)))"""
    for i in range(rounds):
        out += f""", a{i} AS MATERIALIZED (SELECT run, pmid, arg_min(label, {{d: d, label: label}}) AS label, min(d) AS d, any_value(embedding) AS embedding
  FROM (SELECT run, c{i}.label, pmid, list_distance(embedding::DOUBLE[], centre) AS d, embedding FROM emb, c{i}) GROUP BY run, pmid)"""
        if i + 1 < rounds:
            out += f""", c{i + 1} AS MATERIALIZED (SELECT run, label, coalesce(m.centre, c{i}.centre) AS centre FROM c{i} LEFT JOIN (
  SELECT run, label, list(x ORDER BY pos) AS centre FROM (SELECT run, label, pos, avg(x) AS x FROM (
    SELECT run, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos FROM a{i}) GROUP BY run, label, pos)
  GROUP BY run, label) m USING (run, label))"""
    return out + f""", best AS (SELECT run FROM a{rounds - 1} GROUP BY run ORDER BY sum(d * d), run LIMIT 1),
chosen AS (SELECT label, pmid FROM a{rounds - 1} JOIN best USING (run)),
sized AS (SELECT label, row_number() OVER (ORDER BY min(pmid)) - 1 AS cluster_id FROM chosen GROUP BY label HAVING count(*) >= {least})
SELECT cluster_id, pmid FROM chosen JOIN sized USING (label)"""


@query(_k_means_sql())
def cluster_papers(spark, sf):
    return cluster.cluster_papers(B.embeddings(spark, sf))


def _steps_sql(steps: int) -> str:
    """Rounds of k-means as one pair of table expressions each."""
    out = ""
    for i in range(steps + 1):
        before = "cen" if i == 0 else f"cen{i}"
        out += f""", to{i} AS (SELECT pmid, arg_min(cid, {{d: d, cid: cid}}) AS cid, min(d) AS d
  FROM (SELECT pmid, cid, list_distance(embedding, centroid) AS d FROM emb, {before}) GROUP BY pmid)"""
        if i < steps:
            out += f""", cen{i + 1} AS (SELECT cid, list(m ORDER BY pos) AS centroid FROM (SELECT cid, pos, avg(x) AS m
  FROM (SELECT cid, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM to{i} JOIN emb USING (pmid)) GROUP BY cid, pos) GROUP BY cid)"""
    return out


@query(f", {_CENTROIDS} {_steps_sql(2)} SELECT pmid, cid, round(d, 6) AS distance FROM to2")
def cluster_steps(spark, sf):
    centres = cluster.centroids_by(B.table(spark, sf, "embeddings"), "label")
    return cluster.cluster_steps(B.embeddings(spark, sf), centres, 2).withColumn("distance", F.round("distance", 6))


@query(f""", {_CENTROIDS}
SELECT pmid, arg_min(cid, {{d: d, cid: cid}}) AS cid, round(min(d), 6) AS distance
FROM (SELECT pmid, cid, list_distance(embedding, centroid) AS d FROM emb, cen) GROUP BY pmid""")
def nearest_centroid(spark, sf):
    centres = cluster.centroids_by(B.table(spark, sf, "embeddings"), "label")
    return cluster.nearest_centroid(B.embeddings(spark, sf), centres).withColumn("distance", F.round("distance", 6))


_OPPOSING_SQL = f""", x AS (SELECT a.pmid, a.title, a.category, list_distinct(a.mesh_terms) AS terms, a.evidence_level, e.embedding, {_flags('a')}
  FROM papers a JOIN emb e ON e.pmid = a.pmid),
c AS (SELECT a.pmid AS pmid1, b.pmid AS pmid2, substring(a.title, 1, 80) AS title1, substring(b.title, 1, 80) AS title2, a.category,
    array_to_string(list_sort(list_intersect(a.terms, b.terms)), ',') AS shared_terms,
    {_COS.format(a="a.embedding", b="b.embedding")} AS s, concat_ws(',', a.evidence_level, b.evidence_level) AS evidence_levels,
    CAST(0.5 * CAST(a.p_a AND b.n_a AS INT) + 0.5 * CAST(a.n_a AND b.p_a AS INT)
      - 0.2 * CAST(a.p_a AND b.p_a AND NOT a.n_a AND NOT b.n_a AS INT) AS DOUBLE) AS score
  FROM x a JOIN x b ON a.category = b.category AND a.pmid < b.pmid AND list_has_any(a.terms, b.terms))
SELECT pmid1, pmid2, title1, title2, category, shared_terms, round(s, 6) AS similarity, score AS contradiction_score, evidence_levels
FROM c WHERE s >= {B.MIN_SIMILARITY} AND score > 0.3 ORDER BY score DESC, pmid1, pmid2 LIMIT 20"""


def _opposing(spark, sf, **kw):
    return pairs.contradiction_pairs(B.papers(spark, sf, level=True), B.embeddings(spark, sf), B.MIN_SIMILARITY, B.POSITIVE, B.NEGATIVE, **kw).select(
        "pmid1", "pmid2", "title1", "title2", "category", _join("shared_terms").alias("shared_terms"),
        F.round("similarity", 6).alias("similarity"), "contradiction_score", _join("evidence_levels").alias("evidence_levels"))


@query(_OPPOSING_SQL)
def contradiction_pairs(spark, sf):
    return _opposing(spark, sf)


@query(_OPPOSING_SQL)
def contradiction_pairs_grid(spark, sf):
    """The same by cells alone, which the probe falls back to."""
    return _opposing(spark, sf, probe_rows=0)


_HASHED = f"""tok AS (SELECT pmid, unnest(list_filter(regexp_split_to_array(lower({{text}}), '[^\\p{{{{L}}}}\\p{{{{N}}}}]+'), lambda w: w <> '')) AS w FROM papers),
slots AS (SELECT pmid, ('0x' || substring(md5(w), 1, 8))::BIGINT % 384 AS slot, count(*) AS c FROM tok GROUP BY ALL),
units AS (SELECT pmid, slot, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY pmid)) AS FLOAT) AS DOUBLE) AS v FROM slots)
SELECT papers.pmid, 384 AS dim, count(slot) AS filled, coalesce(round(sum(v), 6), 0.0) AS total,
  coalesce(round(max(v), 6), 0.0) AS top, coalesce(round(sum(slot * v), 5), 0.0) AS placed FROM papers LEFT JOIN units USING (pmid) GROUP BY papers.pmid"""


def _vector_digest(df):
    def total(f):
        return F.aggregate(F.transform("embedding", f), F.lit(0.0), lambda a, x: a + x)

    return df.select("pmid", F.size("embedding").alias("dim"),
                     F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("filled"),
                     F.round(total(lambda x: x.cast("double")), 6).alias("total"),
                     F.round(F.array_max("embedding").cast("double"), 6).alias("top"),
                     F.round(total(lambda x, i: x.cast("double") * i), 5).alias("placed"))


@query(", " + _HASHED.format(text="abstract"))
def embed_text(spark, sf):
    rows = B.papers(spark, sf).select("pmid", "abstract")
    return _vector_digest(embed.embed_text(rows, "abstract", kernels.hash_encoder(384)))


@query(", " + _HASHED.format(text=_EMBED_TEXT))
def embed_papers(spark, sf):
    return _vector_digest(embed.embed_papers(B.papers(spark, sf), now=NOW))


SEARCHED = "the und les que from with"


@query(", " + _HASHED.format(text=_EMBED_TEXT).partition("SELECT papers.pmid, 384")[0].rstrip() + f""",
q AS (SELECT ('0x' || substring(md5(w), 1, 8))::BIGINT % 384 AS slot, count(*) AS c FROM
  (SELECT unnest(string_split('{SEARCHED}', ' ')) AS w) GROUP BY slot),
found AS (SELECT pmid, round(sum(v * c) / sqrt(sum(v * v)), 9) AS s FROM (SELECT units.pmid, v, coalesce(c, 0) AS c FROM units LEFT JOIN q USING (slot)) GROUP BY pmid)
SELECT pmid, round(s / sqrt((SELECT sum(c * c) FROM q)), 6) AS similarity FROM found ORDER BY s DESC, pmid LIMIT 10""")
def text_search(spark, sf):
    """Papers nearest to a search text, by the vectors of their own texts."""
    vectors = embed.embed_papers(B.papers(spark, sf), now=NOW)
    return similar.similar_topk(vectors, embed.embed_query(spark, SEARCHED), 10).withColumn("similarity", F.round("similarity", 6))
