import datetime as dt
import json
import os

from pyspark.sql import functions as F

from paperlake import schemas
from paperlake.functions.jsontext import repair_json
from paperlake.operators.upsert import index_entries, index_rows, upsert_index_front
from paperlake.operators import lookup
from paperlake.plans.load import load_articles
from paperlake.plans.weekly import prepare_fetched, weekly_candidates
from paperlake.sources import feeds, pages, tables

PAGE = """<html><body><header><p class="masthead-date">2026-07-15 no. 3</p><h1 class="masthead-title">Masthead</h1></header>
<main><article><div class="article-meta"><span class="cat-badge">脳・認知</span><span>x</span></div>
<h1>Walking &amp; <em>thinking</em></h1><p class="article-lead">Lead &lt;here&gt;</p>
<div class="article-content" itemprop="articleBody"><h2>A</h2><div class="box"><div>in</div></div><p>B</p></div>
<div class="after">no</div>
<a href="https://doi.org/10.1/abc?x=1&amp;y=2" class="source-link" target="_blank">source</a>
<a class="tag" href="#">memory</a> <a class="tag hot" href="#">gait</a></article></main></body></html>"""

XML = """<?xml version="1.0"?><PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">11</PMID><Article>
<Journal><JournalIssue><PubDate><Year>2026</Year><Month>Jul</Month><Day>5</Day></PubDate></JournalIssue><Title>J One</Title></Journal>
<ArticleTitle>Effect of <i>sleep</i> on p &lt; 0.05 and q &gt; 1</ArticleTitle>
<Abstract><AbstractText Label="A">First part.</AbstractText><AbstractText Label="B">Second part.</AbstractText></Abstract>
</Article><MeshHeadingList><MeshHeading><DescriptorName UI="D1">Sleep</DescriptorName></MeshHeading>
<MeshHeading><DescriptorName>Insomnia</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">11</ArticleId><ArticleId IdType="doi">10.1/a</ArticleId>
<ArticleId IdType="doi">10.1/b</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>12</PMID><Article>
<Journal><JournalIssue><PubDate><Year>2026</Year><Month>7</Month></PubDate></JournalIssue></Journal>
<ArticleTitle>A randomized controlled study</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>13</PMID><Article><Journal><JournalIssue><PubDate><MedlineDate>2025</MedlineDate></PubDate>
</JournalIssue></Journal><ArticleTitle>No year</ArticleTitle></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>"""


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def test_pages(spark, tmp_path):
    base = str(tmp_path / "article")
    write(f"{base}/one/index.html", PAGE)
    write(f"{base}/two/index.html", "<html><h1>Only heading</h1></html>")
    write(f"{base}/-draft/index.html", PAGE)
    write(f"{base}/category/index.html", PAGE)
    write(f"{base}/category/heart/index.html", PAGE)
    write(f"{base}/three/other.html", PAGE)
    rows = {r["slug"]: r for r in pages.extract_pages(pages.read_pages(spark, base), "2026-08-01", url_base="u/").collect()}
    assert set(rows) == {"one", "two"}
    one = rows["one"]
    assert (one["title"], one["category"], one["pub_date"]) == ("Walking & thinking", "brain", dt.date(2026, 7, 15))
    assert one["abstract"] == "Lead <here>"
    assert one["body_html"] == ('<div class="article-content" itemprop="articleBody"><h2>A</h2><div class="box">'
                                "<div>in</div></div><p>B</p></div>")
    assert one["source_url"] == "https://doi.org/10.1/abc?x=1&y=2" and one["doi"] == "10.1/abc?x=1&y=2"
    assert one["mesh_terms"] == ["memory", "gait"] and one["url"] == "u/one/"
    two = rows["two"]
    assert (two["title"], two["category"], two["pub_date"]) == ("Only heading", "health", dt.date(2026, 8, 1))
    assert (two["body_html"], two["source_url"], two["doi"], two["mesh_terms"]) == ("", "", "", [])


def test_load_articles(spark, make_papers, make_embeddings):
    docs = spark.createDataFrame([("one", PAGE), ("bad", None), ("", PAGE)], "slug string, html string")
    papers = make_papers([{"pmid": "one", "title": "old"}, {"pmid": "p", "title": "kept"}])
    loaded = load_articles(docs, papers, make_embeddings({"p": [1.0] * 384}), index_rows(papers), "2026-08-01 00:00:00")
    stored = {r["pmid"]: r for r in loaded.papers.collect()}
    assert set(stored) == {"one", "p"} and stored["one"]["title"] == "Walking & thinking"
    assert stored["one"]["created_at"] == dt.datetime(2024, 1, 1) and stored["one"]["updated_at"] == dt.datetime(2026, 8, 1)
    assert {r["pmid"] for r in loaded.embeddings.collect()} == {"one", "p"}
    assert {r["slug"]: r["title"] for r in loaded.search_index.collect()} == {"one": "Walking & thinking", "p": "kept"}
    assert {r["problem"] for r in loaded.rejects.collect()} == {"no html", "no slug"}


def test_sources_three_shapes(spark):
    doc = {"a": {"n1": "u1", "n2": "u2"}, "b": [{"name": "n3", "url": "u3"}, {"name": "n4"}, {"url": "u5"}], "c": ["n6", 7], "d": "x"}
    frame = spark.createDataFrame([("k", json.dumps(doc)), ("broken", "{")], "k string, doc string")
    rows = feeds.flatten_sources(frame, "doc", "k").collect()
    assert sorted((r["category"], r["name"], r["url"]) for r in rows) == [
        ("a", "n1", "u1"), ("a", "n2", "u2"), ("b", "", "u5"), ("b", "n3", "u3"), ("b", "n4", ""), ("c", "7", ""), ("c", "n6", "")]
    assert sorted(r["id"] for r in rows) == list(range(1, 8))


def test_xml(spark, tmp_path):
    path = str(tmp_path / "drop.xml")
    write(path, XML)
    rows = {r["pmid"]: r for r in feeds.parse_paper_xml(feeds.read_paper_xml(spark, path)).collect()}
    assert set(rows) == {"11", "12", "13"}
    first = rows["11"]
    assert first["title"] == "Effect of sleep on p < 0.05 and q > 1"
    assert first["abstract"] == "First part." and first["journal"] == "J One" and first["doi"] == "10.1/a"
    assert first["raw_pub_date"] == "2026-Jul-05" and first["pub_date"] == dt.date(2026, 7, 5)
    assert first["mesh_terms"] == ["sleep", "insomnia"] and first["authors"] == []
    assert first["url"].endswith("/11/")
    assert rows["12"]["raw_pub_date"] == "2026-07-00" and rows["12"]["pub_date"] is None
    assert (rows["12"]["abstract"], rows["12"]["doi"], rows["12"]["mesh_terms"]) == ("", "", [])
    assert rows["13"]["raw_pub_date"] == ""
    joined = feeds.parse_paper_xml(feeds.read_paper_xml(spark, path), all_sections=True)
    assert joined.filter("pmid = '11'").first()["abstract"] == "First part.\nSecond part."


def test_weekly_run(spark, tmp_path):
    path = str(tmp_path / "drop.xml")
    write(path, XML)
    fetched = feeds.parse_paper_xml(feeds.read_paper_xml(spark, path))
    best = weekly_candidates(fetched, "2026-07-10", 2).collect()
    assert [r["pmid"] for r in best] == ["12", "11"]
    assert [r["score"] for r in best] == [15, 10]
    ready = {r["pmid"]: r for r in prepare_fetched(fetched, "2026-07-10 00:00:00").collect()}
    assert ready["11"]["category"] == "sleep" and ready["12"]["category"] == "health"
    assert ready["12"]["evidence_level"] == "RCT" and ready["11"]["evidence_level"] is None


def test_search_index_file(spark, tmp_path):
    path = str(tmp_path / "index.json")
    write(path, json.dumps({"version": "1", "articles": [{"slug": s, "title": s.upper(), "tags": ["t"]} for s in "abc"]}, indent=2))
    rows = feeds.read_search_index(spark, path)
    assert [(r["pos"], r["slug"]) for r in rows.orderBy("pos").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    missing = feeds.read_search_index(spark, str(tmp_path / "none.json"))
    assert missing.columns == rows.columns and missing.count() == 0
    arrivals = spark.createDataFrame([("c", "new c", 1), ("d", "new d", 2), ("d", "newer d", 3)], "slug string, title string, pos long")
    moved = upsert_index_front(rows.select("slug", "title", F.col("pos").cast("long")), arrivals, block=2).orderBy("pos").collect()
    assert [(r["pos"], r["slug"], r["title"]) for r in moved] == [
        (1, "d", "newer d"), (2, "c", "new c"), (3, "a", "A"), (4, "b", "B")]
    frame = spark.createDataFrame(moved)
    assert [json.loads(r["value"])["slug"] for r in feeds.index_lines(frame).collect()] == ["d", "c", "a", "b"]
    (tmp_path / "out").mkdir()
    listed = ",".join(r["value"] for r in feeds.index_lines(frame).collect())
    (tmp_path / "out" / "index.json").write_text('{"version": "1.0", "articles": [' + listed + "]}")
    back = feeds.read_search_index(spark, str(tmp_path / "out"))
    assert [(r["pos"], r["slug"]) for r in back.orderBy("pos").collect()] == [(0, "d"), (1, "c"), (2, "a"), (3, "b")]


def test_index_entries(spark):
    raw = spark.createDataFrame([("s", ["Sleep"], "2026-07-01", '{"title": "T", "lead": "L", "affiliate_keywords": ["k"],}'),
                                 ("t", [], None, '{"title": "U"}')], "slug string, mesh_terms array<string>, pub_date string, raw string")
    rows = {r["slug"]: r for r in index_entries(repair_json(raw, "raw")).collect()}
    assert tuple(rows["s"]) == ("s", "T", "L", "sleep", ["k"], "2026-07-01", "/article/s/")
    assert rows["t"]["tags"] == [] and rows["t"]["category"] == "health"


def test_versions(spark, tmp_path, make_papers):
    root = str(tmp_path / "papers")
    assert tables.read_latest(spark, root, schemas.PAPERS).count() == 0
    tables.write_version(make_papers([{"pmid": "1", "title": "a"}]), root)
    current = tables.read_latest(spark, root, schemas.PAPERS)
    tables.write_version(current.unionByName(make_papers([{"pmid": "2", "title": "b"}])), root)
    assert tables.versions(spark, root) == [1, 2]
    os.makedirs(f"{root}/v=3")  # a job that died before its marker
    assert tables.read_latest(spark, root, schemas.PAPERS).count() == 2


def test_clustered_files_hold_date_ranges(spark, tmp_path, make_papers):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i * 37 % 400) for i in range(400)]
    rows = make_papers([{"pmid": str(i), "title": "t", "pub_date": d} for i, d in enumerate(days)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = tables.write_version(rows, str(tmp_path / "p"), ["pub_date", "pmid"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.min("pub_date").alias("a"), F.max("pub_date").alias("z"))
             .orderBy("a").collect())
    assert len(spans) > 1 and all(x["z"] <= y["a"] for x, y in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_shuffle(spark, make_papers, make_embeddings):
    papers = tables.save_bucketed(make_papers([{"pmid": str(i), "title": "t"} for i in range(50)]), "papers_b", 4)
    vectors = tables.save_bucketed(make_embeddings({str(i): [1.0, i] for i in range(50)}), "vectors_b", 4)
    joined = lookup.papers_with_embeddings(papers.hint("merge"), vectors)
    assert joined.count() == 50
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_reload(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.reload_table(spark.range(5), path, ["id"])
    assert tables.reload_table(spark.range(3), path).count() == 3


def test_stream_intake(spark, tmp_path):
    from paperlake.streaming.intake import run_intake

    drop, root, ckpt = (str(tmp_path / n) for n in ("drop", "papers", "ckpt"))
    write(f"{drop}/w1.xml", XML)
    args = (spark, drop, root, ckpt, dt.datetime(2026, 7, 10))
    run_intake(*args).awaitTermination()
    write(f"{drop}/w2.xml", XML.replace("No year", "Changed").replace(">12<", ">22<"))
    run_intake(*args).awaitTermination()
    stored = {r["pmid"]: r["title"] for r in tables.read_latest(spark, root, schemas.PAPERS).collect()}
    assert set(stored) == {"11", "12", "13", "22"} and stored["13"] == "Changed"


def test_character_references(spark):
    raw = "a &amp; b &copy;&middot;&#39;&#x2014;&#128512; &amp;lt; &unknown; &nbsp;x & y &#xD800; &#99999999; &eacute"
    frame = spark.createDataFrame([(raw,), ("plain",), ("",), (None,)], "t string")
    got = [r["x"] for r in frame.select(pages.resolve_references(F.col("t")).alias("x")).collect()]
    assert got == ["a & b ©·'—😀 &lt; &unknown; \u00a0x & y &#xD800; &#99999999; &eacute", "plain", "", None]
