"""The small cases: clusters, trends, focus, theme, recommendations."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators import cluster, embed, lookup, similar, trends
from paperlake.plans import theme

AS_OF = dt.date(2024, 12, 31)


@pytest.fixture(scope="module")
def three_groups(make_papers, make_embeddings):
    rng = np.random.default_rng(42)
    papers, vectors = [], {}
    for g, (cat, term) in enumerate([("heart", "hypertension"), ("brain", "cognitive"), ("muscle", "protein")]):
        base = np.zeros(384)
        base[g] = 1
        for i in range(3):
            key = f"{g}{i}"
            papers.append({"pmid": key, "title": f"Paper {key}", "category": cat, "mesh_terms": [term]})
            vectors[key] = base + rng.normal(0, 0.01, 384)
    return make_papers(papers), make_embeddings(vectors)


def test_clusters(spark, three_groups, make_embeddings):
    papers, vectors = three_groups
    got = cluster.cluster_papers(vectors, 3, n_init=4)
    groups = {}
    for r in got.collect():
        groups.setdefault(r["cluster_id"], set()).add(r["pmid"])
    assert groups == {0: {"00", "01", "02"}, 1: {"10", "11", "12"}, 2: {"20", "21", "22"}}
    rows = cluster.cluster_summary(got, papers).orderBy("cluster_id").collect()
    assert [r["size"] for r in rows] == [3, 3, 3]
    assert [r["top_categories"][0][0] for r in rows] == ["heart", "brain", "muscle"]
    assert rows[1]["representative_pmids"] == ["10", "11", "12"] and rows[1]["titles"][0] == "Paper 10"
    assert cluster.cluster_papers(make_embeddings({}), 3).count() == 0
    assert cluster.cluster_papers(make_embeddings({"a": [1, 0], "b": [0, 1]}), 5, 1, 2).count() == 2
    assert cluster.cluster_papers(make_embeddings({"a": [1, 0], "b": [0, 1]}), 5, 2, 2).count() == 0
    assert cluster.cluster_papers(make_embeddings({"a": [1, 0]}), 5, 1).count() == 1


def test_k_means_does_not_depend_on_partitions(spark, make_embeddings):
    """Several runs share a pass, the cheapest wins, and copies, nulls and partitions change nothing."""
    rng = np.random.default_rng(3)
    spots = rng.normal(scale=8, size=(4, 6))
    points = {f"p{i:03d}": spots[i % 4] + rng.normal(size=6) for i in range(200)}
    vectors = make_embeddings({**points, **{f"q{i:03d}": points["p000"] for i in range(100)}, "none": None, "empty": []})
    found = [{r["pmid"]: r["cluster_id"] for r in cluster.cluster_papers(vectors.repartition(n), 4, n_init=3, rounds=12).collect()}
             for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 300
    assert all(found[0][f"p{i:03d}"] == found[0][f"p{i % 4:03d}"] for i in range(200))
    assert len(set(found[0].values())) == 4


def test_k_means_costs_fall(spark, make_embeddings):
    """More rounds or more runs never cost more, against a plain numpy cost."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(150, 5)).astype(np.float32).astype(float)
    vectors = make_embeddings({f"p{i:03d}": row for i, row in enumerate(rows)}).select("pmid", "embedding")

    def cost(n_init, rounds):
        centres = cluster.k_means(vectors, 6, n_init, rounds=rounds)
        return ((rows[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()

    assert cost(1, 1) > cost(1, 3) >= cost(1, 8) >= cost(4, 8)


def test_nearest_centroid_of_odd_rows(spark, make_embeddings):
    """Rows without a vector stay, copies of a centroid go to the lower id, in one block or many."""
    centres = spark.createDataFrame([(i, [float(i // 2 % 5), 1.0, 0.0, 0.0, 2.0]) for i in range(40)], "cid int, centroid array<double>")
    vectors = make_embeddings({"a": [3, 1, 0, 0, 2], "b": [3.5, 1, 0, 0, 2], "none": None})
    for block in (3, 100):
        got = {r["pmid"]: (r["cid"], r["distance"]) for r in cluster.nearest_centroid(vectors, centres, block).collect()}
        assert got == {"a": (6, 0.0), "b": (6, 0.5), "none": (None, None)}
    assert [r["cid"] for r in cluster.nearest_centroid(vectors, centres.limit(0)).collect()] == [None] * 3


def test_nearest_centroid(spark, make_embeddings):
    centres = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0])], "cid int, centroid array<double>")
    got = cluster.nearest_centroid(make_embeddings({"a": [0.4, 0], "b": [1.9, 0], "tie": [1, 0]}), centres).collect()
    assert {r["pmid"]: r["cid"] for r in got} == {"a": 1, "b": 2, "tie": 1}


def test_nearest_of_many_centroids(spark, make_embeddings):
    """More centroids than one block holds give the answer of a single block."""
    centres = spark.range(10_001).selectExpr("cast(id as int) cid", "array(cast(id as double), 0.0D) centroid")
    vectors = make_embeddings({str(i): [i * 97 + 0.4, 1] for i in range(100)})
    got = {r["pmid"]: r["cid"] for r in cluster.nearest_centroid(vectors, centres).collect()}
    assert got == {str(i): i * 97 for i in range(100)}
    assert got == {r["pmid"]: r["cid"] for r in cluster.nearest_centroid(vectors, centres, 50_000).collect()}


@pytest.fixture(scope="module")
def dated(make_papers):
    return make_papers([{"pmid": str(i), "title": "Study", "abstract": "about Hypertension" if i % 2 else "",
                         "category": ["heart", "brain"][i % 2], "pub_date": AS_OF - dt.timedelta(days=14 * (23 - i)),
                         "mesh_terms": [["hypertension"], ["Cognitive", "cognitive"]][i % 2]} for i in range(24)])


def test_trends(dated):
    rows = trends.keyword_trend(dated, "HYPERTENSION", AS_OF, 12).collect()
    assert rows[0]["total"] == sum(r["n"] for r in rows) == 24
    assert [r["month"] for r in rows] == sorted(r["month"] for r in rows)
    assert {r["category"] for r in trends.category_trend(dated, AS_OF).collect()} == {"heart", "brain"}
    topics = {r["keyword"]: r for r in trends.trending_topics(dated, AS_OF).collect()}
    assert set(topics) == {"hypertension", "cognitive"}
    months = topics["cognitive"]["monthly_counts"]
    assert topics["cognitive"]["total_papers"] == sum(months.values()) and min(months.values()) >= 2
    first, last = months[min(months)], months[max(months)]
    assert topics["cognitive"]["growth_rate"] == (last - first) / first
    assert trends.keyword_trend(dated, "100%", AS_OF).count() == 0


def test_focus(make_papers):
    papers = make_papers([
        {"pmid": "1", "title": "Study in Japan", "category": "heart"},
        {"pmid": "2", "title": "US study", "abstract": "none", "category": "heart"},
        {"pmid": "3", "title": "x", "abstract": None, "mesh_terms": ["Japanese people"], "category": "brain"}])
    assert {r["pmid"] for r in lookup.focus_papers(papers).collect()} == {"1", "3"}
    assert {r["pmid"] for r in lookup.focus_papers(papers, category="heart").collect()} == {"1"}
    assert trends.focus_ratio(papers, category="heart").first()["ratio"] == 0.5
    assert trends.focus_ratio(papers, category="none").first()["ratio"] == 0.0


def log_of(spark, rows):
    return spark.createDataFrame([(i, "w", "t", ids, "s", day) for i, (ids, day) in enumerate(rows)],
                                 "id long, week string, theme string, source_pmids array<string>, article_slug string, created_at timestamp")


@pytest.fixture(scope="module")
def recent(make_papers, make_embeddings):
    papers = make_papers([{"pmid": f"p{i}", "title": f"Title {i}", "category": "heart" if i else None,
                           "pub_date": AS_OF - dt.timedelta(days=i), "mesh_terms": ["term"] if i % 3 else [],
                           "evidence_level": "RCT" if i % 2 else "meta-analysis"} for i in range(10)])
    vectors = {f"p{i}": [1.0, 0.1 * i, 0.0] for i in range(9)} | {"p9": None}
    vectors["p4"] = [0.0, 0.0, 1.0]
    return papers, make_embeddings(vectors)


def test_theme_picks_and_excludes(spark, recent):
    papers, vectors = recent
    used = [(["p0"], dt.datetime(2024, 12, 20))]
    seen = {"p0"}
    for _ in range(3):
        got = theme.pick_theme(papers, vectors, log_of(spark, used), AS_OF).first()
        assert not seen & set(got["source_pmids"])
        assert got["source_pmids"][0] == got["primary_pmid"]
        seen |= set(got["source_pmids"])
        used.append((got["source_pmids"], dt.datetime(2024, 12, 31)))
    first = theme.pick_theme(papers, vectors, log_of(spark, used[:1]), AS_OF).first()
    assert first["primary_pmid"] == "p2" and first["topic"] == "heart: term" and first["evidence_level"] == "meta-analysis"
    assert "p4" not in first["source_pmids"] and {"p6", "p8", "p1", "p3"} == set(first["source_pmids"][1:])
    assert first["reasoning"].startswith("最新のmeta-analysis研究「Title 2...」")


def test_theme_edges(spark, recent, make_papers, make_embeddings):
    papers, vectors = recent
    unrated = papers.withColumn("evidence_level", F.lit(None).cast("string"))
    got = theme.pick_theme(unrated, vectors, log_of(spark, []), AS_OF).first()
    assert got["primary_pmid"] == "p0" and got["topic"] == "健康: Title 0"
    old = log_of(spark, [([f"p{i}" for i in range(10)], dt.datetime(2024, 11, 1))])
    assert theme.pick_theme(papers, vectors, old, AS_OF).first()["primary_pmid"] == "p0"
    spent = log_of(spark, [([f"p{i}" for i in range(10)], dt.datetime(2024, 12, 30))])
    assert theme.pick_theme(papers, vectors, spent, AS_OF).count() == 0
    lone = theme.pick_theme(papers.filter("pmid = 'p9'"), vectors, log_of(spark, []), AS_OF).first()
    assert lone["source_pmids"] == ["p9"]


def test_recommendations(spark, make_papers, make_embeddings):
    papers = make_papers([{"pmid": "a", "title": "A"}, {"pmid": "b", "title": "B", "pub_date": AS_OF}])
    vectors = make_embeddings({"a": [1, 0], "b": [1, 0.1], "c": [0.5, 1], "none": None, "zero": [0, 0]})
    got = similar.recommendations(papers, vectors, "a", 5).collect()
    assert [(r["pmid"], r["title"], r["pub_date"]) for r in got] == [("b", "B", "2024-12-31"), ("c", "", "")]
    assert all(0 <= r["similarity"] <= 1 for r in got)
    assert similar.recommendations(papers, vectors, "unknown").count() == 0
    assert similar.related_papers(vectors, "none").count() == 0


def test_similar_topk(spark, make_embeddings):
    vectors = make_embeddings({"same": [2, 0], "ortho": [0, 1], "opp": [-1, 0], "none": None})
    got = [(r["pmid"], round(r["similarity"], 6)) for r in similar.similar_topk(vectors, [1.0, 0.0]).collect()]
    assert got == [("same", 1.0), ("ortho", 0.0), ("opp", -1.0)]
    assert len(similar.similar_topk(vectors, [1.0, 0.0], 1).collect()) == 1


def test_search_by_text(spark, make_papers):
    papers = make_papers([{"pmid": "1", "title": "salt and blood pressure", "mesh_terms": ["salt"], "category": "heart"},
                          {"pmid": "2", "title": "walking for memory", "category": "brain"}])
    rows = embed.embed_papers(papers, now="2024-01-01 00:00:00")
    vector = {r["pmid"]: r["embedding"] for r in rows.collect()}
    assert all(len(v) == 384 and abs(np.linalg.norm(v) - 1) < 1e-6 for v in vector.values())
    best = similar.similar_topk(rows, embed.embed_query(spark, "memory walking"), 1).first()
    assert best["pmid"] == "2"


def test_encoder_plugs_in(spark):
    def factory():
        return lambda texts: np.array([[len(t), 1.0, 2.0] for t in texts])

    texts = spark.createDataFrame([(i, "x" * i) for i in range(100)], "i int, t string")
    rows = embed.embed_text(texts, "t", factory, batch_size=7).collect()
    assert len(rows) == 100
    for r in rows:
        want = np.array([r["i"], 1.0, 2.0])
        assert np.allclose(r["embedding"], want / np.linalg.norm(want), atol=1e-6)
