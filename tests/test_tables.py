import datetime as dt

from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions.jsontext import decode_list, encode_list
from paperlake.operators import lookup, rules, upsert
from paperlake.operators.numbering import number_by_hash, number_rows

DAY = dt.date(2024, 1, 15)
NOW = dt.datetime(2024, 2, 1)


def log_of(spark, rows):
    return spark.createDataFrame(rows, "id long, week string, theme string, source_pmids array<string>, "
                                       "article_slug string, created_at timestamp")


def test_upsert_inserts_and_updates(spark, make_papers):
    stored = make_papers([{"pmid": "12345678", "title": "Old", "abstract": "old", "pub_date": DAY, "category": "heart"}])
    batch = make_papers([{"pmid": "12345678", "title": "New", "abstract": "new", "pub_date": DAY, "category": None},
                         {"pmid": "2", "title": "Other"}])
    got = {r["pmid"]: r for r in upsert.upsert_papers(stored, batch, NOW).collect()}
    assert set(got) == {"12345678", "2"}
    changed = got["12345678"]
    assert (changed["title"], changed["abstract"], changed["category"]) == ("New", "new", None)
    assert changed["created_at"] == dt.datetime(2024, 1, 1) and changed["updated_at"] == NOW


def test_upsert_is_idempotent_and_last_wins(spark, make_papers):
    stored = make_papers([{"pmid": str(i), "title": f"t{i}"} for i in range(5)])
    batch = make_papers([{"pmid": "1", "title": "first", "updated_at": dt.datetime(2024, 1, 2)},
                         {"pmid": "1", "title": "last", "updated_at": dt.datetime(2024, 1, 3)},
                         {"pmid": "9", "title": "fresh"}])
    once = upsert.upsert_papers(stored, batch, NOW)
    twice = upsert.upsert_papers(once, batch, NOW)
    assert sorted(map(tuple, once.select("pmid", "title").collect())) == \
        sorted(map(tuple, twice.select("pmid", "title").collect()))
    assert {r["pmid"]: r["title"] for r in twice.collect()} == {
        "0": "t0", "1": "last", "2": "t2", "3": "t3", "4": "t4", "9": "fresh"}
    assert twice.count() == 6


def test_rows_without_order_keep_their_place(spark):
    entries = spark.createDataFrame([(None, "2025-W01", "x"), (2, "2025-W01", "y")], "arrived long, week string, article_slug string").selectExpr(
        "arrived", "week", "'t' theme", "array('1') source_pmids", "article_slug", "cast(null as timestamp) created_at")
    log = spark.createDataFrame([], "id long, week string, theme string, source_pmids array<string>, article_slug string, created_at timestamp")
    got = upsert.append_log(log, entries, NOW, arrival="arrived").orderBy("id").collect()
    assert [(r["id"], r["article_slug"]) for r in got] == [(1, "x"), (2, "y")]
    index = spark.createDataFrame([("a", "A", None), ("b", "B", 1)], "slug string, title string, pos long")
    front = spark.createDataFrame([("c", "C", None)], "slug string, title string, pos long")
    assert [r["slug"] for r in upsert.upsert_index_front(index, front).orderBy("pos").collect()] == ["c", "a", "b"]
    frame = spark.createDataFrame([(None,), ("k",)], "k string")
    assert sorted(r["id"] for r in number_by_hash(frame, F.col("k")).collect()) == [1, 2]


def test_ingest_counts_processed_rows(spark, make_papers):
    batch = make_papers([{"pmid": "1", "title": "a"}, {"pmid": "1", "title": "b"}, {"pmid": "2", "title": "c"}])
    table, processed = upsert.ingest_papers(make_papers([]), batch, NOW)
    assert processed.first()["processed"] == 3 and table.count() == 2


def test_embeddings_are_replaced(spark, make_embeddings):
    got = upsert.upsert_embeddings(make_embeddings({"a": [1, 0], "b": [0, 1]}), make_embeddings({"b": [1, 1], "c": [2, 2]}, "m2"))
    assert {r["pmid"]: (list(r["embedding"]), r["model"]) for r in got.collect()} == {
        "a": ([1.0, 0.0], "m"), "b": ([1.0, 1.0], "m2"), "c": ([2.0, 2.0], "m2")}


def test_lookups(spark, make_papers):
    days = {"1": 30, "2": 2, "3": 0, "4": -1}
    papers = make_papers([{"pmid": k, "title": k, "category": c, "pub_date": DAY - dt.timedelta(days=days[k])}
                          for k, c in zip("1234", ["heart", "brain", "heart", "muscle"])])
    assert lookup.paper_by_id(papers, "2").count() == 1 and lookup.paper_by_id(papers, "x").count() == 0
    assert [r["pmid"] for r in lookup.papers_by_category(papers, "heart").collect()] == ["3", "1"]
    assert [r["pmid"] for r in lookup.papers_by_category(papers, "heart", 1).collect()] == ["3"]
    assert [r["pmid"] for r in lookup.recent_papers(papers, DAY).collect()] == ["4", "3", "2"]
    assert lookup.papers_in_set(papers, ["1", "4", "x"]).count() == 2
    assert lookup.category_filter(papers, "all").count() == 4 and lookup.category_filter(papers, "heart").count() == 2


def test_log(spark, make_papers):
    log = log_of(spark, [(1, "2024-W03", "t", ["12345678", "87654321"], "slug", dt.datetime(2024, 1, 15)),
                         (4, "2024-W03", "t2", [], "slug2", dt.datetime(2023, 1, 15))])
    papers = make_papers([{"pmid": "12345678", "title": "a"}, {"pmid": "1234567", "title": "b"}])
    assert {r["pmid"]: r["processed"] for r in lookup.is_processed(papers, log).collect()} == {"12345678": True, "1234567": False}
    assert [r["pmid"] for r in lookup.unused_papers(papers, lookup.distinct_used(log)).collect()] == ["1234567"]
    assert lookup.log_by_week(log, "2024-W03").first()["id"] == 1 and lookup.log_by_week(log, "2020-W01").count() == 0
    assert lookup.distinct_used(log, dt.date(2024, 1, 20), 4).count() == 2
    assert lookup.distinct_used(log, dt.date(2025, 1, 20), 4).count() == 0
    entries = spark.createDataFrame([("w", "t", ["x"], "s2", None, 2), ("w", "t", ["y"], "s1", None, 1)],
                                    "week string, theme string, source_pmids array<string>, article_slug string, created_at timestamp, n int")
    longer = upsert.append_log(log, entries, NOW, arrival="n")
    assert {r["article_slug"]: r["id"] for r in longer.collect()} == {"slug": 1, "slug2": 4, "s1": 5, "s2": 6}
    hashed = upsert.append_log(log_of(spark, []), entries, NOW)
    assert sorted(r["id"] for r in hashed.collect()) == [1, 2]


def test_constraints(spark, make_papers, make_embeddings):
    papers = make_papers([{"pmid": "1", "title": "a"}, {"pmid": "1", "title": "b"}])
    vecs = make_embeddings({"1": [1, 0], "2": [1], "3": None})
    report = {r["rule"]: r["bad_rows"] for r in upsert.check_constraints(papers, vecs, log_of(spark, []), 2).collect()}
    assert report == {"papers.pmid unique": 1, "embeddings.pmid unique": 0, "log.id unique": 0, "papers.pmid not null": 0,
                      "papers.title not null": 0, "embeddings.model not null": 0, "embeddings.embedding size": 2,
                      "log.week not null": 0, "embeddings.pmid in papers": 2}


def test_numbers_are_dense(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = number_rows(rows, [F.floor(F.col("v") / 50)], [F.col("v")], "n").collect()
    assert all(r["n"] == r["v"] + 1 for r in got) and len(got) == 1000
    hashed = number_by_hash(rows, F.col("v"), "n", start=11).collect()
    assert sorted(r["n"] for r in hashed) == list(range(11, 1011))


def test_json_lists(spark):
    row = spark.createDataFrame([(["a", 'q"'], None)], "l array<string>, n string")
    coded = row.select(encode_list(F.col("l")).alias("t"), decode_list(F.col("n")).alias("e"))
    assert coded.select("t", decode_list(F.col("t")).alias("b"), "e").first() == ('["a","q\\""]', ["a", 'q"'], [])


def test_first_rule(spark):
    cases = [(["imaging", "sleep"], "gut"), (["none", "Deep SLEEP"], "sleep"), (["none"], "health"), ([], "health"),
             (["muscle protein hypertension"], "heart")]
    frame = spark.createDataFrame([(i, tags) for i, (tags, _) in enumerate(cases)], "i int, tags array<string>")
    got = {r["i"]: r["c"] for r in frame.select("i", rules.first_rule_match(F.col("tags")).alias("c")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    many = [(f"zz{i}", "other") for i in range(200)] + vocab.TAG_RULES
    long = {r["i"]: r["c"] for r in frame.select("i", rules.first_rule_match(F.col("tags"), many).alias("c")).collect()}
    assert long == got


def test_products(spark):
    products = [("blood pressure", "monitor"), ("salt", "stock"), ("protein", "powder")]
    frame = spark.createDataFrame([(1, ["Salt and Blood Pressure", "protein", "salt"]), (2, ["x"])], "i int, k array<string>")
    got = rules.product_match(frame, "k", products).orderBy("i", "rank").collect()
    assert [(r["i"], r["rank"], r["product"]) for r in got] == [(1, 1, "monitor"), (1, 2, "stock"), (1, 3, "powder")]


def test_many_rules_match_as_few(spark):
    import random

    rng = random.Random(3)
    words = ["".join(rng.choice("abç") for _ in range(rng.randrange(0, 6))) for _ in range(300)]
    lists = [[rng.choice(words + [None, "Abç A", "ABC"]) for _ in range(rng.randrange(0, 5))] for _ in range(200)] + [None, []]
    frame = spark.createDataFrame(list(enumerate(lists)), "i int, tags array<string>").repartition(3)
    table = [(w, f"c{i}" if i % 7 else None) for i, w in enumerate(rng.sample([w for w in words if len(w) > 1], 40))] + [("ab", "again")]
    for chosen in (table, table + [("", "all")], [], [("zz", "none")]):
        pair = frame.select("i", rules.first_rule_match(F.col("tags"), chosen).alias("a"),
                            rules.first_rule_match_many(F.col("tags"), chosen).alias("b")).collect()
        assert len(pair) == 202 and all(r["a"] == r["b"] for r in pair)
        few, many = (sorted(map(str, f(frame, "tags", chosen).collect()))
                     for f in (rules.product_match, rules.product_match_many))
        assert few == many


def test_labels(spark):
    name, icon = rules.category_label(F.col("c"))
    got = spark.createDataFrame([("heart",), ("health",), (None,)], "c string").select("c", name.alias("n"), icon.alias("i")).collect()
    assert [(r["n"], r["i"]) for r in got] == [("心臓・血管", "❤️"), ("健康", "📝"), ("健康", "📝")]
