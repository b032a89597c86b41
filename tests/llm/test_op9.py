import corpus_pipeline as C
from paperlake.llm import queries as Q
from paperlake.llm import templates as T

ITEM = "A train leaves Berlin at 9 and travels 120 km in 2 hours before Anna boards it; how many km does it cover in 5 hours"


def judged(spark, docs, items=((1, ITEM),), **kw):
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return [(r["contaminated"], r["item_id"], r["changed"]) for r in T.judge(frame, bench, **kw).orderBy("doc_id").collect()]


def test_verbatim_and_reparameterised(spark, prose):
    around = lambda x: f"{prose(1, 30)}. {x}. {prose(2, 30)}"
    other = ITEM.replace("Berlin", "Paris").replace("120", "300").replace("Anna", "Hugo").replace(" 9 ", " 11 ").replace("2 hours", "3 minutes").replace("5 hours", "7 minutes")
    lower = ITEM.lower()
    half = " ".join(ITEM.split()[:13])
    # the same value of the item stands for two values: not the same question
    mixed = "A train leaves Paris at 9 and travels 9 km in 2 hours before Anna boards it; how many km does it cover in 5 hours"
    twice = "A train leaves Berlin at 9 and travels 9 km in 9 hours before Anna boards it; how many km does it cover in 9 hours"
    got = judged(spark, [around(ITEM), around(other), around(lower), around(half), prose(3, 200), " ".join(ITEM.split()[:7]), None, ""])
    assert [g[0] for g in got] == [True, True, True, True, False, False, False, False]
    assert [g[2] for g in got[:4]] == [False, True, False, False]
    inconsistent = twice.replace("travels 9", "travels 4").replace("in 9 hours", "in 8 hours", 1)
    assert [g[0] for g in judged(spark, [around(inconsistent), around(twice.replace("9", "6")), around(mixed)], [(1, twice)])] == [False, True, False]


def test_verbatim_runs_beside_mixed_slots(spark, tmp_path, prose):
    """One of two equal numbers changed, all else word for word: the query and the pipeline find it."""
    item = "A train leaves Berlin at 9 and travels on for 9 more of the long winter hours before Anna boards it at the green river"
    near = item.replace("for 9", "for 4")
    docs = [(1, f"{prose(1, 30)}. {near}. {prose(2, 30)}"), (2, prose(3, 80))]
    sf = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(sf + "/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(sf + "/benchmark.parquet")
    rows = {r["doc_id"]: (r["contaminated"], r["item_id"], r["changed"]) for r in Q.op9_template_leaks(spark, sf).collect()}
    assert rows == {1: (True, 1, True), 2: (False, None, False)}
    kept = C.benchmark_leaks(spark, spark.read.parquet(sf + "/documents.parquet"), sf)
    assert [r["doc_id"] for r in kept.collect()] == [2]


def test_whole_numbers_names_and_openers(spark, prose):
    around = lambda x: f"{prose(1, 30)}. {x} {prose(2, 30)}"
    item = "Janet sells fresh eggs at the market for 1,250 a day. Janet eats three of them for breakfast with Anna and bakes muffins for friends."
    short = item.replace("1,250", "75")
    long = item.replace("Anna", "Maria Lopez").replace("1,250", "3.5")
    other = item.replace("Janet", "Hugo")
    all_three = long.replace("Janet", "Karla Maria")
    got = judged(spark, [around(x) for x in (item, short, long, other, all_three)] + [prose(5, 90)], [(1, item)])
    assert got == [(True, 1, False)] + [(True, 1, True)] * 4 + [(False, None, False)]
    dense = "Janet eats 3 for breakfast at home. Janet sells 16 to 4 friends daily."
    assert judged(spark, [around(dense.replace("Janet", "Hugo").replace("16", "1,250"))], [(1, dense)]) == [(True, 1, True)]


def test_short_items_and_ties(spark, prose):
    items = [(3, "one two three"), (4, "one two three"), (5, None), (None, ITEM), (6, "")]
    got = judged(spark, ["One, two three", "zero one two three four", prose(4, 20)], items)
    assert got == [(True, 3, False), (False, None, False), (False, None, False)]


def test_odd_documents(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string").selectExpr("*", "1 name", "2 pos", "3 doc")
    rows = T.judge(odd_documents, bench).collect()
    assert len(rows) == odd_documents.count() and not any(r["contaminated"] for r in rows)
    own = odd_documents.filter("doc_id = 1").selectExpr("doc_id item_id", "text")
    assert sorted(r["doc_id"] or 0 for r in T.judge(odd_documents, own).collect() if r["contaminated"]) == [0, 1, 5, 6]  # 5 holds 40 words of it
    kept = T.remove(odd_documents, own)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 4
    assert T.judge(no_documents, bench).count() == 0 and not any(r["contaminated"] for r in T.judge(odd_documents, bench.limit(0)).collect())


def test_rows_with_equal_short_hashes(spark, clashing_texts):
    short, long = clashing_texts
    docs = spark.createDataFrame([(None, short), (None, long)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    assert [r["text"] for r in T.remove(docs, bench).collect()] == [short]
