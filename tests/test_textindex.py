import pytest
from pyspark.sql import functions as F

from paperlake.operators import textindex
from paperlake.operators.lookup import keyword_match
from paperlake.runtime import work_dir


@pytest.fixture(scope="module")
def indexed(spark, make_papers):
    rows = [{"pmid": str(i), "title": f"Paper {i} on Sleep", "abstract": f"common words and number {i:04d}",
             "mesh_terms": ["Zebrafish İstanbul", None] if i == 77 else ["mice"]} for i in range(400)]
    rows += [{"pmid": "n", "abstract": None, "mesh_terms": None}, {"pmid": "e"},
             {"pmid": "long", "abstract": "x" * 1_200_000 + "needle😀pin" + "y" * 1_200_000},
             {"pmid": "split", "title": "zebra", "abstract": "afish brafi zebr ebraf"}]
    rows += [{"pmid": "copy", "title": "same rare copies"}] * 60
    papers = make_papers(rows)
    root = work_dir(spark, "textindex")
    textindex.build(papers, root, part_rows=20)
    return papers, root


@pytest.mark.parametrize("word", ["number 0123", "zebrafish", "SLEEP", "needle😀pin", "aaa", "xyy", "no such words", "on", "x", "",
                                  "rare copies", "i̇stan", "%", "mic"])
def test_same_rows_as_a_scan(spark, indexed, word):
    papers, root = indexed
    got = sorted(r["pmid"] for r in textindex.search(spark, root, papers, word).collect())
    assert got == sorted(r["pmid"] for r in papers.filter(keyword_match(word)).collect())


def test_a_rare_keyword_reads_few_parts(spark, indexed):
    papers, root = indexed
    parts = textindex.texts(spark, root, papers).select("part").distinct().count()
    found = textindex.candidates(spark, root, "number 0123").select("part").distinct().count()
    assert parts >= 20 and found == 1 and found < parts / 10
    plan = textindex.search(spark, root, papers, "number 0123")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    text = spark.read.parquet(f"{root}/postings").filter(F.col("bucket") == 3)
    assert "PartitionFilters: [isnotnull(bucket" in text._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, make_papers):
    papers = make_papers([])
    root = work_dir(spark, "textindex")
    textindex.build(papers, root)
    assert textindex.search(spark, root, papers, "sleep").count() == 0
