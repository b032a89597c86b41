import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from paperlake import schemas
from paperlake.operators import upsert
from paperlake.sources import buckets

NOW = dt.datetime(2024, 2, 1)


def files(table):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{table.path}/bucket=*/*.parquet")}


@pytest.fixture
def stored(spark, make_papers, tmp_path):
    table = buckets.BucketedTable(str(tmp_path / "papers"), schemas.PAPERS, buckets=8)
    papers = make_papers([{"pmid": str(i), "title": f"t{i}"} for i in range(60)])
    buckets.create(papers, table)
    return papers, table


def rows(df):
    return sorted(map(str, df.collect()))


def test_other_buckets_keep_their_files(spark, make_papers, stored):
    papers, table = stored
    before = files(table)
    batch = make_papers([{"pmid": "7", "title": "new"}])
    buckets.upsert_papers(table, batch, NOW)
    after = files(table)
    place = spark.createDataFrame([("7",)], "pmid string").select(table.bucket()).first()[0]
    assert {p for p in before if p not in after} == {p for p in before if f"bucket={place}/" in p}
    assert all(after[p] == before[p] for p in before if f"bucket={place}/" not in p) and len(before) == 8
    assert rows(table.read(spark)) == rows(upsert.upsert_papers(papers, batch, NOW))


def test_same_rows_as_the_whole_table(spark, make_papers, stored):
    papers, table = stored
    batch = make_papers([{"pmid": str(i), "title": "changed", "updated_at": dt.datetime(2024, 1, i % 28 + 1)} for i in range(50, 80)]
                        + [{"pmid": "51", "title": "last", "updated_at": dt.datetime(2024, 1, 30)}])
    want = upsert.upsert_papers(papers, batch, NOW)
    buckets.upsert_papers(table, batch, NOW)
    assert rows(table.read(spark)) == rows(want) and table.read(spark).count() == 80
    staged = buckets.upsert_papers(table, batch, NOW)
    once = rows(table.read(spark))
    buckets.publish(staged, table)
    assert rows(table.read(spark)) == once


def test_a_failed_merge_changes_nothing(spark, make_papers, stored):
    _, table = stored
    before = files(table)
    with pytest.raises(Exception):
        buckets.merge_batch(table, make_papers([{"pmid": "1"}]), lambda a, b: a.withColumn("title", F.raise_error(F.lit("no"))))
    assert files(table) == before


def test_only_touched_folders_are_read(spark, stored):
    _, table = stored
    plan = table.scan(spark).filter(F.col("bucket").isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_empty_batch_and_embeddings(spark, make_papers, make_embeddings, stored, tmp_path):
    papers, table = stored
    before = files(table)
    buckets.upsert_papers(table, make_papers([]), NOW)
    assert files(table) == before
    vectors = buckets.BucketedTable(str(tmp_path / "vectors"), schemas.EMBEDDINGS, buckets=4)
    old, new = make_embeddings({"a": [1, 0], "b": [0, 1]}), make_embeddings({"b": [1, 1], "c": [2, 2]}, "m2")
    buckets.create(old, vectors)
    buckets.upsert_embeddings(vectors, new)
    assert rows(vectors.read(spark)) == rows(upsert.upsert_embeddings(old, new))


def test_intake_into_buckets(spark, make_papers, tmp_path):
    from paperlake.streaming.intake import run_intake

    table = buckets.BucketedTable(str(tmp_path / "papers"), schemas.PAPERS, buckets=4)
    buckets.create(make_papers([{"pmid": "1", "title": "old"}, {"pmid": "2", "title": "kept"}]), table)
    article = ("<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article><ArticleTitle>{}</ArticleTitle></Article>"
               "</MedlineCitation></PubmedArticle>")
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "w1.xml").write_text("<S>" + article.format(1, "new") + article.format(3, "fresh") + "</S>")
    for _ in range(2):
        run_intake(spark, str(drop), table, str(tmp_path / "ckpt"), NOW).awaitTermination()
        assert {r["pmid"]: r["title"] for r in table.read(spark).collect()} == {"1": "new", "2": "kept", "3": "fresh"}
