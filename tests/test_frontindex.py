import glob
import os

import pytest
from pyspark.sql import functions as F

from paperlake.operators.upsert import upsert_index_front
from paperlake.sources import frontindex

ARRIVALS = "slug string, title string, pos long"


@pytest.fixture
def stored(spark, tmp_path):
    index = spark.createDataFrame([(f"s{i}", f"t{i}", i) for i in range(50)], ARRIVALS)
    table = frontindex.FrontIndex(str(tmp_path / "index"), index.drop("pos").schema)
    frontindex.create(index, table)
    return index, table


def files(table):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{table.root}/batch=*/*.parquet")}


def listed(df):
    return [tuple(r) for r in df.orderBy("pos").select("pos", "slug", "title").collect()]


def test_same_order_as_renumbering_all(spark, stored):
    index, table = stored
    batches = [[("s7", "again", 1), ("new", "n", 2), ("new", "newer", 3), ("odd", "o", None)],
               [("s7", "third", 5), ("s0", "zero", 5_000_000)], [("s49", "a", -4), ("new", "b", 0)]]
    for number, rows in enumerate(batches, 1):
        arrivals = spark.createDataFrame(rows, ARRIVALS)
        index = upsert_index_front(index, arrivals, block=3)
        frontindex.push_front(table, arrivals, number)
    assert listed(frontindex.export(spark, table, block=3)) == listed(index)
    smaller = frontindex.compact(spark, table, table.root + "-2")
    assert smaller.scan(spark).count() == index.count() < table.scan(spark).count()
    assert listed(frontindex.export(spark, smaller)) == listed(index)


def test_a_batch_writes_itself_only(spark, stored, monkeypatch):
    _, table = stored
    frontindex.push_front(table, spark.createDataFrame([("s1", "x", 1)], ARRIVALS), 1)
    before = files(table)
    monkeypatch.setattr(frontindex.FrontIndex, "scan", None)
    frontindex.push_front(table, spark.createDataFrame([("s1", "y", 1), ("s2", "y", 2)], ARRIVALS), 2)
    after = files(table)
    assert all(after[p] == t for p, t in before.items())
    assert {os.path.basename(os.path.dirname(p)) for p in set(after) - set(before)} == {"batch=2"}


def test_repeats_nulls_and_empty_batches(spark, stored):
    _, table = stored
    batch = spark.createDataFrame([(None, "no slug", 1), ("s3", None, None)], ARRIVALS).withColumn("extra", F.lit(1))
    frontindex.push_front(table, batch, 1)
    once = listed(frontindex.export(spark, table))
    frontindex.push_front(table, batch, 1)
    frontindex.push_front(table, batch.limit(0), 2)
    assert listed(frontindex.export(spark, table)) == once
    assert once[:3] == [(1, "s3", None), (2, None, "no slug"), (3, "s0", "t0")] and len(once) == 51
    with pytest.raises(ValueError):
        frontindex.push_front(table, batch, 0)
