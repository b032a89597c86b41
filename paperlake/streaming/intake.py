"""Scheduled intake of XML drops: each run takes the files that arrived since the last one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paperlake import schemas
from paperlake.plans.weekly import prepare_fetched, store_fetched
from paperlake.sources.buckets import BucketedTable, upsert_papers
from paperlake.sources.feeds import CORRUPT, PAPER_XML, parse_paper_xml
from paperlake.sources.tables import read_latest, write_version


def run_intake(spark: SparkSession, drop_dir: str, target: str | BucketedTable, checkpoint: str,
               now: dt.datetime | None = None) -> StreamingQuery:
    """Upsert new files of ``drop_dir`` into the papers table, then stop.

    ``target`` is the root of a versioned table, which is written anew, or a
    bucketed table, of which the touched buckets are. Upserts are keyed, so a
    batch repeated after a failure gives the same table.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        stamp = now or dt.datetime.now(dt.timezone.utc)
        if isinstance(target, BucketedTable):
            fetched = prepare_fetched(parse_paper_xml(batch), stamp)
            upsert_papers(target, fetched.select(*target.schema.fieldNames()), stamp)
            return
        current = read_latest(batch.sparkSession, target, schemas.PAPERS)
        batch = batch.persist()
        write_version(store_fetched(current, parse_paper_xml(batch), stamp), target, ["pub_date", "pmid"])
        batch.unpersist()

    return (spark.readStream.format("xml").option("rowTag", "PubmedArticle").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(PAPER_XML).load(drop_dir)
            .writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
