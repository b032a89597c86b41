"""Key-based upserts, log appends and constraint reports.

All functions return the new table; writing it is the caller's step (see
``sources.tables``), so a failed job never leaves a half-changed table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions import text as T
from paperlake.operators.numbering import number_by_hash, number_rows
from paperlake.operators.rules import first_rule_match


def latest_by_key(rows: DataFrame, key: str, arrival: list[Column]) -> DataFrame:
    """Last arrived row of every key. Spark cuts each key to one row before the shuffle."""
    newest = Window.partitionBy(key).orderBy(*arrival)
    return rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def replace_by_key(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key comes again, add the new ones (unique by key)."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def upsert_papers(existing: DataFrame, incoming: DataFrame, now, key: str = "pmid",
                  arrival: list[Column] | None = None) -> DataFrame:
    """Insert new papers; for known ones replace all but the key and ``created_at``.

    The stored table is on the streamed side of both joins, so for a usual
    small batch Spark broadcasts the batch and the table is not shuffled; a
    large batch falls back to a sort-merge join by the optimizer's size check.
    The batch is used three times; give one that is cheap to read.
    """
    now = F.lit(now).cast("timestamp")
    new = latest_by_key(incoming, key, arrival or [F.desc_nulls_last("updated_at")])
    fields = [c for c in existing.columns if c not in (key, "created_at", "updated_at")]
    changed = new.select(key, F.struct(*fields).alias("_new"))

    def merged(name: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)

    updated = existing.join(changed, key, "left").select(
        *(F.when(F.col("_new").isNotNull(), now).otherwise(F.col(c)).alias(c) if c == "updated_at"
          else merged(c) if c in fields else F.col(c) for c in existing.columns))
    known = existing.select(key).join(new.select(key), key, "left_semi")
    fresh = (new.join(known, key, "left_anti")
             .withColumn("created_at", F.coalesce("created_at", now))
             .withColumn("updated_at", F.coalesce("updated_at", now)))
    return updated.unionByName(fresh.select(*existing.columns))


def ingest_papers(existing: DataFrame, incoming: DataFrame, now,
                  arrival: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Upsert a batch; also, as a table of one row, the number of rows processed, repeats included.

    No job runs until one of the two is used.
    """
    return upsert_papers(existing, incoming, now, arrival=arrival), processed_count(incoming)


def processed_count(incoming: DataFrame) -> DataFrame:
    return incoming.agg(F.count(F.lit(1)).alias("processed"))


def upsert_embeddings(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace vector, model and time of known ids, add the others."""
    return replace_by_key(existing, latest_by_key(incoming, "pmid", [F.desc_nulls_last("created_at")]), "pmid")


def append_log(log: DataFrame, entries: DataFrame, now, arrival: str | None = None,
               block: int = 10_000) -> DataFrame:
    """Log with the entries added, their ids following the highest one.

    Ids go by the integer column ``arrival``, entries without one first; without
    the column the batch has no order and ids are dealt out by a hash of slug
    and sources.
    """
    last = log.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    stamped = (entries.withColumn("created_at", F.coalesce("created_at", F.lit(now).cast("timestamp")))
               .drop("id"))
    if arrival is None:
        key = F.concat_ws("|", "week", "article_slug", F.array_join("source_pmids", ","))
        numbered = number_by_hash(stamped, key, start=last + 1)
    else:
        numbered = number_rows(stamped, [F.floor(F.col(arrival) / block)], [F.col(arrival)], start=last + 1)
    return log.unionByName(numbered.select(*log.columns))


def index_rows(papers: DataFrame) -> DataFrame:
    """Search-index rows of papers: the first 200 characters describe them."""
    return papers.select(
        F.coalesce("slug", "pmid").alias("slug") if "slug" in papers.columns else F.col("pmid").alias("slug"),
        "title", T.prefix(F.col("abstract"), 200).alias("description"), "category",
        F.col("mesh_terms").alias("tags"), "pub_date", "url")


def index_entries(columns: DataFrame, generated: str = "parsed", tag_rules=tuple(vocab.TAG_RULES)) -> DataFrame:
    """Search-index entries of generated columns and the papers they rest on.

    Expects ``slug``, ``mesh_terms``, ``pub_date`` and the generated record as a
    struct. The category comes from the tags of the paper by ``tag_rules``.
    """
    return columns.select(
        "slug", F.col(f"{generated}.title").alias("title"), F.col(f"{generated}.lead").alias("description"),
        first_rule_match(F.col("mesh_terms"), tag_rules).alias("category"),
        F.coalesce(F.col(f"{generated}.affiliate_keywords"), F.array().cast("array<string>")).alias("tags"),
        F.col("pub_date").cast("string").alias("date"),
        F.concat(F.lit("/article/"), "slug", F.lit("/")).alias("url"))


def replace_index_rows(index: DataFrame, papers: DataFrame) -> DataFrame:
    return replace_by_key(index, latest_by_key(index_rows(papers), "slug", [F.desc_nulls_last("pub_date")]), "slug")


def upsert_index_front(index: DataFrame, arrivals: DataFrame, block: int = 10_000) -> DataFrame:
    """Put arrivals in front, latest first, drop their older entries, renumber ``pos``.

    ``index.pos`` is the present place of an entry, ``arrivals.pos`` the order
    of arrival. Entries without ``pos`` come first in their part.
    """
    newest = latest_by_key(arrivals, "slug", [F.desc("pos")])
    front = newest.withColumn("_part", F.lit(0)).withColumn("_place", -F.col("pos"))
    rest = (index.join(newest.select("slug"), "slug", "left_anti")
            .withColumn("_part", F.lit(1)).withColumn("_place", F.col("pos")))
    both = front.unionByName(rest).drop("pos")
    bucket = [F.col("_part"), F.floor(F.col("_place") / block)]
    return number_rows(both, bucket, [F.col("_part"), F.col("_place")], "pos").drop("_part", "_place")


def table_counts(**tables: DataFrame) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def check_constraints(papers: DataFrame, embeddings: DataFrame, log: DataFrame, dim: int,
                      sources: DataFrame | None = None, search_index: DataFrame | None = None) -> DataFrame:
    """Rows breaking each rule of the data model, one report row per rule.

    The rules of ``sources`` and ``search_index`` are reported for the tables that are given.
    """
    def repeated(df, key, name):
        return (df.groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                .agg(F.count(F.lit(1)).alias("bad_rows"))
                .select(F.lit(name).alias("rule"), "bad_rows"))

    def broken(df, tests: dict[str, Column]):
        report = F.array(*(F.struct(F.lit(name).alias("rule"), F.count_if(test).alias("bad_rows"))
                           for name, test in tests.items()))
        return df.agg(report.alias("r")).select(F.inline("r"))

    orphans = (embeddings.select("pmid").join(papers.select("pmid"), "pmid", "left_anti")
               .agg(F.count(F.lit(1)).alias("bad_rows"))
               .select(F.lit("embeddings.pmid in papers").alias("rule"), "bad_rows"))
    parts = [
        repeated(papers, "pmid", "papers.pmid unique"),
        repeated(embeddings, "pmid", "embeddings.pmid unique"),
        repeated(log, "id", "log.id unique"),
        broken(papers, {"papers.pmid not null": F.col("pmid").isNull(),
                        "papers.title not null": F.col("title").isNull()}),
        broken(embeddings, {"embeddings.model not null": F.col("model").isNull(),
                            "embeddings.embedding size": F.coalesce(F.size("embedding") != dim, F.lit(True))}),
        broken(log, {"log.week not null": F.col("week").isNull()}),
        orphans,
    ]
    if sources is not None:
        parts += [repeated(sources, "id", "sources.id unique"),
                  broken(sources, {f"sources.{c} not null": F.col(c).isNull() for c in ("category", "name", "url")})]
    if search_index is not None:
        parts += [repeated(search_index, "slug", "search_index.slug unique"),
                  broken(search_index, {"search_index.title not null": F.col("title").isNull()})]
    return reduce(DataFrame.unionByName, parts)
