"""From raw documents to token files: quality rules, near copies, leaked benchmark items, source mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. The first four return
the columns of ``documents``; the last one the index of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import mixing, parity_join, pfor, risk_rules, templates
from paperlake.llm.queries import table, tokenizer_path
from paperlake.runtime import work_dir

# the mixture asks for this share of the largest entropy of sources, and repeats nothing
ENTROPY = 0.95


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or a certified cutoff."""
    return risk_rules.reject(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of linked documents.

    Documents without words are no copies of each other. Rows that share a
    doc_id are one document only if their texts are equal, and are then kept
    once; rows without doc_id are kept.
    """
    keep = parity_join.representatives(docs, by_text=True)
    return keep.select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, verbatim or with other values."""
    return templates.remove(docs, table(spark, sf_dir, "benchmark"), verbatim=templates.MIN_TOKENS)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins large sources to one level: the largest mixture at the target entropy that repeats nothing.

    A source under a hundredth of an equal share does not count for the target
    and at least half of the tokens stay, so that small sources limit nothing.
    """
    return mixing.thin(docs, entropy=ENTROPY)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns doc_id, start, n_tokens and ids_crc32 read back from them."""
    return pfor.token_file(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks),
          ("source_mixture", source_mixture), ("token_file", token_file)]

# tokenizers and the component search are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
