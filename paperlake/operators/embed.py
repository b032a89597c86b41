"""Turning text into vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.functions import text as T

DIMENSION = 384
BATCH = 32


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bucket(token: Column, dim: int) -> Column:
    """Slot of a token: the first 32 bits of its md5, modulo the dimension."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % dim


def hash_embed(df: DataFrame, text: str, dim: int = DIMENSION, out: str = "embedding") -> DataFrame:
    """Model-free encoder: counts of hashed tokens, scaled to length 1.

    Built from Spark's own count vectorizer with the slots as vocabulary: no
    Python, no shuffle, one pass over the text.
    """
    slots = F.transform(tokens(F.col(text)), lambda t: bucket(t, dim).cast("string"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_slots",
                                                   outputCol="_counts")
    scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit")
    counted = scaled.transform(counter.transform(df.withColumn("_slots", slots)))
    return (counted.withColumn(out, vector_to_array("_unit", "float32"))
            .drop("_slots", "_counts", "_unit"))


def with_embedding_text(papers: DataFrame, out: str = "embedding_text") -> DataFrame:
    return papers.withColumn(out, T.embedding_text(F.col("title"), F.col("abstract"), F.col("mesh_terms"),
                                                   F.col("category")))


def embed_papers(papers: DataFrame, model: str = "hash-384", now=None,
                 encode: Callable[[DataFrame, str], DataFrame] = hash_embed,
                 partitions: int | None = None) -> DataFrame:
    """Embedding rows of papers. ``encode(df, text_column)`` adds ``embedding``.

    Encoding is the costly step: ``partitions`` spreads it over more tasks than
    the input has, for inputs of few large files.
    """
    created = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    narrow = papers.select("pmid", "title", "abstract", "mesh_terms", "category")
    spread = narrow.repartition(partitions) if partitions else narrow
    return (encode(with_embedding_text(spread), "embedding_text")
            .select("pmid", "embedding", F.lit(model).alias("model"), created.alias("created_at")))


def embed_text(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], np.ndarray]],
               batch_size: int = BATCH, out: str = "embedding") -> DataFrame:
    """Encode a text column with any model.

    ``factory`` loads the model once per task; the encoder it returns gets
    ``batch_size`` texts at a time and gives one row per text. Vectors are
    scaled to length 1 and stored as float32.
    """

    @F.pandas_udf("array<float>")
    def encode(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for texts in series:
            values = texts.fillna("").tolist()
            rows = []
            for start in range(0, len(values), batch_size):
                block = np.asarray(encoder(values[start:start + batch_size]), dtype=np.float64)
                size = np.linalg.norm(block, axis=1, keepdims=True)
                rows.extend((block / np.where(size == 0, 1, size)).astype(np.float32))
            yield pd.Series(rows)

    return df.withColumn(out, encode(F.col(text)))


def embed_query(spark, query: str, dim: int = DIMENSION) -> Column:
    """Vector of a search text, to be given to ``similar_topk``."""
    one = spark.range(1).select(F.lit(query).alias("q"))
    return hash_embed(one, "q", dim).select("embedding").scalar()
