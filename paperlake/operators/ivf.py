"""An index for vector search: inverted lists around trained centroids, with product codes.

A vector belongs to the list of its closest centroid. What is left of it is cut
into parts, and each part is stored as the number of its closest codeword, one
byte. A search visits the lists nearest to the query, ranks their rows by the
product with the decoded vectors, which needs the codes only, and compares the
best ``shortlist`` rows with their full vectors.

The index is a table (``list``, ``id``, ``codes``, ``vec``, ...) sorted by list,
beside the small table of centroids and codewords. A search for one vector
reads the row groups of the probed lists; a search for many reads ids and codes,
and vectors only for the shortlists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import kernels
from paperlake.functions.vectors import cosine, literal_vector
from paperlake.operators.cells import BLOCK_ROWS, to_rect_cells
from paperlake.operators.similar import _expand, _vector_groups, vector_key
from paperlake.runtime import work_dir

SAMPLE_PER_LIST = 64
ROUNDS = 12


@dataclass
class Model:
    coarse: np.ndarray  # (lists, dim)
    books: np.ndarray  # (parts, codewords, dim / parts)


@dataclass
class Index:
    model: Model
    rows: DataFrame  # list, id, codes, vec, ids, vkey; one row per distinct vector
    members: DataFrame  # pmid, vkey


def train(embeddings: DataFrame, lists: int, parts: int = 16, codewords: int = 256, sample_per_list: int = SAMPLE_PER_LIST,
          seed: int = 42) -> Model:
    """Centroids and codewords from a sample.

    The sample has about ``sample_per_list`` vectors for each list, or for each
    codeword if these are more, chosen by hash of the vector, and is all that
    reaches the driver. It only steers the search: every row is indexed.
    """
    wanted = sample_per_list * max(lists, codewords)
    known = embeddings.filter(F.exists("embedding", lambda x: x != 0)).select("embedding", F.xxhash64("embedding").alias("key"))
    keys = known.select("key").distinct()
    count = keys.count()
    if not count:
        raise ValueError("no vectors to train on")
    share = F.pmod("key", F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted / count))
    picked = known.filter(share).groupBy("key").agg(F.first("embedding").alias("vec"))
    table = picked.orderBy("key").select("vec").toArrow()
    unit = kernels.matrix(table.column("vec"))
    if unit.shape[1] % parts:
        raise ValueError(f"{parts} parts do not divide {unit.shape[1]} dimensions")
    coarse = kernels.lloyd(unit, lists, ROUNDS, seed)
    rest = (unit - coarse[kernels.nearest_rows(unit, coarse)]).reshape(len(unit), parts, -1)
    return Model(coarse, np.stack([kernels.lloyd(rest[:, m], min(codewords, 256), ROUNDS, seed + m) for m in range(parts)]))


def encode(vectors: DataFrame, model: Model) -> DataFrame:
    """``vectors`` (with ``vec``) and the list and codes of each row."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("codes", T.BinaryType())])
    return vectors.mapInArrow(kernels.inverted_rows(model.coarse, model.books), schema)


def write_index(embeddings: DataFrame, model: Model, path: str, keep: int = 6) -> None:
    """Stores the inverted lists and the model below ``path``.

    Copies of a vector are one row with their ``keep`` lowest ids. Null and
    zero vectors and vectors of another length than the model's are left out.
    """
    spark = embeddings.sparkSession
    groups, _ = _vector_groups(embeddings.filter(F.size("embedding") == model.coarse.shape[1]), keep)
    encode(groups, model).repartitionByRange("list", "id").sortWithinPartitions("list", "id").write.parquet(f"{path}/lists")
    numbers = [("coarse", i, row.tolist()) for i, row in enumerate(model.coarse)]
    numbers += [(f"part {m}", i, row.tolist()) for m, book in enumerate(model.books) for i, row in enumerate(book)]
    spark.createDataFrame(numbers, "kind string, place int, numbers array<double>").coalesce(1).write.parquet(f"{path}/model")


def read_index(spark: SparkSession, path: str, embeddings: DataFrame) -> Index:
    """The stored index of ``embeddings``, which give the ids of all copies."""
    stored = sorted(map(tuple, spark.read.parquet(f"{path}/model").collect()))
    coarse = np.array([x for kind, _, x in stored if kind == "coarse"])
    parts = len({kind for kind, *_ in stored}) - 1
    books = np.array([[x for kind, _, x in stored if kind == f"part {m}"] for m in range(parts)])
    members = embeddings.filter(F.exists("embedding", lambda x: x != 0)).select(
        "pmid", vector_key().alias("vkey"))
    return Index(Model(coarse, books), spark.read.parquet(f"{path}/lists"), members)


def _queries(index: Index, asked: Column | None) -> DataFrame:
    rows = index.rows.select("id", "vec", "vkey")
    if asked is not None:
        rows = rows.join(index.members.filter(asked).select("vkey").distinct(), "vkey", "left_semi")
    return rows.select("id", "vec")


def shortlist(index: Index, queries: DataFrame, probes: int, size: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, neighbour): the ``size`` best rows of the probed lists by their codes, for every query.

    Lists are dealt to shards of about ``block_rows`` rows, and a query visits
    the shards that hold one of its lists. Hot lists and crowds of queries are
    cut into blocks. The shards and blocks change no result.
    """
    model = index.model
    shards = int(index.rows.agg(F.greatest(F.lit(1), F.least(F.lit(len(model.coarse)), F.ceil(F.count(F.lit(1)) / block_rows)))).first()[0])
    codes = index.rows.select("id", F.lit(None).cast("array<float>").alias("vec"), "list", "codes", F.pmod("list", F.lit(shards)).alias("shard"))
    asking = queries.mapInArrow(kernels.shard_visits(model.coarse, probes, shards), "id string, vec array<float>, shard int").select(
        "id", "vec", F.lit(None).cast("int").alias("list"), F.lit(None).cast("binary").alias("codes"), "shard")
    cells = to_rect_cells(asking, codes, "shard", "id", block_rows)
    near = cells.mapInArrow(kernels.shortlists(model.coarse, model.books, probes, size), "id string, neighbour string, similarity double")
    best = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return near.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= size).select("id", "neighbour")


def _compared(index: Index, queries: DataFrame, listed: DataFrame) -> DataFrame:
    """Exact similarity of the listed pairs."""
    full = index.rows.select(F.col("id").alias("neighbour"), F.col("vec").alias("_other"))
    return (listed.join(full, "neighbour").join(queries, "id")
            .select("id", "neighbour", cosine(F.col("vec"), F.col("_other")).alias("similarity")))


def index_topk(index: Index, top_k: int = 5, probes: int = 8, size: int = 40, asked: Column | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """pmid, rank, related, similarity: approximate top-k of every paper, or of those for which ``asked`` holds.

    The answer depends on the vectors, the model, ``probes`` and ``size``
    alone. ``size`` is at least ``top_k``.
    """
    queries = _queries(index, asked)
    near = _compared(index, queries, shortlist(index, queries, probes, max(size, top_k), block_rows))
    found = _expand(index.rows.select("id", "vkey", "ids"), index.members, near, top_k)
    return found if asked is None else found.filter(asked)


def index_costs(index: Index, probes: int, size: int, asked: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row with the shares of all (query, row) pairs that a search decodes (``scanned``) and compares in full (``compared``)."""
    queries = _queries(index, asked)
    sizes = index.rows.groupBy("list").count()
    visits = queries.mapInArrow(kernels.list_visits(index.model.coarse, probes), "list int, visits bigint").groupBy("list").agg(F.sum("visits").alias("visits"))
    pairs = queries.agg(F.count(F.lit(1)).alias("q")).select((F.col("q") * index.rows.agg(F.count(F.lit(1)).alias("n")).scalar()).alias("pairs"))
    scanned = sizes.join(visits, "list").agg(F.coalesce(F.sum(F.col("count") * F.col("visits")), F.lit(0)).alias("scanned"))
    compared = shortlist(index, queries, probes, size, block_rows).agg(F.count(F.lit(1)).alias("compared"))
    return pairs.select(F.try_divide(scanned.scalar(), F.col("pairs")).alias("scanned"), F.try_divide(compared.scalar(), F.col("pairs")).alias("compared"))


def nearest(index: Index, query, top_k: int = 10, probes: int = 8, size: int = 100) -> DataFrame:
    """pmid and similarity of the ``top_k`` rows nearest to one vector, approximately.

    Only the probed lists are read: their numbers are a filter on the column
    the table is sorted by. A null, zero or wrongly sized vector finds nothing.
    """
    model = index.model
    spark = index.rows.sparkSession
    vector = np.asarray(query if query is not None else [], dtype=np.float64)
    if vector.shape != (model.coarse.shape[1],) or not vector.any():
        return spark.createDataFrame([], "pmid string, similarity double")
    lists = np.flatnonzero(kernels.probed_lists(vector[None, :] / np.linalg.norm(vector), model.coarse, probes)[0]).tolist()
    part = index.rows.filter(F.col("list").isin(lists))
    wanted = max(size, top_k)
    short = (part.select("id", "list", "codes").mapInArrow(kernels.shortlist_of(vector, model.coarse, model.books, wanted), "id string, similarity double")
             .orderBy(F.desc("similarity"), "id").limit(wanted).select(F.col("id").alias("neighbour")))
    full = part.select(F.col("id").alias("neighbour"), "vec", "vkey").join(F.broadcast(short), "neighbour")
    best = (full.select("vkey", cosine(F.col("vec"), literal_vector(vector.tolist())).alias("similarity"))
            .orderBy(F.desc("similarity")).limit(max(size, top_k)))
    return (index.members.join(F.broadcast(best), "vkey").select("pmid", "similarity")
            .orderBy(F.desc("similarity"), "pmid").limit(top_k))


def build(embeddings: DataFrame, model: Model, purpose: str = "vector-index", keep: int = 6) -> Index:
    """Writes the index below the work folder and opens it."""
    path = work_dir(embeddings.sparkSession, purpose)
    write_index(embeddings, model, path, keep)
    return read_index(embeddings.sparkSession, path, embeddings)
