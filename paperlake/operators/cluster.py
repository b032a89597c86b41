"""k-means clusters of papers and their summaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paperlake import kernels
from paperlake.runtime import MAX_INLINE_ROWS, cut_lineage

# a centre that moves less than this share of the largest coordinate stands still
STILL = 1e-12


def _seeds(vectors: DataFrame, n_clusters: int, n_init: int, seed: int, pool: int) -> np.ndarray:
    """First centres of every run, (runs, k, width); fewer than ``n_clusters`` if a run's pool holds fewer vectors.

    The pool of a run are the ``pool * n_clusters`` ids with the lowest keyed
    hashes. Its lowest is the first centre, and each next one is farthest from
    those before it, the lower hash among equally far ones.
    """
    keyed = F.md5(F.concat_ws(":", F.lit(seed), "run", "pmid"))
    order = Window.partitionBy("run").orderBy("key", "pmid")
    # Spark cuts every task's rows to the pool before this shuffle of hashes (window group limit)
    pools = (vectors.select("pmid", F.explode(F.sequence(F.lit(0), F.lit(n_init - 1))).alias("run"))
             .withColumn("key", keyed).withColumn("place", F.row_number().over(order))
             .filter(F.col("place") <= pool * n_clusters)
             .groupBy("run", "pmid").agg(F.min("place").alias("place")))
    # at most n_init * pool * n_clusters ids; several rows of one id count as one
    chosen = (vectors.join(F.broadcast(pools), "pmid").groupBy("run", "place").agg(F.min("embedding").alias("embedding"))
              .orderBy("run", "place").toArrow())
    run = chosen.column("run").to_numpy()
    points = kernels.double_rows(chosen.column("embedding"))
    picks = [kernels.far_apart(points[run == r], n_clusters) for r in range(n_init)]
    k = min(len(pick) for pick in picks)
    return np.array([pick[:k] for pick in picks])


def _moved(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(costs, next centres) of all runs from one pass over the vectors; a centre without vectors stays.

    Tasks add up their own vectors and Spark adds the sums, so the driver gets
    one row for every run and centre, whatever the size of the table.
    """
    sums = (vectors.select("embedding").mapInArrow(kernels.centre_sums(centres), kernels.CENTRE_SUMS)
            .select("run", "label", "n", "cost", F.posexplode("total").alias("pos", "x"))
            .groupBy("run", "label", "pos").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("x").alias("x"))
            .toArrow())
    run, label, pos = (sums.column(c).to_numpy() for c in ("run", "label", "pos"))
    after, costs = centres.copy(), np.zeros(len(centres))
    after[run, label, pos] = sums.column("x").to_numpy() / sums.column("n").to_numpy()
    first = pos == 0
    np.add.at(costs, run[first], sums.column("cost").to_numpy()[first])
    return costs, after


def k_means(vectors: DataFrame, n_clusters: int = 5, n_init: int = 10, seed: int = 42, rounds: int = 30,
            pool: int = 8) -> np.ndarray:
    """Centres, (k, width), of the cheapest of ``n_init`` runs after at most ``rounds`` passes over ``vectors``.

    All runs share a pass: it reads the vectors once, compares them with the
    centres of every run that still moves, and gives the cost of those centres
    and the means that follow them. Runs that stand still take no further
    part. The cost of the last centres evaluated decides, ties going to the
    lower run. There is no table of distance bounds: for ten runs it would be
    as wide as the vectors and rewritten in every pass.
    """
    centres = _seeds(vectors, n_clusters, n_init, seed, pool)
    if centres.size == 0:
        return np.zeros((0, 0))
    costs = np.zeros(len(centres))
    active = np.arange(len(centres))
    for _ in range(rounds):
        costs[active], after = _moved(vectors, centres[active])
        still = np.abs(after - centres[active]).max(axis=(1, 2)) <= STILL * np.abs(after).max()
        if still.all():
            break
        last = centres.copy()
        centres[active[~still]] = after[~still]
        active = active[~still]
    else:
        centres = last
    return centres[int(np.argmin(costs))]


def cluster_papers(embeddings: DataFrame, n_clusters: int = 5, min_cluster_size: int = 2,
                   n_init: int = 10, seed: int = 42, rounds: int = 30) -> DataFrame:
    """(cluster_id, pmid) of clusters with at least ``min_cluster_size`` papers.

    The cheapest of ``n_init`` seeded runs is kept (:func:`k_means`). Clusters
    are numbered by their lowest paper id, so numbers do not depend on the
    run. Rows without a vector belong to no cluster; no vectors give no rows,
    and where a run's pool holds fewer different vectors than clusters, there
    are as many clusters as vectors.
    """
    vectors = embeddings.filter(F.size("embedding") > 0).select("pmid", "embedding")
    centres = k_means(vectors, n_clusters, n_init, seed, rounds)
    labels = StructType([vectors.schema["pmid"], StructField("label", LongType())])
    labelled = cut_lineage(vectors.mapInArrow(kernels.centre_labels(centres), labels), "labels")
    # one row per cluster
    sizes = (labelled.groupBy("label").agg(F.count(F.lit(1)).alias("_n"), F.min("pmid").alias("_first"))
             .filter(F.col("_n") >= min_cluster_size)
             .select("label", (F.row_number().over(Window.orderBy("_first")) - 1).alias("cluster_id")))
    return labelled.join(F.broadcast(sizes), "label").select("cluster_id", "pmid")


def cluster_summary(clusters: DataFrame, papers: DataFrame, top_categories: int = 3,
                    representatives: int = 3) -> DataFrame:
    """Size, commonest categories, lowest ids and their titles, per cluster."""
    rows = clusters.join(papers.select("pmid", "title", "category"), "pmid", "left")
    sizes = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    by_count = Window.partitionBy("cluster_id").orderBy(F.desc("n"), "category")
    categories = (rows.filter(F.col("category") != "").groupBy("cluster_id", "category")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("rn", F.row_number().over(by_count)).filter(F.col("rn") <= top_categories)
                  .groupBy("cluster_id")
                  .agg(F.sort_array(F.collect_list(F.struct("rn", "category", "n"))).alias("c")))
    by_id = Window.partitionBy("cluster_id").orderBy("pmid")
    first = (rows.withColumn("rn", F.row_number().over(by_id)).filter(F.col("rn") <= representatives)
             .groupBy("cluster_id")
             .agg(F.sort_array(F.collect_list(F.struct("rn", "pmid", "title"))).alias("r")))
    return (sizes.join(categories, "cluster_id", "left").join(first, "cluster_id")
            .select("cluster_id", "size",
                    F.transform(F.coalesce("c", F.array()), lambda x: F.struct(x["category"], x["n"]))
                    .alias("top_categories"),
                    F.transform("r", lambda x: x["pmid"]).alias("representative_pmids"),
                    F.transform("r", lambda x: x["title"]).alias("titles")))


def centroids_by(vectors: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Mean vector of every label, as (cid, centroid)."""
    return (vectors.select(F.col(label).alias("cid"), F.posexplode(vector).alias("pos", "x"))
            .groupBy("cid", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
            .groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("c"))
            .select("cid", F.transform("c", lambda s: s["m"]).alias("centroid")))


def _assigned(vectors: DataFrame, centroids: DataFrame, block_rows: int = MAX_INLINE_ROWS) -> DataFrame:
    """(pmid, embedding, cid, distance) by the closest centroid, ties to the lower id.

    The centroids are written and counted, and go to the tasks in blocks of at
    most about ``block_rows``. Every block is a step of one scan: it gets the
    vectors with their best centroid so far and compares those centroids in
    full that the leading coordinates do not rule out. Nothing is joined or
    shuffled.
    """
    kept = cut_lineage(centroids.select("cid", "centroid"), "centroids")
    blocks = max(1, -(-kept.count() // block_rows))
    part = F.pmod(F.xxhash64("cid"), F.lit(blocks))
    found = vectors.select("pmid", "embedding", F.lit(None).cast(kept.schema["cid"].dataType).alias("cid"),
                           F.lit(None).cast("double").alias("distance"))
    for i in range(blocks):
        block = kept.filter(part == i).orderBy("cid").toArrow()
        found = found.mapInArrow(kernels.closer_centroids(block), found.schema)
    return found.withColumn("distance", F.sqrt("distance"))


def nearest_centroid(vectors: DataFrame, centroids: DataFrame, block_rows: int = MAX_INLINE_ROWS) -> DataFrame:
    """(pmid, cid, distance): every vector's closest centroid, ties to the lower id; both null for rows without a vector."""
    return _assigned(vectors, centroids, block_rows).select("pmid", "cid", "distance")


def cluster_steps(vectors: DataFrame, centroids: DataFrame, steps: int) -> DataFrame:
    """(pmid, cid, distance) after ``steps`` rounds of k-means from given centroids.

    A round assigns every vector and moves each centroid to the mean of its
    vectors; a centroid without vectors goes. Unlike :func:`cluster_papers`
    nothing is random.
    """
    for _ in range(steps):
        centroids = cut_lineage(centroids_by(_assigned(vectors, centroids), "cid"), "centroids")
    return nearest_centroid(vectors, centroids)
