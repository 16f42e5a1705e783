"""Density clusters of product vectors: neighbour graph, spanning tree, stable clusters of its hierarchy."""

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.vectors import has_vector
from assortment.operators import condense, knn
from assortment.operators.components import connected_components
from assortment.operators.spanning import spanning_forest, spanning_tree
from assortment.sources.lineage import cut, shuffled

ALGORITHM = "reachability-tree"
SEARCHED_CELLS = 8


def reduce_dims(vectors: DataFrame, dim: int = fixed.REDUCED_DIM) -> DataFrame:
    """Vectors projected on their first principal components; unchanged when short enough."""
    rows = vectors.where(has_vector(F.col("embedding")))
    first = rows.select(F.size("embedding").alias("n")).first()
    if first is None or first.n <= dim:
        return rows
    model = PCA(k=dim, inputCol="_in", outputCol="_out").fit(
        rows.select(array_to_vector("embedding").alias("_in"))
    )
    projected = model.transform(rows.withColumn("_in", array_to_vector("embedding")))
    return projected.withColumn("embedding", vector_to_array("_out")).drop("_in", "_out")


def knn_graph(
    vectors: DataFrame, k: int = fixed.MIN_CLUSTER_SIZE, nprobe: int | None = None, pivots=None, descent: bool = False,
) -> DataFrame:
    """(product_id, neighbour_id, distance, rank): the k nearest other products of each product.

    Exact, by comparing all, unless `nprobe` names how many cells a product searches, or `descent` asks for neighbour
    descent, whose work grows with the rows alone.
    """
    rows = vectors.select(F.col("product_id").cast("long").alias("id"), "embedding")
    if descent:
        found = knn.descent(rows, k)
    else:
        found = knn.knn_join(rows, rows, k, exclude_self=True, pivots=pivots, nprobe=nprobe)
    return found.withColumnsRenamed({"query": "product_id", "id": "neighbour_id"})


def core_distance(graph: DataFrame, min_samples: int = fixed.MIN_SAMPLES) -> DataFrame:
    """(product_id, core): distance to the neighbour of rank `min_samples`."""
    return graph.where(F.col("rank") == min_samples).select("product_id", F.col("distance").alias("core"))


def reachability_edges(graph: DataFrame, cores: DataFrame) -> DataFrame:
    """(a, b, weight): each neighbour pair once; weight = largest of both cores and the distance."""
    a = F.least("product_id", "neighbour_id").alias("a")
    b = F.greatest("product_id", "neighbour_id").alias("b")
    pairs = graph.select(a, b, "distance").groupBy("a", "b").agg(F.min("distance").alias("distance"))
    for end in ("a", "b"):
        pairs = pairs.join(shuffled(cores.select(F.col("product_id").alias(end), F.col("core").alias("core_" + end))), end)
    return pairs.select("a", "b", F.greatest("core_a", "core_b", "distance").alias("weight"))


def components_at_level(edges: DataFrame, cores: DataFrame, eps: float) -> DataFrame:
    """(product_id, component) of the products whose core lies within `eps`."""
    nodes = cores.where(F.col("core") <= eps).select(F.col("product_id").alias("node"))
    found = connected_components(nodes, edges.where(F.col("weight") <= eps).select("a", "b"))
    return found.withColumnRenamed("node", "product_id")


def select_clusters(
    edges: DataFrame, cores: DataFrame, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE, allow_single: bool = False,
) -> DataFrame:
    """(product_id, cluster_id, cluster_probability) of the clustered products of a graph; the others are noise.

    The hierarchy takes in every weight of the graph, clusters are those of largest total stability. They are numbered
    by their smallest product id. The probability is the density at which a product joins its cluster, relative to the
    density at which the cluster starts.
    """
    return _selected(spanning_forest(edges), cores, min_cluster_size, allow_single)


def _selected(tree: DataFrame, cores: DataFrame, min_cluster_size: int, allow_single: bool) -> DataFrame:
    found, joins = condense.condensed(tree, cores.select(F.col("product_id").alias("node")), min_cluster_size)
    chosen = found.chosen(allow_single)
    inside = np.flatnonzero(chosen >= 0)
    chosen = chosen[inside]
    kept, at = np.unique(chosen, return_inverse=True)
    number = np.argsort(np.argsort(np.array(found.smallest)[kept], kind="stable"))
    places = cores.sparkSession.createDataFrame(pa.table({
        "cluster": inside, "cluster_id": number[at], "start": np.array(found.start)[chosen], "own": inside == chosen,
    }))
    probability = F.when(F.col("own"), F.col("start") / F.col("weight")).otherwise(1.0)
    return joins.join(places, "cluster").select(
        F.col("node").alias("product_id"), "cluster_id", probability.alias("cluster_probability")
    )


def cluster_vectors(
    vectors: DataFrame, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE, min_samples: int = fixed.MIN_SAMPLES,
    nprobe: int | None = None, reduced_dim: int | None = None, allow_single: bool = False, descent: bool = False,
) -> DataFrame:
    """(product_id, cluster_id, cluster_probability) for every product with a vector.

    The hierarchy is that of all mutual reachability distances, not of the neighbour lists alone; that compares all
    rows with each other. For catalogues too large for it: with `nprobe` lists and searches visit the nearest cells
    only, with `descent` lists come from neighbour descent and searches visit `nprobe` cells, or SEARCHED_CELLS.
    """
    rows = vectors.where(has_vector(F.col("embedding"))).select("product_id", "embedding")
    if rows.limit(min_cluster_size).count() < min_cluster_size:
        raise ValueError(f"fewer than {min_cluster_size} vectors to cluster")
    source = cut(reduce_dims(rows, reduced_dim) if reduced_dim else rows)
    graph = cut(knn_graph(source, max(min_cluster_size, min_samples), nprobe, descent=descent))
    cores = cut(core_distance(graph, min_samples))
    edges = cut(reachability_edges(graph, cores))
    tree = spanning_tree(source, graph, cores, edges, nprobe or (SEARCHED_CELLS if descent else None))
    found = _selected(tree, cores, min_cluster_size, allow_single)
    return rows.select("product_id").join(found, "product_id", "left").select(
        "product_id", F.coalesce("cluster_id", F.lit(fixed.NOISE)).cast("long").alias("cluster_id"),
        F.coalesce("cluster_probability", F.lit(0.0)).alias("cluster_probability"),
    )


def assign_clusters(
    found: DataFrame, labels: DataFrame, at: dt.datetime, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE
) -> DataFrame:
    """`products_clustered` rows; noise has no label."""
    return found.join(labels.select("cluster_id", "cluster_label"), "cluster_id", "left").select(
        "product_id", "cluster_id", "cluster_label", "cluster_probability",
        (F.col("cluster_id") == fixed.NOISE).alias("is_noise"),
        F.lit(ALGORITHM).alias("clustering_algorithm"),
        F.lit(min_cluster_size).cast("long").alias("min_cluster_size_param"),
        F.lit(at).cast("timestamp").alias("clustering_created_at"),
    )


def cluster_stats(clustered: DataFrame) -> DataFrame:
    """Clusters, noise points and products."""
    noise = F.col("cluster_id") == fixed.NOISE
    return clustered.agg(
        F.count_distinct(F.when(~noise, F.col("cluster_id"))).alias("clusters"),
        F.count_if(noise).alias("noise_points"),
        F.count(F.lit(1)).alias("total_products"),
    )
