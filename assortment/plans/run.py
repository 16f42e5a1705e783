"""Catalogue runs: source to clean tables, and the model steps on top."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assortment import fixed
from assortment.operators import clusters, embed, enrich, labels, quality, staging, transform, vector
from assortment.operators.vector import VectorIndex
from assortment.sources.lineage import cut
from assortment.sources.tables import Catalogue, run_event, table_counts

GROWTH = 2
LAYERS = ("products_clean", "products_embedded", "products_enriched", "quality_report")


def run_sql_layers(catalogue: Catalogue, products: DataFrame, at: dt.datetime, **cleaning) -> DataFrame:
    """Replace `products_raw` and `products_clean`; returns their row counts."""
    catalogue.overwrite(staging.stage_products(products, at.date()), "products_raw")
    catalogue.overwrite(
        transform.clean_products(catalogue.read("products_raw"), at, **cleaning), "products_clean"
    )
    return table_counts({name: catalogue.read(name) for name in ("products_raw", "products_clean")})


def cluster_catalogue(
    catalogue: Catalogue, at: dt.datetime, labeller=None, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE,
    contrast: bool = False, **options,
) -> dict:
    """Cluster all vectors anew and replace `products_clustered`; returns counts.

    Vectors are reduced to REDUCED_DIM parts first unless `reduced_dim` says otherwise; neighbours are exact unless
    `nprobe` is given. `contrast` makes labels of phrases that set clusters apart.
    """
    options.setdefault("reduced_dim", fixed.REDUCED_DIM)
    vectors = catalogue.read("products_embedded").select("product_id", "embedding")
    found = cut(clusters.cluster_vectors(vectors, min_cluster_size, **options))
    named = labels.label_clusters(found, catalogue.read("products_clean"), labeller, contrast)
    rows = clusters.assign_clusters(found, named, at, min_cluster_size)
    catalogue.reload(rows, "products_clustered")
    return clusters.cluster_stats(found).first().asDict()


def build_index(
    catalogue: Catalogue, lists: int | None = None, min_rows: int = fixed.INDEX_MIN_ROWS, codes: bool = False
) -> VectorIndex | None:
    """Store inverted lists of all vectors and return them; None, and no index, for fewer than `min_rows`. With `codes`
    a request reads a byte for every four parts of a vector in its lists, and the vectors of its candidates."""
    vectors = catalogue.read("products_embedded").select("product_id", "embedding")
    if vectors.limit(min_rows).count() < min_rows:
        return None
    path = catalogue.new_index()
    vector.write_index(vector.ivf_build(vectors, lists, codes=codes), path, vectors.inputFiles())
    catalogue.name_index(path)
    return stored_index(catalogue)


def follow_index(catalogue: Catalogue) -> VectorIndex | None:
    """Add the vectors appended since to the lists of the stored index, if there is one."""
    index = stored_index(catalogue)
    if index is None:
        return None
    vector.append_index(index, catalogue.read("products_embedded").select("product_id", "embedding"))
    return stored_index(catalogue)


def refresh_index(catalogue: Catalogue, **options) -> VectorIndex | None:
    """Bring the index up to date: new rows join its lists until they would outnumber GROWTH times the others; then,
    and where there is none, all lists are made anew, so that their number follows that of the rows."""
    index = stored_index(catalogue)
    if index is not None and catalogue.read("products_embedded").count() <= GROWTH * index.rows.count():
        return follow_index(catalogue)
    return build_index(catalogue, **options)


def stored_index(catalogue: Catalogue) -> VectorIndex | None:
    """The newest stored index, if there is one."""
    path = catalogue.index()
    return path and vector.read_index(catalogue.spark, path)


def append_quality_report(catalogue: Catalogue, at: dt.datetime) -> None:
    """Add a snapshot of `products_clean` to the quality report."""
    catalogue.append(quality.quality_snapshot(catalogue.read("products_clean"), at), "quality_report")


def run_catalogue(
    catalogue: Catalogue, at: dt.datetime, embedder=None, labeller=None, generator=None,
    embedding: dict | None = None, clustering: dict | None = None, index: dict | None = None,
) -> dict:
    """Log the start, embed what is new, store the index, cluster all, describe what is new, log the outcome."""
    for name in LAYERS:
        catalogue.create(name)
    one = catalogue.spark.range(1)
    run_id, started = F.lit(str(uuid.uuid4())), F.lit(at)

    def log(status: str, **figures) -> None:
        now = started if status == "IN_PROGRESS" else F.lit(dt.datetime.now(dt.timezone.utc))
        catalogue.log(run_event(one, now, status, started, run_id, **figures))

    log("IN_PROGRESS")
    try:
        figures = embed.embed_incremental(catalogue, at, embedder, **(embedding or {}))
        refresh_index(catalogue, **(index or {}))
        figures |= cluster_catalogue(catalogue, at, labeller, **(clustering or {}))
        figures["enrichment"] = enrich.enrich_incremental(catalogue, at, generator)
    except Exception as error:
        log("FAILED", error=F.lit(str(error)))
        raise
    log("COMPLETE", products=F.lit(figures["embedded"]), clusters=F.lit(figures["clusters"]))
    return figures
