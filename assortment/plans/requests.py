"""What a user asks a catalogue: search, intent, clusters, analytics, quality, one description."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment import fixed
from assortment.operators import dashboard, embed, enrich, retrieval, views
from assortment.plans.run import stored_index
from assortment.sources.lineage import cut
from assortment.sources.tables import Catalogue, latest_snapshot


def query_vector(catalogue: Catalogue, text: str, embedder=None, dim: int = fixed.EMBEDDING_DIM) -> list[float]:
    """Vector of one text, made like the vectors of the products."""
    if embedder is not None:
        return [float(x) for x in embedder([text])[0][0]]
    row = catalogue.spark.range(1).select(F.lit(text).alias("text"))
    vector = embed.embed_texts(row, "text", dim).first().embedding
    if vector is None:
        raise ValueError("the text has no words to search for")
    return vector


def search(
    catalogue: Catalogue, query: str, top_k: int = 10, min_price: float | None = None, max_price: float | None = None,
    embedder=None, dim: int = fixed.EMBEDDING_DIM, **options,
) -> DataFrame:
    """Products nearest to a text."""
    retrieval.check_search(query, top_k, min_price, max_price)
    return retrieval.search_products(
        query_vector(catalogue, query, embedder, dim), catalogue.read("products_clean"),
        catalogue.read("products_embedded"), catalogue.read_reloaded("products_clustered"),
        catalogue.read("products_enriched"), top_k, min_price, max_price, query=query, index=stored_index(catalogue), **options,
    )


def template_reply() -> Column:
    """A JSON reply made of the figures of a brief."""
    prices = F.transform("sample_products", lambda p: p["retail_price"])
    low, high = F.floor(F.array_min(prices)).cast("string"), F.ceil(F.array_max(prices)).cast("string")
    return F.to_json(F.struct(
        F.concat(F.col("cluster_label"), F.lit(": "), F.col("hit_count"), F.lit(" near products")).alias("positioning"),
        F.concat(F.lit("€"), low, F.lit("–€"), high).alias("price_range"),
        F.concat(F.lit("Review "), F.col("sample_products")[0]["name"]).alias("buyer_action"),
    ))


def intent_replies(briefs: DataFrame, intent: str, generator=None) -> DataFrame:
    """Briefs with the three texts of their reply, best cluster first."""
    if generator is None:
        asked = briefs.withColumn("reply", template_reply())
    else:
        asked = enrich.generate_text(retrieval.brief_prompt(F.lit(intent), briefs), generator)
        asked = asked.withColumnRenamed("text", "reply")
    parsed = retrieval.parse_brief(asked)
    return parsed.orderBy(F.desc("hit_count"), "nearest_distance", "nearest_id").select(
        "cluster_id", "cluster_label", "hit_count", "products_total", "avg_price",
        F.transform("sample_products", lambda p: p.dropFields("position")).alias("sample_products"),
        "positioning", "price_range", "buyer_action",
    )


def analyze_intent(
    catalogue: Catalogue, intent: str, top_k_clusters: int = 5, embedder=None, generator=None,
    dim: int = fixed.EMBEDDING_DIM, nprobe: int | None = None,
) -> DataFrame:
    """Clusters that match a buyer's intent, each with a brief. With an index `nprobe` lists are searched; as many as
    there are make it exact."""
    retrieval.check_intent(intent, top_k_clusters)
    clean, clustered = catalogue.read("products_clean"), catalogue.read_reloaded("products_clustered")
    vector = query_vector(catalogue, intent, embedder, dim)
    hits = retrieval.intent_hits(
        vector, clean, catalogue.read("products_embedded"), clustered, index=stored_index(catalogue), nprobe=nprobe
    )
    return intent_replies(retrieval.intent_briefs(hits, clean, clustered, top_k_clusters), intent, generator)


def clusters(catalogue: Catalogue, query: str = "", page: int | None = None) -> DataFrame:
    """All clusters, largest first; or one page of those whose name contains `query`."""
    joined = views.clustered_catalogue(
        catalogue.read("products_clean"), catalogue.read_reloaded("products_clustered")
    )
    listed = cut(dashboard.clusters_list(joined))
    if page is None and not query:
        return listed.orderBy(F.desc("product_count"), "cluster_id", "cluster_label")
    return dashboard.cluster_page(listed, query, page or 0)


def cluster_products(catalogue: Catalogue, cluster_id: int, limit: int = fixed.CLUSTER_PRODUCTS) -> DataFrame:
    """Products of a cluster, dearest first."""
    return dashboard.cluster_products(
        catalogue.read("products_clean"), catalogue.read_reloaded("products_clustered"),
        catalogue.read("products_enriched"), cluster_id, limit,
    )


def analytics(catalogue: Catalogue, order_items: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The six charts by name."""
    return dashboard.dashboard_bundle(views.all_views(
        catalogue.read("products_clean"), catalogue.read_reloaded("products_clustered"), order_items,
        catalogue.read("quality_report"), as_of,
    ))


def quality_report(catalogue: Catalogue) -> DataFrame:
    """The newest quality row; an error when there is none."""
    newest = latest_snapshot(catalogue.read("quality_report"))
    if newest.isEmpty():
        raise ValueError("no quality report yet")
    return newest


def enrich_product(
    catalogue: Catalogue, product_id: int, at: dt.datetime, generator=None, model: str | None = None
) -> DataFrame:
    """Describe one product anew; returns its row."""
    one = catalogue.spark.range(1).select(F.lit(product_id).cast("long").alias("product_id"))
    return enrich.enrich_selected(catalogue, one, at, generator, model)
