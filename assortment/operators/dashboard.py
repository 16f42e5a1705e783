"""Charts, cards and pages over the views."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.numbers import band, percent, round2
from assortment.functions.text import cluster_name, contains_text
from assortment.operators.views import cluster_distribution


def top_clusters_chart(distribution: DataFrame) -> DataFrame:
    """The forty largest clusters."""
    ordered = distribution.orderBy(F.desc("product_count"), "cluster_id", "cluster_label")
    return ordered.limit(fixed.TOP_CLUSTERS).select("cluster_label", "product_count", "avg_price")


def top_pricing_chart(pricing: DataFrame) -> DataFrame:
    """The twenty dearest labels."""
    columns = ["cluster_label", "avg_price", "price_min", "price_max", "product_count"]
    return pricing.select(*columns).orderBy(F.desc("avg_price"), "cluster_label").limit(fixed.TOP_PRICING)


def heatmap_chart(heatmap: DataFrame) -> DataFrame:
    """Heatmap cells, largest first."""
    return heatmap.select("category", "department", "product_count", "avg_price").orderBy(
        F.desc("product_count"), "category", "department"
    )


def quality_chart(quality: DataFrame) -> DataFrame:
    """Newest quality figures without their time."""
    return quality.drop("report_timestamp")


def timeline_chart(timeline: DataFrame) -> DataFrame:
    """Sales rows in date order."""
    return timeline.select("sale_date", "cluster_label", "sales_count", "sales_revenue").orderBy(
        "sale_date", "cluster_label"
    )


def brands_chart(brands: DataFrame) -> DataFrame:
    """The first hundred (label, brand) rows in label order."""
    ordered = brands.orderBy("cluster_label", F.desc("product_count"), "brand")
    return ordered.limit(fixed.BRANDS_CHART_ROWS).select("cluster_label", "brand", "product_count")


def brand_cards(chart: DataFrame) -> DataFrame:
    """The first six labels of the brands chart with their first five brands.

    The windows run over the chart, which has a hundred rows at most.
    """
    labels = Window.orderBy("cluster_label")
    brands = Window.partitionBy("cluster_label").orderBy(F.desc("product_count"), "brand")
    return (
        chart.withColumns({"card": F.dense_rank().over(labels), "position": F.row_number().over(brands)})
        .where((F.col("card") <= fixed.CARD_LABELS) & (F.col("position") <= fixed.CARD_BRANDS))
    )


def timeline_daily(timeline: DataFrame) -> DataFrame:
    """Sales per day; an order over two labels counts for each."""
    return timeline.groupBy("sale_date").agg(F.sum("sales_count").alias("sales_count")).orderBy("sale_date")


def heatmap_matrix(heatmap: DataFrame, departments: list[str] | None = None) -> DataFrame:
    """Categories as rows, departments as columns, 0 where there is no product.

    Without `departments` Spark reads their distinct values first.
    """
    cells = heatmap.groupBy("category").pivot("department", departments)
    return cells.agg(F.sum("product_count")).na.fill(0).orderBy("category")


def heatmap_intensity(heatmap: DataFrame) -> DataFrame:
    """Cell counts as a share of the largest count."""
    largest = heatmap.agg(F.greatest(F.max("product_count"), F.lit(1))).scalar()
    share = F.col("product_count") / largest
    return heatmap.select("category", "department", "product_count", share.alias("intensity"))


def kpi_cards(quality: DataFrame) -> DataFrame:
    """Headline figures with field percentages and their bands."""
    out = quality.select(
        "total_records", "valid_records", "completeness_pct", "price_mean", "price_min", "price_max",
        *[
            percent(F.col(f"field_{f}_completeness"), F.col("total_records")).alias(f"{f}_pct")
            for f in ("name", "brand", "cat", "price")
        ],
    )
    return out.withColumns({f"{f}_band": band(F.col(f"{f}_pct")) for f in ("name", "brand", "cat", "price")})


def newest_descriptions(enriched: DataFrame) -> DataFrame:
    """One description per product: the newest, so that joins do not repeat products."""
    newest = Window.partitionBy("product_id").orderBy(
        F.desc("description_created_at"), "description_enriched"
    )
    ranked = enriched.select("product_id", "description_enriched", "description_created_at").withColumn(
        "_rn", F.row_number().over(newest)
    )
    return ranked.where("_rn = 1").select("product_id", "description_enriched")


def clusters_list(catalogue: DataFrame) -> DataFrame:
    """All clusters with a name, largest first."""
    named = cluster_distribution(catalogue).withColumn(
        "cluster_label", cluster_name(F.col("cluster_label"), F.col("cluster_id"))
    )
    return named.orderBy(F.desc("product_count"), "cluster_id", "cluster_label")


def cluster_products(
    clean: DataFrame, clustered: DataFrame, enriched: DataFrame, cluster_id: int,
    limit: int = fixed.CLUSTER_PRODUCTS, newest_only: bool = True,
) -> DataFrame:
    """Products of one cluster with their description, dearest first."""
    if limit > fixed.CLUSTER_PRODUCTS:
        raise ValueError(f"limit is {fixed.CLUSTER_PRODUCTS} at most")
    members = clustered.where(F.col("cluster_id") == cluster_id)
    members = members.select("product_id", "cluster_id", "cluster_label")
    texts = newest_descriptions(enriched) if newest_only else enriched
    products = clean.select("product_id", "name", "brand", "retail_price")
    return (
        members.join(products, "product_id")
        .join(texts.select("product_id", "description_enriched"), "product_id", "left")
        .withColumn("cluster_label", cluster_name(F.col("cluster_label"), F.col("cluster_id")))
        .select(
            "product_id", "name", "brand", "retail_price", "description_enriched", "cluster_id", "cluster_label"
        )
        .orderBy(F.desc("retail_price"), "product_id", "description_enriched")
        .limit(limit)
    )


def cluster_header(products: DataFrame) -> DataFrame:
    """Count and mean price of the listed products."""
    return products.agg(
        F.count(F.lit(1)).alias("product_count"), round2(F.avg("retail_price")).alias("avg_price")
    )


def cluster_page(clusters: DataFrame, query: str = "", page: int = 0, size: int = fixed.PAGE_SIZE) -> DataFrame:
    """One page of the clusters whose name contains `query`, with the number of pages."""
    found = clusters.where(contains_text(F.col("cluster_label"), query))
    pages = found.agg(F.ceil(F.count(F.lit(1)) / size)).scalar()
    ordered = found.orderBy(F.desc("product_count"), "cluster_id", "cluster_label")
    return ordered.offset(page * size).limit(size).withColumn("total_pages", pages)


def dashboard_bundle(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six charts by name."""
    return {
        "cluster_distribution": top_clusters_chart(views["cluster_distribution"]),
        "pricing": top_pricing_chart(views["pricing_per_cluster"]),
        "heatmap": heatmap_chart(views["heatmap_cat_dept"]),
        "quality": quality_chart(views["data_quality"]),
        "timeline": timeline_chart(views["sales_timeline"]),
        "brands": brands_chart(views["brands_per_cluster"]),
    }
