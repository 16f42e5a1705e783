"""The six dashboard views."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.numbers import round2
from assortment.sources.lineage import cut
from assortment.sources.tables import latest_snapshot


def real_clusters(clustered: DataFrame) -> DataFrame:
    return clustered.where(F.col("cluster_id") != fixed.NOISE)


def clustered_catalogue(clean: DataFrame, clustered: DataFrame) -> DataFrame:
    """Products with their real cluster; the shared input of four views."""
    products = clean.select("product_id", "name", "brand", "retail_price")
    clusters = real_clusters(clustered).select("product_id", "cluster_id", "cluster_label")
    return products.join(clusters, "product_id")


def _products() -> Column:
    return F.count_distinct("product_id").alias("product_count")


def cluster_distribution(catalogue: DataFrame) -> DataFrame:
    """Size and mean price per cluster."""
    return (
        catalogue.groupBy("cluster_id", "cluster_label")
        .agg(_products(), round2(F.avg("retail_price")).alias("avg_price"))
        .orderBy(F.desc("product_count"), "cluster_id", "cluster_label")
    )


def _group(by: str) -> list[str]:
    if by not in ("cluster_label", "cluster_id"):
        raise ValueError("by is 'cluster_label' or 'cluster_id'")
    return [by] if by == "cluster_label" else ["cluster_id", "cluster_label"]


def brands_per_cluster(catalogue: DataFrame, by: str = "cluster_label") -> DataFrame:
    """The ten brands with most products per label."""
    group = _group(by)
    ranked = Window.partitionBy(*group).orderBy(F.desc("product_count"), "brand")
    return (
        catalogue.groupBy(*group, "brand").agg(_products())
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= fixed.BRANDS_PER_LABEL).drop("_rank")
        .orderBy(*group, F.desc("product_count"), "brand")
    )


def pricing_per_cluster(catalogue: DataFrame, by: str = "cluster_label") -> DataFrame:
    """Price figures per label."""
    return (
        catalogue.groupBy(*_group(by))
        .agg(
            _products(),
            round2(F.avg("retail_price")).alias("avg_price"),
            F.min("retail_price").alias("price_min"),
            F.max("retail_price").alias("price_max"),
            round2(F.stddev("retail_price")).alias("price_stddev"),
        )
        .orderBy(F.desc("avg_price"), *_group(by))
    )


def data_quality_latest(report: DataFrame) -> DataFrame:
    """Newest quality row, without the price deviation."""
    return latest_snapshot(report).drop("price_stddev")


def sales_timeline(
    order_items: DataFrame, catalogue: DataFrame, as_of: dt.datetime, by: str = "cluster_label"
) -> DataFrame:
    """Orders and revenue per day and label over the trailing window.

    The date filter reaches the scan of the order lines. The catalogue side has one row per product,
    so adaptive execution broadcasts it when it is small and otherwise splits a product that holds a
    large share of the lines. Joined lines are summed per (day, label, order) in the map tasks, which
    spreads a label with very many lines over its orders.
    """
    as_of_here = F.lit(str(as_of)).cast(order_items.schema["created_at"].dataType)
    start = as_of_here - F.expr(f"INTERVAL {fixed.SALES_WINDOW_DAYS} DAY")
    sold = order_items.where(F.col("created_at") >= start).select(
        "product_id", "order_id", F.to_date("created_at").alias("sale_date"), "sale_price"
    )
    labels = catalogue.select("product_id", *_group(by))
    return (
        sold.join(labels, "product_id")
        .groupBy("sale_date", *_group(by))
        .agg(
            F.count_distinct("order_id").alias("sales_count"),
            F.sum(F.col("sale_price").cast("double")).alias("sales_revenue"),
        )
        .orderBy(F.desc("sale_date"), F.desc("sales_count"), *_group(by))
    )


def heatmap_cat_dept(clean: DataFrame) -> DataFrame:
    """Products and mean price per category and department."""
    return (
        clean.groupBy("category", "department")
        .agg(_products(), round2(F.avg("retail_price")).alias("avg_price"))
        .orderBy("category", "department")
    )


def all_views(clean, clustered, order_items, report, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The six views by name. The joined catalogue four of them start from is written once."""
    catalogue = cut(clustered_catalogue(clean, clustered))
    return {
        "cluster_distribution": cluster_distribution(catalogue),
        "brands_per_cluster": brands_per_cluster(catalogue),
        "pricing_per_cluster": pricing_per_cluster(catalogue),
        "data_quality": data_quality_latest(report),
        "sales_timeline": sales_timeline(order_items, catalogue, as_of),
        "heatmap_cat_dept": heatmap_cat_dept(clean),
    }


def register_views(views: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Publish views for `spark.sql`; returns their names."""
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
