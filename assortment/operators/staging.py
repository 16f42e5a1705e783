"""Product source to `products_raw`."""

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number(name: str):
    """Double column with NaN as NULL, since NaN compares as larger than any number."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def source_products(products: DataFrame) -> DataFrame:
    """The seven source columns, typed, plus an empty `created_at`."""
    return products.select(
        F.col("id").cast("long").alias("product_id"),
        F.col("name").cast("string").alias("name"),
        F.col("brand").cast("string").alias("brand"),
        F.col("category").cast("string").alias("category"),
        F.col("department").cast("string").alias("department"),
        number("retail_price").alias("retail_price"),
        number("cost").alias("cost"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def source_order_items(items: DataFrame) -> DataFrame:
    """The order line columns the dashboard reads."""
    return items.select("order_id", "product_id", "created_at", F.col("sale_price").cast("double").alias("sale_price"))


def with_mandatory_fields(products: DataFrame) -> DataFrame:
    """Rows with an id, a name and a category. Blank-only texts pass: they are trimmed later."""
    return products.where(
        F.col("product_id").isNotNull() & (F.col("name") != "") & (F.col("category") != "")
    )


def dedupe_products(products: DataFrame) -> DataFrame:
    """One row per product: lowest cost, NULL cost last, then the remaining columns as tie-break.

    The filter on the row number lets Spark keep one row per key in each map task, so a product id
    with very many copies is not gathered in one place.
    """
    order = [F.asc_nulls_last("cost"), F.asc_nulls_last("retail_price")]
    order += [F.asc_nulls_last(c) for c in ("name", "brand", "category", "department", "created_at")]
    first = Window.partitionBy("product_id").orderBy(*order)
    return products.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def stage_products(products: DataFrame, ingestion_date: dt.date) -> DataFrame:
    """Source rows to `products_raw`."""
    kept = dedupe_products(with_mandatory_fields(source_products(products)))
    return kept.withColumn("ingestion_date", F.lit(ingestion_date))


def staging_checks(raw: DataFrame) -> DataFrame:
    """Row, NULL and distinct id counts of `products_raw`."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("product_id").isNull()).alias("null_product_ids"),
        F.count_if(F.col("name").isNull() | (F.col("name") == "")).alias("null_names"),
        F.count_if(F.col("category").isNull() | (F.col("category") == "")).alias("null_categories"),
        F.count_distinct("product_id").alias("distinct_product_ids"),
    )
