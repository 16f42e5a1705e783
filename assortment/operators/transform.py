"""`products_raw` to `products_clean`."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.numbers import round2, valid_price
from assortment.functions.text import strip
from assortment.sources.lineage import cut

BROADCAST_MEDIANS = 100_000


def _tidy(name: str) -> Column:
    return F.upper(strip(F.col(name)))


def _tidy_or(name: str, default: str) -> Column:
    return F.coalesce(F.nullif(_tidy(name), F.lit("")), F.lit(default))


def normalise_strings(raw: DataFrame) -> DataFrame:
    """Upper case and trim white space; blank brand and department get their default."""
    return raw.select(
        "product_id",
        _tidy("name").alias("name"),
        _tidy_or("brand", fixed.DEFAULT_BRAND).alias("brand"),
        _tidy("category").alias("category"),
        _tidy_or("department", fixed.DEFAULT_DEPARTMENT).alias("department"),
        "retail_price",
        "cost",
        F.col("created_at").alias("source_created_at"),
    )


def category_median(
    raw: DataFrame, median_key: str = "raw", approximate: bool = False
) -> DataFrame:
    """Lower median of the valid prices per category.

    Exact without gathering a category in one task: prices are counted per price band of one unit
    (the valid range bounds the bands), which tells the band that holds the middle rank; only the
    values of that band are counted one by one and ranked.
    """
    if median_key not in ("raw", "normalised"):
        raise ValueError("median_key is 'raw' or 'normalised'")
    key = F.col("category") if median_key == "raw" else _tidy("category")
    prices = raw.where(valid_price("retail_price")).select(key.alias("category"), "retail_price")
    if approximate:
        middle = F.approx_percentile("retail_price", 0.5, 10000)
        return prices.groupBy("category").agg(middle.alias("median_price"))

    prices = prices.withColumn("band", F.floor("retail_price"))
    upwards = Window.partitionBy("category").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    bands = (
        prices.groupBy("category", "band").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("up_to", F.sum("n").over(upwards))
        .withColumn("middle", F.ceil(F.sum("n").over(Window.partitionBy("category")) / 2))
        .where("up_to >= middle AND up_to - n < middle")
        .select("category", "band", (F.col("middle") - F.col("up_to") + F.col("n")).alias("rank_in_band"))
    )
    in_band = Window.partitionBy("category").orderBy("retail_price").rowsBetween(Window.unboundedPreceding, 0)
    return (
        prices.join(bands, ["category", "band"])
        .groupBy("category", "rank_in_band", "retail_price").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("up_to", F.sum("n").over(in_band))
        .where("up_to >= rank_in_band")
        .groupBy("category").agg(F.min("retail_price").alias("median_price"))
    )


def impute_price(products: DataFrame, medians: DataFrame) -> DataFrame:
    """Valid price, else the median of the category, else the fallback.

    The medians are written and counted: up to BROADCAST_MEDIANS rows go to the tasks, so that no product is
    shuffled by a handful of categories; more are joined by a shuffle, whose hot keys adaptive execution splits.
    """
    medians = cut(medians)
    if medians.count() <= BROADCAST_MEDIANS:
        medians = F.broadcast(medians)
    joined = products.join(medians, "category", "left")
    price = F.when(valid_price("retail_price"), F.col("retail_price")).otherwise(
        F.coalesce("median_price", F.lit(fixed.FALLBACK_PRICE))
    )
    return joined.withColumn("retail_price", price).drop("median_price").select(*products.columns)


def repair_cost(products: DataFrame) -> DataFrame:
    """NULL or negative cost becomes 0; a cost above the price becomes half the price."""
    cost, price = F.col("cost"), F.col("retail_price")
    fixed_cost = (
        F.when(cost.isNull() | (cost < 0), F.lit(0.0))
        .when(cost > price, price * fixed.COST_SHARE)
        .otherwise(cost)
    )
    return products.withColumn("cost", fixed_cost)


def margin_pct(products: DataFrame) -> DataFrame:
    """Margin in percent of the price; NULL unless the price is positive."""
    price, cost = F.col("retail_price"), F.col("cost")
    return products.withColumn("margin_pct", F.when(price > 0, round2((price - cost) / price * 100)))


def is_valid(products: DataFrame) -> DataFrame:
    """True when texts are filled, the price is in range and 0 <= cost <= price."""
    rule = valid_price("retail_price") & (F.col("cost") >= 0) & (F.col("cost") <= F.col("retail_price"))
    for name in ("name", "brand", "category", "department"):
        rule = rule & F.col(name).isNotNull() & (F.col(name) != "")
    return products.withColumn("is_valid", rule)


def validation_errors(products: DataFrame) -> DataFrame:
    """JSON list of error codes; NULL when there are none."""
    name, price, cost = F.col("name"), F.col("retail_price"), F.col("cost")
    codes = F.array(
        F.when(name.isNull() | (name == ""), fixed.ERR_MISSING_NAME),
        F.when(price <= fixed.PRICE_FLOOR, fixed.ERR_INVALID_PRICE),
        F.when(price >= fixed.PRICE_CEILING, fixed.ERR_PRICE_TOO_HIGH),
        F.when(cost < 0, fixed.ERR_NEGATIVE_COST),
        F.when(cost > price, fixed.ERR_COST_GT_PRICE),
    )
    return products.withColumn(
        "validation_errors", F.nullif(F.to_json(F.array_compact(codes)), F.lit("[]"))
    )


def clean_products(
    raw: DataFrame,
    cleaned_at: dt.datetime,
    median_key: str = "raw",
    approximate_median: bool = False,
) -> DataFrame:
    """All cleaning steps: `products_raw` to `products_clean`."""
    medians = category_median(raw, median_key, approximate_median)
    out = impute_price(normalise_strings(raw), medians)
    out = validation_errors(is_valid(margin_pct(repair_cost(out))))
    return out.select(
        "product_id", "name", "brand", "category", "department", "retail_price", "cost", "margin_pct",
        "is_valid", "validation_errors", F.lit(cleaned_at).cast("timestamp").alias("cleaned_at"),
        "source_created_at",
    )


def transform_checks(clean: DataFrame) -> DataFrame:
    """Validity, default and price figures of `products_clean`."""
    rows = F.count(F.lit(1))
    return clean.agg(
        rows.alias("total_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
        round2(F.try_divide(100.0 * F.count_if("is_valid"), rows)).alias("validity_pct"),
        F.count_if(F.col("brand") == fixed.DEFAULT_BRAND).alias("unbranded_count"),
        F.count_if(F.col("department") == fixed.DEFAULT_DEPARTMENT).alias("general_dept_count"),
        F.min("retail_price").alias("price_min"),
        F.max("retail_price").alias("price_max"),
        round2(F.avg("retail_price")).alias("price_avg"),
    )
