"""Quality snapshot and the twelve quality rules."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.numbers import round2, valid_price
from assortment.sources.tables import table_counts


class QualityRuleFailed(RuntimeError):
    """A rule did not hold in strict mode."""


def quality_snapshot(clean: DataFrame, report_timestamp: dt.datetime) -> DataFrame:
    """One `quality_report` row."""
    rows = F.count(F.lit(1))

    def filled(name: str) -> Column:
        return F.count_if(F.col(name).isNotNull() & (F.col(name) != ""))

    return clean.agg(
        rows.alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        round2(F.try_divide(100.0 * F.count_if("is_valid"), rows)).alias("completeness_pct"),
        filled("name").alias("field_name_completeness"),
        filled("brand").alias("field_brand_completeness"),
        filled("category").alias("field_cat_completeness"),
        F.count_if(F.col("retail_price") > 0).alias("field_price_completeness"),
        round2(F.avg("retail_price")).alias("price_mean"),
        round2(F.stddev("retail_price")).alias("price_stddev"),
        F.min("retail_price").alias("price_min"),
        F.max("retail_price").alias("price_max"),
    ).select(F.lit(report_timestamp).cast("timestamp").alias("report_timestamp"), "*")


def layer_counts(clean, embedded, clustered, enriched) -> DataFrame:
    """Rows of the four layers, in name order."""
    return table_counts({
        "products_clean": clean,
        "products_embedded": embedded,
        "products_clustered": clustered,
        "products_enriched": enriched,
    }).orderBy("layer")


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def _row_rules() -> dict[str, Column]:
    """Rules that count offending rows of `products_clean`."""
    return {
        "ASSERT_02": _blank("name") | _blank("brand") | _blank("category") | _blank("department"),
        "ASSERT_03": (F.col("retail_price") < 0) | (F.col("cost") < 0),
        "ASSERT_04": F.col("is_valid") & (F.col("cost") > F.col("retail_price")),
        "ASSERT_05": ~valid_price("retail_price"),
    }


def _verdict(rows: DataFrame, at_least: bool = False) -> DataFrame:
    """(rule_id, observed, limit) with the outcome."""
    holds = F.col("observed") >= F.col("limit") if at_least else F.col("observed") <= F.col("limit")
    return rows.select(
        "rule_id", holds.alias("passed"), F.col("observed").cast("long").alias("observed"),
        F.col("limit").cast("long").alias("limit"),
    )


def _one(df: DataFrame, rule_id: str, observed: Column, limit: Column | int = 0) -> DataFrame:
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return df.agg(observed.alias("observed"), limit.alias("limit")).withColumn("rule_id", F.lit(rule_id))


def _as_rows(one_row: DataFrame, limits: dict[str, Column]) -> DataFrame:
    """One row of counts to a (rule_id, observed, limit) row per rule."""
    rules = [
        F.struct(F.lit(r).alias("rule_id"), F.col(r).cast("long").alias("observed"), limit.cast("long").alias("limit"))
        for r, limit in limits.items()
    ]
    return one_row.select(F.inline(F.array(*rules)))


def row_rules(clean: DataFrame, *rule_ids: str) -> DataFrame:
    """Rules 2 to 5 (or the named ones) in one scan."""
    rules = {r: c for r, c in _row_rules().items() if not rule_ids or r in rule_ids}
    counts = clean.agg(*[F.count_if(c).alias(r) for r, c in rules.items()])
    return _verdict(_as_rows(counts, {r: F.lit(0) for r in rules}))


def unique_ids_rule(clean: DataFrame) -> DataFrame:
    """Rule 1: no product id twice."""
    ids = clean.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return _verdict(_one(ids, "ASSERT_01", F.count_if(F.col("n") > 1)))


_COVERAGE = {
    "ASSERT_06": ("products_embedded", fixed.EMBEDDING_GAP),
    "ASSERT_09": ("products_clustered", fixed.CLUSTERING_GAP),
    "ASSERT_12": ("products_enriched", fixed.ENRICHMENT_GAP),
}


def coverage_rule(clean: DataFrame, layer: DataFrame, rule_id: str) -> DataFrame:
    """Rules 6, 9, 12: products missing in a layer stay within a share of the catalogue."""
    missing = clean.join(layer.select("product_id"), "product_id", "left_anti")
    allowed = clean.agg(F.ceil(_COVERAGE[rule_id][1] * F.count(F.lit(1)))).scalar()
    counted = missing.agg(F.count(F.lit(1)).alias("observed"))
    return _verdict(counted.withColumns({"limit": allowed, "rule_id": F.lit(rule_id)}))


def vector_length_rule(embedded: DataFrame, dim: int = fixed.EMBEDDING_DIM) -> DataFrame:
    """Rule 7: every vector has the declared length."""
    return _verdict(_one(embedded, "ASSERT_07", F.count_if(F.size("embedding") != dim)))


def vector_present_rule(embedded: DataFrame) -> DataFrame:
    """Rule 8: no NULL (or empty) vector."""
    vector = F.col("embedding")
    return _verdict(_one(embedded, "ASSERT_08", F.count_if(vector.isNull() | (F.size(vector) == 0))))


def _cluster_sizes(clustered: DataFrame) -> DataFrame:
    real = clustered.where(F.col("cluster_id") != fixed.NOISE)
    return real.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def cluster_size_rule(clustered: DataFrame, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE) -> DataFrame:
    """Rule 10: no real cluster below the minimum size."""
    return _verdict(_one(_cluster_sizes(clustered), "ASSERT_10", F.count_if(F.col("n") < min_cluster_size)))


def cluster_count_rule(clustered: DataFrame, min_clusters: int = fixed.MIN_CLUSTERS) -> DataFrame:
    """Rule 11: enough real clusters."""
    sizes = _cluster_sizes(clustered)
    return _verdict(_one(sizes, "ASSERT_11", F.count(F.lit(1)), min_clusters), at_least=True)


def _id_rules(clean, embedded, clustered, enriched) -> DataFrame:
    """Rules 1, 6, 9, 12 together: every table is shuffled once, by product id."""
    ids = clean.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    layers = {"ASSERT_06": embedded, "ASSERT_09": clustered, "ASSERT_12": enriched}
    for rule_id, layer in layers.items():
        seen = layer.groupBy("product_id").agg(F.lit(True).alias(rule_id))
        ids = ids.join(seen, "product_id", "left")
    total = F.coalesce(F.sum("n"), F.lit(0))
    missing = [
        F.coalesce(F.sum(F.when(F.col(r).isNull(), F.col("n"))), F.lit(0)).alias(r) for r in layers
    ]
    counts = ids.agg(F.count_if(F.col("n") > 1).alias("ASSERT_01"), total.alias("total"), *missing)
    limits = {"ASSERT_01": F.lit(0)}
    limits |= {r: F.ceil(F.lit(gap) * F.col("total")) for r, (_, gap) in _COVERAGE.items()}
    return _verdict(_as_rows(counts, limits))


def run_rules(
    clean: DataFrame, embedded: DataFrame, clustered: DataFrame, enriched: DataFrame,
    dim: int = fixed.EMBEDDING_DIM, min_cluster_size: int = fixed.MIN_CLUSTER_SIZE,
    min_clusters: int = fixed.MIN_CLUSTERS, strict: bool = False,
) -> DataFrame:
    """All twelve rules as one table. `strict` raises on the first rule that does not hold."""
    vector = F.col("embedding")
    vectors = embedded.agg(
        F.count_if(F.size(vector) != dim).alias("ASSERT_07"),
        F.count_if(vector.isNull() | (F.size(vector) == 0)).alias("ASSERT_08"),
    )
    sizes = _cluster_sizes(clustered).agg(
        F.count_if(F.col("n") < min_cluster_size).alias("ASSERT_10"),
        F.count(F.lit(1)).alias("ASSERT_11"),
    )
    rules = (
        _id_rules(clean, embedded, clustered, enriched)
        .unionByName(row_rules(clean))
        .unionByName(_verdict(_as_rows(vectors, {"ASSERT_07": F.lit(0), "ASSERT_08": F.lit(0)})))
        .unionByName(_size_verdicts(sizes, min_clusters))
        .orderBy("rule_id")
    )
    if strict:
        failed = rules.where(~F.col("passed")).orderBy("rule_id").first()
        if failed:
            raise QualityRuleFailed(f"{failed.rule_id}: observed {failed.observed}, limit {failed.limit}")
    return rules


def _size_verdicts(sizes: DataFrame, min_clusters: int) -> DataFrame:
    rows = _as_rows(sizes, {"ASSERT_10": F.lit(0), "ASSERT_11": F.lit(min_clusters)})
    small = _verdict(rows.where("rule_id = 'ASSERT_10'"))
    few = _verdict(rows.where("rule_id = 'ASSERT_11'"), at_least=True)
    return small.unionByName(few)
