"""Declared tables and the check that rows conform to them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampType,
)

LONG, TEXT, DOUBLE, BOOLEAN = LongType(), StringType(), DoubleType(), BooleanType()
TIME, DATE, VECTOR = TimestampType(), DateType(), ArrayType(DoubleType())

# The columns of each table.
TABLES = {
    "products_raw": StructType([
        StructField("product_id", LONG, False),
        StructField("name", TEXT, False),
        StructField("brand", TEXT),
        StructField("category", TEXT, False),
        StructField("department", TEXT),
        StructField("retail_price", DOUBLE),
        StructField("cost", DOUBLE),
        StructField("created_at", TIME),
        StructField("ingestion_date", DATE, False),
    ]),
    "products_clean": StructType([
        StructField("product_id", LONG, False),
        StructField("name", TEXT, False),
        StructField("brand", TEXT, False),
        StructField("category", TEXT, False),
        StructField("department", TEXT, False),
        StructField("retail_price", DOUBLE, False),
        StructField("cost", DOUBLE, False),
        StructField("margin_pct", DOUBLE),
        StructField("is_valid", BOOLEAN, False),
        StructField("validation_errors", TEXT),
        StructField("cleaned_at", TIME, False),
        StructField("source_created_at", TIME),
    ]),
    "products_embedded": StructType([
        StructField("product_id", LONG, False),
        StructField("embedding_text", TEXT, False),
        StructField("embedding", VECTOR),
        StructField("embedding_model", TEXT, False),
        StructField("embedding_tokens", LONG, False),
        StructField("embedding_cost_usd", DOUBLE),
        StructField("embedding_created_at", TIME, False),
    ]),
    "products_clustered": StructType([
        StructField("product_id", LONG, False),
        StructField("cluster_id", LONG, False),
        StructField("cluster_label", TEXT),
        StructField("cluster_probability", DOUBLE),
        StructField("is_noise", BOOLEAN, False),
        StructField("clustering_algorithm", TEXT, False),
        StructField("min_cluster_size_param", LONG, False),
        StructField("clustering_created_at", TIME, False),
    ]),
    "products_enriched": StructType([
        StructField("product_id", LONG, False),
        StructField("cluster_id", LONG),
        StructField("cluster_label", TEXT),
        StructField("description_enriched", TEXT, False),
        StructField("description_model", TEXT, False),
        StructField("description_tone", TEXT, False),
        StructField("description_tokens_input", LONG),
        StructField("description_tokens_output", LONG),
        StructField("description_cost_usd", DOUBLE),
        StructField("description_created_at", TIME, False),
    ]),
    "quality_report": StructType([
        StructField("report_timestamp", TIME, False),
        StructField("total_records", LONG, False),
        StructField("valid_records", LONG, False),
        StructField("completeness_pct", DOUBLE, False),
        StructField("field_name_completeness", LONG),
        StructField("field_brand_completeness", LONG),
        StructField("field_cat_completeness", LONG),
        StructField("field_price_completeness", LONG),
        StructField("price_mean", DOUBLE),
        StructField("price_stddev", DOUBLE),
        StructField("price_min", DOUBLE),
        StructField("price_max", DOUBLE),
    ]),
    "pipeline_runs": StructType([
        StructField("run_id", TEXT, False),
        StructField("started_at", TIME, False),
        StructField("completed_at", TIME),
        StructField("status", TEXT, False),
        StructField("products_processed", LONG),
        StructField("clusters_created", LONG),
        StructField("error_message", TEXT),
    ]),
}


def enforce_schema(df: DataFrame, table: str) -> DataFrame:
    """Declared order and types; a NULL in a NOT NULL column fails the job that reads it."""
    out = []
    for field in TABLES[table]:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"{table}.{field.name} is NULL")
            value = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return df.select(*out)
