"""Catalogue tables derived from the given tables.

The texts run unchanged in Spark SQL and in DuckDB; `{name}` marks a table.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.datetime(2001, 11, 4)

SOURCE_PRODUCTS = """
SELECT p_partkey AS id,
 CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '' WHEN p_partkey % 83 = 0 THEN '   ' WHEN p_partkey % 3 = 0 THEN chr(9) || p_name || chr(10) || chr(160) ELSE ' ' || p_name END AS name,
 CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN ' ' || chr(9) || chr(160) ELSE p_brand END AS brand,
 CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN ' ' WHEN p_type = 'LARGE' THEN ' Large' WHEN p_partkey % 5 = 0 THEN lower(p_type) WHEN p_partkey % 11 = 0 THEN chr(160) || p_type || chr(13) ELSE p_type END AS category,
 CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_size <= 16 THEN ' women' WHEN p_size <= 33 THEN 'Men ' ELSE 'kids' END AS department,
 CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN CAST(-1 AS DOUBLE) WHEN p_partkey % 23 = 0 THEN CAST(250000 AS DOUBLE) ELSE p_retailprice END AS retail_price,
 CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN CAST(-5 AS DOUBLE) WHEN p_partkey % 7 = 0 THEN p_retailprice * 2 ELSE p_retailprice * 0.5 END AS cost
FROM {part}
UNION ALL
SELECT p_partkey, p_name, p_brand, CASE WHEN p_type = 'LARGE' THEN ' Large' ELSE p_type END, 'kids', p_retailprice, p_retailprice * 0.25
FROM {part} WHERE p_partkey % 43 = 0
"""

PRODUCTS_CLUSTERED = """
SELECT vec_id AS product_id,
 CASE WHEN label = 9 THEN -1 ELSE label END AS cluster_id,
 CASE WHEN label = 9 THEN NULL WHEN label IN (7, 8) THEN 'Shared Family' ELSE 'Family ' || CAST(label AS VARCHAR(10)) END AS cluster_label
FROM {embeddings}
"""

ORDER_ITEMS = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_shipdate AS created_at, l_extendedprice AS sale_price
FROM {lineitem}
"""

PRODUCTS_EMBEDDED = """
SELECT vec_id AS product_id, CAST(embedding AS {vector}) AS embedding FROM {embeddings}
"""

PRODUCTS_ENRICHED = """
SELECT vec_id AS product_id, 'Description ' || CAST(vec_id AS VARCHAR(10)) AS description_enriched, TIMESTAMP '2001-11-01 00:00:00' AS description_created_at
FROM {embeddings} WHERE vec_id % 10 <> 0
UNION ALL
SELECT vec_id, 'Newer description ' || CAST(vec_id AS VARCHAR(10)), TIMESTAMP '2001-11-02 00:00:00'
FROM {embeddings} WHERE vec_id % 50 = 1
"""

# Nine clear clusters; label 9 is noise. The test on n keeps it a column of its own: inlined into the
# lambda it would be computed anew for every element.
PLANTED_SPARK = """
SELECT vec_id AS product_id, label, CASE WHEN n > 0 THEN transform(u, x -> x / n) END AS embedding FROM (
 SELECT vec_id, label, u, sqrt(aggregate(u, 0D, (a, x) -> a + x * x)) AS n FROM (
  SELECT vec_id, label, transform(embedding, (x, i) -> CAST(x AS DOUBLE) + CASE WHEN i = label AND label <> 9 THEN 2D ELSE 0D END) AS u FROM {embeddings}) a) b
"""

PLANTED_DUCKDB = """
SELECT vec_id AS product_id, label, list_transform(u, lambda x: x / n) AS embedding FROM (
 SELECT vec_id, label, u, sqrt(list_sum(list_transform(u, lambda x: x * x))) AS n FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + CASE WHEN i = label + 1 AND label <> 9 THEN 2 ELSE 0 END) AS u FROM {embeddings}) a) b
"""

# Every product as a search text, in the phrasings the price rules know, and every conversation text.
QUERY_LOG = """
SELECT p_partkey AS query_id, CASE p_partkey % 14
  WHEN 0 THEN p_name || ' moins de ' || price || '$' WHEN 1 THEN p_name || ' Under $' || price
  WHEN 2 THEN p_name || ' max ' || price || ',50€' WHEN 3 THEN p_name || ' ' || price || '$ max'
  WHEN 4 THEN p_name || ' jusqu''à ' || price WHEN 5 THEN 'pas plus de ' || price || ' ' || p_name
  WHEN 6 THEN 'plus de ' || price || '$ ' || p_name WHEN 7 THEN p_name || ' over $' || price
  WHEN 8 THEN p_name || ' min ' || price || '.25' WHEN 9 THEN 'Au moins ' || price || ' ' || p_name
  WHEN 10 THEN p_name || ' à partir de ' || price WHEN 11 THEN p_name || ' entre 20 et ' || price
  WHEN 12 THEN 'between 900 and ' || price || ' ' || p_name ELSE p_name || ' robe d''été' END AS query
FROM (SELECT p_partkey, p_name, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR(20)) AS price FROM {part}) p
"""

SEARCH_TEXTS = QUERY_LOG + """
UNION ALL
SELECT -1 - (conv_id * 1000 + turn) AS query_id, text AS query FROM {conversations}
"""

# The event stream read as run events: a user is a run, errors are failures, purchases are finishes.
RUN_EVENTS = """
SELECT ts AS event_at, CAST(user_id AS VARCHAR(20)) AS run_id, event_type, event_id, value, props FROM {events}
"""

# A JSON reply per product (`{{` stands for one brace); every third lacks the price range, every fifth the action.
REPLIES = """
SELECT p_partkey AS reply_id, '{{"positioning": "' || p_name || '"' ||
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ', "price_range": "€' || CAST(p_size AS VARCHAR(20)) || '"' END ||
 CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ', "buyer_action": "Buy ' || p_brand || '"' END || '}}' AS reply
FROM {part}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str, **values: str) -> DataFrame:
    """Run a derivation over the Parquet tables it marks."""
    names = ("part", "embeddings", "lineitem", "events", "conversations", "documents")
    marked = {n: table(spark, sf_dir, n) for n in names if "{" + n + "}" in text}
    for mark, value in values.items():
        text = text.replace("{" + mark + "}", value)
    return spark.sql(text, **marked)
