"""SQL for DuckDB that says what each registered query returns."""

import re

from assortment import fixed
from assortment.sources import fixtures


def _fixture(text: str, **values: str) -> str:
    for mark, value in values.items():
        text = text.replace("{" + mark + "}", value)
    return re.sub(r"\{(\w+)\}", r"\1", text)


def stripped(text: str) -> str:
    """Outer white space of any kind removed."""
    blank = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    return f"regexp_replace({text}, '\\A{blank}+|{blank}+\\z', '', 'g')"


def r2(value: str) -> str:
    return f"floor(({value}) * 100 + 0.5 + 1e-7) / 100"


QUALITY = (
    "completeness_pct* field_brand_completeness field_cat_completeness field_name_completeness field_price_completeness "
    "price_max* price_mean* price_min* total_records valid_records"
)


def as_text(name: str, frames: dict[str, tuple[str, str]]) -> str:
    """Rows as text: columns in order of their names, those with a star as hundredths."""
    parts = []
    for key, (columns, source) in frames.items():
        texts = [f"CAST(floor({c[:-1]} * 100 + 0.5) AS BIGINT)" if c.endswith("*") else c for c in columns.split()]
        line = " || '|' || ".join(f"coalesce(CAST({t} AS VARCHAR), '-')" for t in texts)
        parts.append(f"SELECT '{key}' AS {name}, {line} AS line FROM {source}")
    return " UNION ALL ".join(parts)


# Common table expressions by name; a query pulls in those it mentions.
CTE: dict[str, str] = {
    "source_products": _fixture(fixtures.SOURCE_PRODUCTS),
    "products_clustered": _fixture(fixtures.PRODUCTS_CLUSTERED),
    "order_items": _fixture(fixtures.ORDER_ITEMS),
    "products_embedded": _fixture(fixtures.PRODUCTS_EMBEDDED, vector="DOUBLE[]"),
    "products_enriched": _fixture(fixtures.PRODUCTS_ENRICHED),
    "planted": _fixture(fixtures.PLANTED_DUCKDB),
    "query_log": _fixture(fixtures.QUERY_LOG),
    "search_texts": _fixture(fixtures.SEARCH_TEXTS),
    "deduped": """
SELECT * EXCLUDE (rn) FROM (
 SELECT id AS product_id, * EXCLUDE (id), row_number() OVER (PARTITION BY id ORDER BY cost NULLS LAST, retail_price NULLS LAST,
  name NULLS LAST, brand NULLS LAST, category NULLS LAST, department NULLS LAST) AS rn FROM source_products)
WHERE rn = 1""",
    "products_raw": """
SELECT * EXCLUDE (rn) FROM (
 SELECT id AS product_id, * EXCLUDE (id), row_number() OVER (PARTITION BY id ORDER BY cost NULLS LAST, retail_price NULLS LAST,
  name NULLS LAST, brand NULLS LAST, category NULLS LAST, department NULLS LAST) AS rn
 FROM source_products WHERE id IS NOT NULL AND name <> '' AND category <> '')
WHERE rn = 1""",
    "normalised": f"""
SELECT product_id, upper({stripped("name")}) AS name, coalesce(nullif(upper({stripped("brand")}), ''), 'UNBRANDED') AS brand,
 upper({stripped("category")}) AS category, coalesce(nullif(upper({stripped("department")}), ''), 'GENERAL') AS department,
 retail_price, cost FROM products_raw""",
    "medians": """
SELECT category, quantile_disc(retail_price, 0.5) AS median_price FROM products_raw
WHERE retail_price > 0 AND retail_price < 100000 GROUP BY category""",
    "medians_normalised": f"""
SELECT upper({stripped("category")}) AS category, quantile_disc(retail_price, 0.5) AS median_price FROM products_raw
WHERE retail_price > 0 AND retail_price < 100000 GROUP BY 1""",
}


def _cleaning(prefix: str, medians: str) -> None:
    """The cleaning chain over one kind of median."""
    CTE[prefix + "imputed"] = f"""
SELECT n.* REPLACE (CASE WHEN retail_price > 0 AND retail_price < 100000 THEN retail_price
 ELSE coalesce(m.median_price, CAST(9.99 AS DOUBLE)) END AS retail_price)
FROM normalised n LEFT JOIN {medians} m ON n.category = m.category"""
    CTE[prefix + "repaired"] = f"""
SELECT * REPLACE (CASE WHEN cost IS NULL OR cost < 0 THEN CAST(0 AS DOUBLE) WHEN cost > retail_price THEN retail_price * 0.5
 ELSE cost END AS cost) FROM {prefix}imputed"""
    CTE[prefix + "products_clean"] = f"""
SELECT *, CASE WHEN retail_price > 0 THEN {r2("(retail_price - cost) / retail_price * 100")} END AS margin_pct,
 (name IS NOT NULL AND name <> '' AND brand <> '' AND category IS NOT NULL AND category <> '' AND department <> ''
  AND retail_price > 0 AND retail_price < 100000 AND cost >= 0 AND cost <= retail_price) AS is_valid,
 nullif(CAST(to_json(list_filter([
  CASE WHEN name IS NULL OR name = '' THEN 'ERR_MISSING_NAME' END,
  CASE WHEN retail_price <= 0 THEN 'ERR_INVALID_PRICE' END,
  CASE WHEN retail_price >= 100000 THEN 'ERR_PRICE_TOO_HIGH' END,
  CASE WHEN cost < 0 THEN 'ERR_NEGATIVE_COST' END,
  CASE WHEN cost > retail_price THEN 'ERR_COST_GT_PRICE' END], lambda x: x IS NOT NULL)) AS VARCHAR), '[]') AS validation_errors
FROM {prefix}repaired"""
    CTE[prefix + "snapshot"] = f"""
SELECT count(*) AS total_records, count(*) FILTER (is_valid) AS valid_records,
 {r2("100.0 * count(*) FILTER (is_valid) / CAST(count(*) AS DOUBLE)")} AS completeness_pct,
 count(*) FILTER (name <> '') AS field_name_completeness, count(*) FILTER (brand <> '') AS field_brand_completeness,
 count(*) FILTER (category <> '') AS field_cat_completeness, count(*) FILTER (retail_price > 0) AS field_price_completeness,
 {r2("avg(retail_price)")} AS price_mean, {r2("stddev_samp(retail_price)")} AS price_stddev,
 min(retail_price) AS price_min, max(retail_price) AS price_max FROM {prefix}products_clean"""


_cleaning("", "medians")
_cleaning("older_", "medians_normalised")

CTE |= {
    "quality_report": """
SELECT TIMESTAMP '2000-11-04 00:00:00' AS report_timestamp, * FROM older_snapshot
UNION ALL SELECT TIMESTAMP '2001-11-04 00:00:00', * FROM snapshot""",
    "data_quality": """
SELECT * EXCLUDE (report_timestamp, price_stddev) FROM quality_report ORDER BY report_timestamp DESC LIMIT 1""",
    "catalogue": """
SELECT product_id, name, brand, retail_price, cluster_id, cluster_label
FROM products_clean JOIN products_clustered USING (product_id) WHERE cluster_id <> -1""",
    "cluster_distribution": f"""
SELECT cluster_id, cluster_label, count(DISTINCT product_id) AS product_count, {r2("avg(retail_price)")} AS avg_price
FROM catalogue GROUP BY cluster_id, cluster_label""",
    "brands_per_cluster": """
SELECT cluster_label, brand, product_count FROM (
 SELECT cluster_label, brand, count(DISTINCT product_id) AS product_count,
  row_number() OVER (PARTITION BY cluster_label ORDER BY count(DISTINCT product_id) DESC, brand) AS rn
 FROM catalogue GROUP BY cluster_label, brand) WHERE rn <= 10""",
    "pricing_per_cluster": f"""
SELECT cluster_label, count(DISTINCT product_id) AS product_count, {r2("avg(retail_price)")} AS avg_price,
 min(retail_price) AS price_min, max(retail_price) AS price_max, {r2("stddev_samp(retail_price)")} AS price_stddev
FROM catalogue GROUP BY cluster_label""",
    "sales_timeline": f"""
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS sale_date, cluster_label, count(DISTINCT order_id) AS sales_count,
 {r2("sum(sale_price)")} AS sales_revenue
FROM order_items JOIN catalogue USING (product_id)
WHERE created_at >= TIMESTAMP '2001-11-04 00:00:00' - INTERVAL 180 DAY GROUP BY 1, 2""",
    "heatmap": f"""
SELECT category, department, count(DISTINCT product_id) AS product_count, {r2("avg(retail_price)")} AS avg_price
FROM products_clean GROUP BY category, department""",
    "brands_chart": """
SELECT * FROM brands_per_cluster ORDER BY cluster_label NULLS FIRST, product_count DESC, brand LIMIT 100""",
    "newest_descriptions": """
SELECT product_id, description_enriched FROM (
 SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY description_created_at DESC, description_enriched) AS rn
 FROM products_enriched) WHERE rn = 1""",
    "cluster_products": """
SELECT product_id, name, brand, retail_price, description_enriched, cluster_id,
 coalesce(nullif(cluster_label, ''), 'Cluster ' || cluster_id) AS cluster_label
FROM products_clustered JOIN products_clean USING (product_id) LEFT JOIN newest_descriptions USING (product_id)
WHERE cluster_id = 3 ORDER BY retail_price DESC, product_id LIMIT 200""",
    "clusters_list": """
SELECT * REPLACE (coalesce(nullif(cluster_label, ''), 'Cluster ' || cluster_id) AS cluster_label) FROM cluster_distribution""",
}

ORACLES: dict[str, str] = {
    "dedupe_products": "SELECT * FROM deduped",
    "stage_products": "SELECT *, '2001-11-04' AS ingestion_date FROM products_raw",
    "staging_checks": """
SELECT count(*) AS total_rows, count(*) FILTER (product_id IS NULL) AS null_product_ids,
 count(*) FILTER (name IS NULL OR name = '') AS null_names, count(*) FILTER (category IS NULL OR category = '') AS null_categories,
 count(DISTINCT product_id) AS distinct_product_ids FROM products_raw""",
    "normalise_strings": "SELECT * FROM normalised",
    "category_median": "SELECT * FROM medians",
    "category_median_normalised": "SELECT * FROM medians_normalised",
    "impute_price": "SELECT product_id, category, retail_price, cost FROM imputed",
    "repair_cost": "SELECT product_id, retail_price, cost FROM repaired",
    "margin_pct": "SELECT product_id, retail_price, cost, margin_pct FROM products_clean",
    "is_valid": "SELECT product_id, is_valid FROM products_clean",
    "validation_errors": "SELECT product_id, validation_errors FROM products_clean",
    "clean_products": "SELECT * FROM products_clean",
    "transform_checks": f"""
SELECT count(*) AS total_rows, count(*) FILTER (is_valid) AS valid_rows, count(*) FILTER (NOT is_valid) AS invalid_rows,
 {r2("100.0 * count(*) FILTER (is_valid) / CAST(count(*) AS DOUBLE)")} AS validity_pct,
 count(*) FILTER (brand = 'UNBRANDED') AS unbranded_count, count(*) FILTER (department = 'GENERAL') AS general_dept_count,
 min(retail_price) AS price_min, max(retail_price) AS price_max, {r2("avg(retail_price)")} AS price_avg FROM products_clean""",
    "run_sql_layers": """
SELECT 'products_raw' AS layer, count(*) AS record_count FROM products_raw
UNION ALL SELECT 'products_clean', count(*) FROM products_clean""",
    "title_case_names": """
SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
 lambda w: upper(w[1]) || substr(w, 2)), ' ') AS title FROM part""",
    "quality_snapshot": "SELECT * FROM snapshot",
    "data_quality_latest": "SELECT * FROM data_quality",
    "layer_counts": """
SELECT 'products_clean' AS layer, count(*) AS record_count FROM products_clean
UNION ALL SELECT 'products_embedded', count(*) FROM products_embedded
UNION ALL SELECT 'products_clustered', count(*) FROM products_clustered
UNION ALL SELECT 'products_enriched', count(*) FROM products_enriched""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS layer, count(*) AS record_count FROM {t}"
        for t in ("part", "lineitem", "embeddings", "events", "documents", "conversations")
    ),
    "latest_runs": """
SELECT run_id, status, CAST(CASE WHEN status = 'COMPLETE' THEN event_id END AS BIGINT) AS products_processed,
 CAST(CASE WHEN status = 'COMPLETE' THEN floor(value) END AS BIGINT) AS clusters_created,
 CASE WHEN status = 'FAILED' THEN substr(replace('can''t read ' || props, '''', '\\'''), 1, 500) END AS error_message
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_at DESC, status <> 'IN_PROGRESS' DESC, status) AS rn FROM (
 SELECT ts AS event_at, CAST(user_id AS VARCHAR) AS run_id, event_id, value, props,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETE' ELSE 'IN_PROGRESS' END AS status FROM events))
WHERE rn = 1""",
    "cluster_distribution": "SELECT * FROM cluster_distribution",
    "brands_per_cluster": "SELECT * FROM brands_per_cluster",
    "pricing_per_cluster": "SELECT * FROM pricing_per_cluster",
    "sales_timeline": "SELECT * FROM sales_timeline",
    "heatmap_cat_dept": "SELECT * FROM heatmap",
    "top_clusters_chart": """
SELECT cluster_label, product_count, avg_price FROM cluster_distribution
ORDER BY product_count DESC, cluster_id, cluster_label LIMIT 40""",
    "top_pricing_chart": """
SELECT cluster_label, avg_price, price_min, price_max, product_count FROM pricing_per_cluster
ORDER BY avg_price DESC, cluster_label LIMIT 20""",
    "heatmap_chart": "SELECT category, department, product_count, avg_price FROM heatmap",
    "quality_chart": "SELECT * FROM data_quality",
    "timeline_chart": "SELECT sale_date, cluster_label, sales_count, sales_revenue FROM sales_timeline",
    "brands_chart": "SELECT * FROM brands_chart",
    "brand_cards": """
SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY cluster_label) AS card,
 row_number() OVER (PARTITION BY cluster_label ORDER BY product_count DESC, brand) AS position FROM brands_chart)
WHERE card <= 6 AND position <= 5""",
    "timeline_daily": """
SELECT sale_date, CAST(sum(sales_count) AS BIGINT) AS sales_count FROM sales_timeline GROUP BY sale_date""",
    "heatmap_matrix": "SELECT category, " + ", ".join(
        f"CAST(coalesce(sum(product_count) FILTER (department = '{d}'), 0) AS BIGINT) AS \"{d}\""
        for d in ("GENERAL", "KIDS", "MEN", "WOMEN")
    ) + " FROM heatmap GROUP BY category",
    "heatmap_intensity": """
SELECT category, department, product_count,
 product_count / CAST((SELECT greatest(max(product_count), 1) FROM heatmap) AS DOUBLE) AS intensity FROM heatmap""",
    "kpi_cards": "SELECT *, " + ", ".join(
        f"CASE WHEN {f}_pct >= 80 THEN 'green' WHEN {f}_pct >= 50 THEN 'accent' ELSE 'red' END AS {f}_band"
        for f in ("name", "brand", "cat", "price")
    ) + " FROM (SELECT total_records, valid_records, completeness_pct, price_mean, price_min, price_max, " + ", ".join(
        f"CAST(floor(field_{f}_completeness / CAST(total_records AS DOUBLE) * 100 + 0.5) AS BIGINT) AS {f}_pct"
        for f in ("name", "brand", "cat", "price")
    ) + " FROM data_quality)",
    "cluster_products": "SELECT * FROM cluster_products",
    "cluster_header": f"SELECT count(*) AS product_count, {r2('avg(retail_price)')} AS avg_price FROM cluster_products",
    "clusters_list": "SELECT * FROM clusters_list",
    "cluster_page": """
SELECT *, (SELECT CAST(ceil(count(*) / 30.0) AS BIGINT) FROM clusters_list WHERE contains(lower(cluster_label), 'family')) AS total_pages
FROM clusters_list WHERE contains(lower(cluster_label), 'family')
ORDER BY product_count DESC, cluster_id LIMIT 30""",
    "dashboard_bundle": as_text("chart", {
        "cluster_distribution": ("avg_price* cluster_label product_count",
            "(SELECT * FROM cluster_distribution ORDER BY product_count DESC, cluster_id, cluster_label LIMIT 40)"),
        "pricing": ("avg_price* cluster_label price_max* price_min* product_count",
            "(SELECT * FROM pricing_per_cluster ORDER BY avg_price DESC, cluster_label LIMIT 20)"),
        "heatmap": ("avg_price* category department product_count", "heatmap"),
        "quality": (QUALITY, "data_quality"),
        "timeline": ("cluster_label sale_date sales_count sales_revenue*", "sales_timeline"),
        "brands": ("brand cluster_label product_count", "brands_chart"),
    }),
    "registered_views": as_text("view", {
        "assortment_cluster_distribution": ("avg_price* cluster_id cluster_label product_count", "cluster_distribution"),
        "assortment_brands_per_cluster": ("brand cluster_label product_count", "brands_per_cluster"),
        "assortment_pricing_per_cluster": ("avg_price* cluster_label price_max* price_min* price_stddev* product_count", "pricing_per_cluster"),
        "assortment_data_quality": (QUALITY.replace("total", "report_timestamp total"),
            "(SELECT * FROM quality_report ORDER BY report_timestamp DESC LIMIT 1)"),
        "assortment_sales_timeline": ("cluster_label sale_date sales_count sales_revenue*", "sales_timeline"),
        "assortment_heatmap_cat_dept": ("avg_price* category department product_count", "heatmap"),
    }),
}

# --- quality rules: name -> (rule id, observed, limit) ----------------------------
_CLEAN_COUNT = "(SELECT count(*) FROM products_clean WHERE {})"
_MISSING = "(SELECT count(*) FROM products_clean WHERE product_id NOT IN (SELECT product_id FROM {}))"
_SHARE = "(SELECT ceil(CAST({} AS DOUBLE) * count(*)) FROM products_clean)"
_RULES = {
    "rule_unique_ids": (
        "ASSERT_01", "(SELECT count(*) FROM (SELECT 1 FROM products_clean GROUP BY product_id HAVING count(*) > 1))", "0"),
    "rule_mandatory_fields": ("ASSERT_02", _CLEAN_COUNT.format(
        "name IS NULL OR name = '' OR brand IS NULL OR brand = '' OR category IS NULL OR category = '' "
        "OR department IS NULL OR department = ''"), "0"),
    "rule_no_negative_amounts": ("ASSERT_03", _CLEAN_COUNT.format("retail_price < 0 OR cost < 0"), "0"),
    "rule_cost_below_price": ("ASSERT_04", _CLEAN_COUNT.format("is_valid AND cost > retail_price"), "0"),
    "rule_price_range": ("ASSERT_05", _CLEAN_COUNT.format("retail_price <= 0 OR retail_price >= 100000"), "0"),
    "rule_embedding_coverage": ("ASSERT_06", _MISSING.format("products_embedded"), _SHARE.format(0.05)),
    "rule_vector_length": ("ASSERT_07", "(SELECT count(*) FROM products_embedded WHERE len(embedding) <> 1536)", "0"),
    "rule_vector_present": (
        "ASSERT_08", "(SELECT count(*) FROM products_embedded WHERE embedding IS NULL OR len(embedding) = 0)", "0"),
    "rule_clustering_coverage": ("ASSERT_09", _MISSING.format("products_clustered"), _SHARE.format(0.2)),
    "rule_cluster_size": ("ASSERT_10", """(SELECT count(*) FROM (
 SELECT 1 FROM products_clustered WHERE cluster_id <> -1 GROUP BY cluster_id HAVING count(*) < 15))""", "0"),
    "rule_cluster_count": (
        "ASSERT_11", "(SELECT count(DISTINCT cluster_id) FROM products_clustered WHERE cluster_id <> -1)", "10"),
    "rule_enrichment_coverage": ("ASSERT_12", _MISSING.format("products_enriched"), _SHARE.format(0.05)),
}
for _name, (_id, _observed, _limit) in _RULES.items():
    _test = ">=" if _id == "ASSERT_11" else "<="
    ORACLES[_name] = (
        f"SELECT '{_id}' AS rule_id, observed {_test} \"limit\" AS passed, observed, \"limit\" FROM "
        f"(SELECT CAST({_observed} AS BIGINT) AS observed, CAST({_limit} AS BIGINT) AS \"limit\")"
    )
ORACLES["run_rules"] = " UNION ALL ".join(f"({ORACLES[name]})" for name in _RULES)

# --- vectors, retrieval, texts, clusters ------------------------------------------


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, **values: str) -> str:
    """A fixed text with SQL expressions put into its marks."""
    parts = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return " || ".join(values[p] if i % 2 else _literal(p) for i, p in enumerate(parts))


TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
FIRST = "(SELECT embedding FROM products_embedded ORDER BY product_id LIMIT 1)"
NEAR = "round(list_cosine_distance({}, {}), 10)"


def _hashed(rows: str, key: str, text: str, dim: int = 64) -> str:
    """(key, place, value) of the hashed unit vectors."""
    return f"""
SELECT {key}, place, sum(coalesce(v, 0)) / any_value(n) AS value FROM (
 SELECT {key}, sqrt(sum(v * v)) AS n FROM {rows}_sums GROUP BY {key}) sizes
 JOIN (SELECT unnest(range({dim})) AS place) places ON n > 0
 LEFT JOIN {rows}_sums USING ({key}, place) GROUP BY {key}, place"""


def _sums(rows: str, key: str, text: str, dim: int = 64) -> str:
    return f"""
SELECT {key}, CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % {dim} AS place,
 CAST(sum(CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS v
FROM (SELECT {key}, unnest({TOKENS.format(text)}) AS t FROM {rows}) GROUP BY 1, 2"""


CTE |= {
    "documents_sums": _sums("documents", "doc_id", "text"),
    "embedding_texts": """
SELECT product_id, name || ' | ' || brand || ' | ' || category || ' | ' || department AS embedding_text FROM products_clean""",
    "pending": """
SELECT product_id, name, brand, category, department FROM products_clean
WHERE product_id NOT IN (SELECT product_id FROM products_embedded)""",
    "batches": """
SELECT product_id, embedding_text, position, CAST(floor(position / 250) AS BIGINT) AS batch FROM (
 SELECT product_id, embedding_text, row_number() OVER (ORDER BY product_id) - 1 AS position
 FROM embedding_texts WHERE product_id IN (SELECT product_id FROM pending))""",
    "all_batches": """
SELECT product_id, embedding_text, position, CAST(floor(position / 250) AS BIGINT) AS batch FROM (
 SELECT product_id, embedding_text, row_number() OVER (ORDER BY product_id) - 1 AS position FROM embedding_texts)""",
    "near": f"""
SELECT product_id, distance FROM (SELECT product_id, {NEAR.format("embedding", FIRST)} AS distance FROM products_embedded)""",
    "intent_hits": """
SELECT product_id, name, brand, retail_price, cluster_id, cluster_label, distance
FROM (SELECT * FROM near ORDER BY distance, product_id LIMIT 120) JOIN products_clean USING (product_id)
JOIN products_clustered USING (product_id) WHERE cluster_id <> -1""",
    "intent_clusters": """
SELECT cluster_id, count(*) AS hit_count, min(distance) AS nearest_distance, arg_min(product_id, (distance, product_id)) AS nearest_id
FROM intent_hits GROUP BY cluster_id ORDER BY hit_count DESC, nearest_distance, nearest_id LIMIT 5""",
    "intent_stats": f"""
SELECT cluster_id, min(cluster_label) AS cluster_label, count(*) AS products_total, {r2("avg(retail_price)")} AS avg_price,
 avg(retail_price) AS mean_price FROM products_clustered JOIN products_clean USING (product_id)
WHERE cluster_id IN (SELECT cluster_id FROM intent_clusters) GROUP BY cluster_id""",
    "intent_samples": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY distance, product_id) AS position FROM intent_hits)
WHERE position <= 5""",
    "enrichment_pending": """
SELECT p.product_id, name, brand, category, department, cluster_id, cluster_label
FROM products_clean p LEFT JOIN products_clustered c ON p.product_id = c.product_id
WHERE p.product_id NOT IN (SELECT product_id FROM products_enriched)""",
    "all_products": """
SELECT p.product_id, name, brand, category, department, cluster_id, cluster_label
FROM products_clean p LEFT JOIN products_clustered c ON p.product_id = c.product_id""",
    "graph": f"""
SELECT product_id, neighbour_id, distance, rank FROM (
 SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY distance, neighbour_id) AS rank FROM (
  SELECT a.product_id, b.product_id AS neighbour_id, {NEAR.format("a.embedding", "b.embedding")} AS distance
  FROM planted a JOIN planted b ON a.product_id <> b.product_id)) WHERE rank <= 15""",
    "cores": "SELECT product_id, distance AS core FROM graph WHERE rank = 10",
    "edges": """
SELECT a, b, greatest(ca.core, cb.core, distance) AS weight FROM (
 SELECT least(product_id, neighbour_id) AS a, greatest(product_id, neighbour_id) AS b, min(distance) AS distance
 FROM graph GROUP BY 1, 2) JOIN cores ca ON a = ca.product_id JOIN cores cb ON b = cb.product_id""",
    "samples": """
SELECT cluster_id, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY s.product_id) - 1 AS INTEGER) AS place,
 name || ' (' || category || ')' AS sample
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY product_id) AS rn FROM products_clustered WHERE cluster_id <> -1) s
JOIN products_clean USING (product_id) WHERE rn <= 20 QUALIFY place < 15""",
    "sample_words": f"""
SELECT cluster_id, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY word) AS total
FROM (SELECT cluster_id, unnest({TOKENS.format("name || ' ' || category")}) AS word
 FROM (SELECT * FROM products_clustered WHERE cluster_id <> -1) JOIN products_clean USING (product_id)) GROUP BY cluster_id, word""",
}


def _exact(base: str, asked: str, k: int) -> str:
    """The k nearest rows of a base table for each row of another, distances to six decimals."""
    return f"""
SELECT query_id, product_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, product_id) AS rank FROM (
  SELECT q.product_id AS query_id, b.product_id, {NEAR.format("q.embedding", "b.embedding")} AS distance
  FROM {asked} q CROSS JOIN {base} b)) WHERE rank <= {k}"""


def _prompt(cluster: str = "cluster_label") -> str:
    sentence = f"CASE WHEN {cluster} <> '' THEN " + _filled(fixed.CLUSTER_SENTENCE, cluster_label=cluster) + " ELSE '' END"
    return _filled(
        fixed.DESCRIPTION_PROMPT, name="name", brand="brand", category="category", department="department",
        cluster=sentence,
    )


_TEXT = "name || ' by ' || brand || ', ' || category || ' / ' || department"
_TOKENS_IN, _TOKENS_OUT = f"len({TOKENS.format(_prompt())})", f"len({TOKENS.format(_TEXT)})"
_SPLIT = f"""
SELECT product_id, embedding_text, batch, batch_tokens, CAST(floor(batch_tokens / CAST(n AS DOUBLE))
 + CASE WHEN position = last THEN batch_tokens - floor(batch_tokens / CAST(n AS DOUBLE)) * n ELSE 0 END AS BIGINT) AS embedding_tokens
FROM (SELECT *, count(*) OVER (PARTITION BY batch) AS n, max(position) OVER (PARTITION BY batch) AS last,
 CAST(sum(len({TOKENS.format("embedding_text")})) OVER (PARTITION BY batch) AS BIGINT) AS batch_tokens FROM {{}})"""
_SEARCH = f"""
SELECT product_id, name, brand, category, department, retail_price, cluster_label, description_enriched, round(distance, 6) AS distance
FROM {{}} JOIN products_clean USING (product_id) LEFT JOIN products_clustered USING (product_id)
LEFT JOIN newest_descriptions USING (product_id) WHERE retail_price <= 990 AND retail_price >= 905
ORDER BY distance, product_id LIMIT 20"""


def _described(pending: str, cluster_id: str) -> str:
    return f"""
SELECT product_id, CAST(NULL AS BIGINT) AS cluster_id, CAST(NULL AS VARCHAR) AS cluster_label, description_enriched,
 'given' AS description_model, CAST(0 AS BIGINT) AS description_tokens_input, CAST(0 AS BIGINT) AS description_tokens_output
FROM products_enriched UNION ALL
SELECT product_id, CAST({cluster_id} AS BIGINT), cluster_label, {stripped(_TEXT)}, 'template', {_TOKENS_IN}, {_TOKENS_OUT} FROM {pending}"""


def _limit(pattern: str, group: int = 1) -> str:
    found = f"nullif(regexp_extract(lower(query), {_literal(pattern)}, {group}), '')"
    return f"CAST(replace({found}, ',', '.') AS DOUBLE)"


# The price phrases once more, written out, so that a wrong pattern in the code shows.
_GAP = r"[\s\x{0b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*[$€£]?" + (
    r"[\s\x{0b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*"
)
_BLANKS = _GAP.split("[$")[0]
_NUMBER = r"(\d+[,.]\d+|\d+)"
_CHEAPER = r"(?:moins de|under|maximum|max|jusqu'à|jusqu`à|jusquà|pas plus de|au dessus de)"
_DEARER = r"(?:plus de|over|minimum|min|au moins|à partir de)"
_PHRASES = {
    "range": "(?:entre|between)" + _GAP + _NUMBER + _BLANKS + "(?:et|and|-)" + _GAP + _NUMBER,
    "max_before": _CHEAPER + _GAP + _NUMBER, "max_after": _NUMBER + _GAP + "(?:maximum|max|ou moins|et moins)",
    "min_before": _DEARER + _GAP + _NUMBER, "min_after": _NUMBER + _GAP + "(?:minimum|min|ou plus|et plus)",
}


def _limits() -> tuple[str, str]:
    p = _PHRASES
    low = f"coalesce({_limit(p['range'], 1)}, {_limit(p['min_before'])}, {_limit(p['min_after'])})"
    high = f"coalesce({_limit(p['range'], 2)}, {_limit(p['max_before'])}, {_limit(p['max_after'])})"
    return low, high


CTE["priced_log"] = "SELECT query_id, {} AS min_price, {} AS max_price FROM search_texts".format(*_limits())
CTE["search_texts_sums"] = _sums("search_texts", "query_id", "query")
CTE["embedding_texts_sums"] = _sums("embedding_texts", "product_id", "embedding_text")
CTE["query_vectors"] = f"""
SELECT query_id, list(value ORDER BY place) AS embedding FROM ({_hashed("search_texts", "query_id", "query")}) GROUP BY query_id"""
_CHECKSUM = f"""
SELECT product_id, round(sum(value * (place + 1)), 6) + CAST(0 AS DOUBLE) AS checksum
FROM ({_hashed("embedding_texts", "product_id", "embedding_text")}) GROUP BY product_id"""
CTE["product_vectors"] = f"""
SELECT product_id, list(value ORDER BY place) AS embedding FROM ({_hashed("embedding_texts", "product_id", "embedding_text")})
GROUP BY product_id"""

ORACLES |= {
    "cosine_distance": """
SELECT product_id, round(list_cosine_distance(e.embedding, p.embedding), 6) AS distance
FROM products_embedded e JOIN planted p USING (product_id)""",
    "vector_top_k": "SELECT product_id, round(distance, 6) AS distance FROM near ORDER BY near.distance, product_id LIMIT 25",
    "vector_top_k_batch": _exact("products_embedded", "planted", 5),
    "ivf_build": "SELECT product_id, true AS in_nearest_list FROM planted",
    "ivf_search": "SELECT CAST(rank AS INTEGER) AS rank, true AS same FROM (SELECT unnest(range(1, 11)) AS rank)",
    "ivf_search_all_lists": f"""
SELECT product_id, round(distance, 6) AS distance FROM (SELECT product_id, {NEAR.format("embedding", FIRST)} AS distance FROM planted) p
ORDER BY p.distance, product_id LIMIT 25""",
    "ivf_search_batch": _exact("planted", "planted", 5),
    "index_coverage": f"""
SELECT 'vector_lists' AS index_name, 'products_clean' AS table_name, 'ACTIVE' AS index_status,
 {r2("100.0 * count(*) FILTER (product_id IN (SELECT product_id FROM products_embedded)) / CAST(count(*) AS DOUBLE)")} AS coverage_percentage
FROM products_clean""",
    "search_products": _SEARCH.replace("{}", "(SELECT * FROM near ORDER BY distance, product_id LIMIT 100)"),
    "search_products_prefilter": _SEARCH.replace("{}", "near"),
    "intent_hits": "SELECT * REPLACE (round(distance, 6) AS distance) FROM intent_hits",
    "intent_clusters": "SELECT * REPLACE (round(nearest_distance, 6) AS nearest_distance) FROM intent_clusters",
    "intent_stats": "SELECT * EXCLUDE (mean_price) FROM intent_stats",
    "intent_briefs": """
SELECT cluster_id, coalesce(nullif(s.cluster_label, ''), 'Cluster ' || cluster_id) AS cluster_label, hit_count, products_total,
 avg_price, CAST(position AS INTEGER) AS position, product_id, name, brand, retail_price
FROM intent_clusters JOIN intent_stats s USING (cluster_id) JOIN (SELECT * EXCLUDE (cluster_label) FROM intent_samples) USING (cluster_id)""",
    "brief_prompt": "SELECT cluster_id, " + _filled(
        fixed.BRIEF_PROMPT, intent="'a gift under 50'", names="names", avg_price="printf('%.0f', mean_price)",
        cluster_label="coalesce(nullif(s.cluster_label, ''), 'Cluster ' || cluster_id)",
    ) + """ AS prompt FROM intent_clusters JOIN intent_stats s USING (cluster_id)
JOIN (SELECT cluster_id, string_agg(name, ', ' ORDER BY position) AS names FROM intent_samples GROUP BY cluster_id) USING (cluster_id)""",
    "parse_brief": "SELECT p_partkey AS reply_id, p_name AS positioning, "
    "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '€' || p_size END AS price_range, "
    "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Buy ' || p_brand END AS buyer_action FROM part",
    "price_constraints": "SELECT query_id, {} AS min_price, {} AS max_price FROM search_texts".format(*_limits()),
    "search_log": f"""
SELECT query_id, min_price, max_price, CAST(place AS INTEGER) AS rank, product_id, name, brand, category, department, retail_price, cluster_label,
 description_enriched, round(distance, 6) AS distance FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, product_id) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, product_id) AS near_rank FROM (
   SELECT q.query_id, b.product_id, {NEAR.format("q.embedding", "b.embedding")} AS distance
   FROM query_vectors q CROSS JOIN product_vectors b)) JOIN priced_log USING (query_id) JOIN products_clean USING (product_id)
 WHERE near_rank <= CASE WHEN min_price IS NULL AND max_price IS NULL THEN 3 ELSE 15 END
  AND coalesce(retail_price <= max_price, true) AND coalesce(retail_price >= min_price, true))
LEFT JOIN products_clustered USING (product_id) LEFT JOIN newest_descriptions USING (product_id) WHERE place <= 3""",
    "embedding_text": "SELECT * FROM embedding_texts",
    "pending_embedding": "SELECT * FROM pending",
    "assign_batches": "SELECT product_id, position, batch FROM batches",
    "split_batch_tokens": "SELECT * EXCLUDE (embedding_text) FROM (" + _SPLIT.replace("{}", "batches") + ")",
    "embedding_cost": "SELECT product_id, round(embedding_tokens * CAST(0.00000002 AS DOUBLE), 12) AS embedding_cost_usd FROM ("
    + _SPLIT.replace("{}", "batches") + ")",
    "embed_texts": "SELECT doc_id, CAST(place AS INTEGER) AS place, round(value, 6) AS value FROM ("
    + _hashed("documents", "doc_id", "text") + ")",
    "embed_incremental": """SELECT product_id, embedding_text, 'signed-feature-hashing' AS embedding_model, embedding_tokens,
 round(embedding_tokens * CAST(0.00000002 AS DOUBLE), 12) AS embedding_cost_usd, checksum FROM (""" + _SPLIT.replace("{}", "all_batches")
    + f") LEFT JOIN ({_CHECKSUM}) USING (product_id)",
    "incremental_stream": f"""SELECT product_id, embedding_text, checksum FROM embedding_texts LEFT JOIN ({_CHECKSUM}) USING (product_id)""",
    "pending_enrichment": "SELECT * FROM enrichment_pending",
    "description_prompt": f"SELECT product_id, {_prompt()} AS prompt FROM enrichment_pending",
    "generate_text": f"""
SELECT product_id, ' ' || right({_prompt()}, 12) || chr(9) AS text, length({_prompt()}) AS tokens_input, CAST(7 AS BIGINT) AS tokens_output
FROM enrichment_pending""",
    "generation_cost": f"""
SELECT count(*) AS enriched, round(sum({_TOKENS_IN} * CAST(0.00000015 AS DOUBLE) + {_TOKENS_OUT} * CAST(0.0000006 AS DOUBLE)), 4) AS total_cost_usd
FROM enrichment_pending""",
    "enrich_incremental": _described("enrichment_pending", "cluster_id"),
    "enrich_selected": _described("all_products", "NULL"),
    "knn_graph": "SELECT * REPLACE (round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank) FROM graph",
    "knn_graph_descent": "SELECT count(*) AS entries, true AS enough FROM graph WHERE product_id % 50 = 0",
    "core_distance": "SELECT product_id, round(core, 6) AS core FROM cores",
    "reachability_edges": "SELECT a, b, round(weight, 6) AS weight FROM edges",
    "components_at_level": """
SELECT product_id, min(reached) AS component FROM reach GROUP BY product_id""",
    "cluster_stats": """
SELECT count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS clusters, count(*) FILTER (cluster_id = -1) AS noise_points,
 count(*) AS total_products FROM products_clustered""",
    "label_samples": "SELECT * FROM samples",
    "label_prompt": "SELECT cluster_id, " + _filled(fixed.LABEL_PROMPT, samples="lines") + """ AS prompt FROM (
 SELECT cluster_id, string_agg('- ' || sample, chr(10) ORDER BY place) AS lines FROM samples GROUP BY cluster_id)""",
    "label_clusters": """
SELECT cluster_id, string_agg(upper(word[1]) || substr(word, 2), ' ' ORDER BY n / CAST(total AS DOUBLE) DESC, n DESC, word) AS cluster_label
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, word) AS rn FROM sample_words) WHERE rn <= 3 GROUP BY cluster_id""",
}
ORACLES["search_products_indexed"] = ORACLES["search_products"]
ORACLES["index_recall"] = "SELECT 20 * count(*) AS entries, true AS enough FROM products_embedded WHERE product_id % 50 = 0"
ORACLES["index_codes"] = "SELECT unnest([10, 50]) AS wanted, CAST(unnest([10, 50]) AS BIGINT) AS entries, true AS enough"
ORACLES["analyze_intent"] = f"""
SELECT cluster_id, coalesce(nullif(s.cluster_label, ''), 'Cluster ' || cluster_id) AS cluster_label, hit_count, products_total, avg_price,
 CAST(length(prompt) AS VARCHAR) AS positioning, CAST(length(prompt) - length(replace(prompt, '€', '')) AS VARCHAR) AS price_range,
 'ok' AS buyer_action FROM intent_clusters JOIN intent_stats s USING (cluster_id) JOIN ({ORACLES["brief_prompt"]}) USING (cluster_id)"""
CTE["even_prompts"] = f"SELECT DISTINCT {_prompt()} AS prompt FROM enrichment_pending WHERE product_id % 2 = 0"
ORACLES["generate_text_once"] = f"""
SELECT product_id, mark || ' ' || right(prompt, 12) AS text, length(prompt) AS tokens_input, CAST(mark AS BIGINT) AS tokens_output
FROM (SELECT product_id, p.prompt, CASE WHEN e.prompt IS NULL THEN 2 ELSE 1 END AS mark
 FROM (SELECT product_id, {_prompt()} AS prompt FROM enrichment_pending) p LEFT JOIN even_prompts e ON p.prompt = e.prompt)"""
CTE["cluster_words"] = f"""
SELECT cluster_id, product_id, {TOKENS.format("name || ' ' || category")} AS words
FROM (SELECT * FROM products_clustered WHERE cluster_id <> -1) JOIN products_clean USING (product_id)"""
CTE["phrase_counts"] = """
SELECT cluster_id, phrase, count(*) AS n FROM (
 SELECT DISTINCT cluster_id, product_id, array_to_string(words[s : s + k - 1], ' ') AS phrase
 FROM (SELECT cluster_id, product_id, words, unnest(range(1, len(words) + 1)) AS s FROM cluster_words), (SELECT unnest([1, 2, 3]) AS k)
 WHERE s + k - 1 <= len(words)) GROUP BY cluster_id, phrase"""
CTE["phrase_cells"] = """
SELECT cluster_id, phrase, n, CAST(n AS DOUBLE) AS a, CAST(sum(n) OVER (PARTITION BY phrase) AS DOUBLE) AS t,
 CAST(size AS DOUBLE) AS s, CAST((SELECT count(*) FROM cluster_words) AS DOUBLE) AS e
FROM phrase_counts JOIN (SELECT cluster_id, count(*) AS size FROM cluster_words GROUP BY cluster_id) USING (cluster_id)"""
CTE["contrasts"] = """
SELECT cluster_id, phrase, n, round((CASE WHEN a * e >= t * s THEN 1 ELSE -1 END) * 2 * (
  CASE WHEN a > 0 THEN a * ln(a * e / (t * s)) ELSE 0 END + CASE WHEN t - a > 0 THEN (t - a) * ln((t - a) * e / (t * (e - s))) ELSE 0 END
  + CASE WHEN s - a > 0 THEN (s - a) * ln((s - a) * e / ((e - t) * s)) ELSE 0 END
  + CASE WHEN e - s - t + a > 0 THEN (e - s - t + a) * ln((e - s - t + a) * e / ((e - t) * (e - s))) ELSE 0 END), 6) AS contrast
FROM phrase_cells"""
CTE["contrast_weakest"] = """
SELECT c.cluster_id, c.phrase, c.n, least(c.contrast, min(o.contrast)) AS weakest
FROM (SELECT *, unnest(string_split(phrase, ' ')) AS word FROM contrasts) c JOIN contrasts o ON o.cluster_id = c.cluster_id AND o.phrase = c.word
GROUP BY c.cluster_id, c.phrase, c.n, c.contrast"""
CTE["contrast_best"] = """
SELECT cluster_id, phrase FROM (SELECT *, row_number() OVER (
 PARTITION BY cluster_id ORDER BY weakest DESC, n DESC, len(string_split(phrase, ' ')) DESC, phrase) AS rn FROM contrast_weakest) WHERE rn = 1"""
CTE["contrast_second"] = """
SELECT cluster_id, phrase FROM (SELECT c.*, row_number() OVER (
 PARTITION BY cluster_id ORDER BY weakest DESC, n DESC, len(string_split(c.phrase, ' ')) DESC, c.phrase) AS rn
 FROM contrast_weakest c JOIN contrast_best b USING (cluster_id)
 WHERE len(string_split(c.phrase, ' ')) < 3 AND NOT list_has_any(string_split(c.phrase, ' '), string_split(b.phrase, ' '))) WHERE rn = 1"""
ORACLES["phrase_contrast"] = "SELECT cluster_id, phrase, n, contrast FROM contrasts"
ORACLES["contrast_labels"] = """
SELECT cluster_id, array_to_string(list_transform(string_split(concat_ws(' ', b.phrase, s.phrase), ' '),
 lambda w: upper(w[1]) || substr(w, 2)), ' ') AS cluster_label FROM contrast_best b LEFT JOIN contrast_second s USING (cluster_id)"""
CTE["linked"] = """
SELECT a, b FROM edges WHERE weight <= 0.4 UNION SELECT b, a FROM edges WHERE weight <= 0.4"""
CTE["reach"] = """
SELECT product_id, product_id AS reached FROM cores WHERE core <= 0.4
UNION SELECT l.b, r.reached FROM reach r JOIN linked l ON r.product_id = l.a"""

# --- cluster selection: Prim's order, its runs at every weight, stability bottom-up ----------------
#: Clusters of 15 rows or more lie at most this deep in the 500 vectors of the small folders.
_DEPTH = 500 // 15

CTE["edge_weights"] = "SELECT a, b, weight FROM edges UNION ALL SELECT b, a, weight FROM edges"
CTE["all_weights"] = f"""
SELECT a, b, greatest(ca.core, cb.core, distance) AS weight FROM (
 SELECT x.product_id AS a, y.product_id AS b, {NEAR.format("x.embedding", "y.embedding")} AS distance
 FROM planted x JOIN planted y ON x.product_id <> y.product_id)
JOIN cores ca ON a = ca.product_id JOIN cores cb ON b = cb.product_id"""


def _hierarchy(name: str, weights: str) -> dict[str, str]:
    """Steps from weights between rows to `{name}_found`. At any weight the components are runs of Prim's order."""
    steps = {
        "prim": """
SELECT 0 AS step, product_id AS node, CAST('infinity' AS DOUBLE) AS best, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS DOUBLE) AS gap FROM cores
UNION ALL
SELECT p.step + 1, p.node, least(p.best, coalesce(w.weight, p.best)), CASE WHEN p.node = c.node THEN p.step + 1 ELSE p.pos END,
 CASE WHEN p.node = c.node THEN p.best ELSE p.gap END
FROM @prim p CROSS JOIN (SELECT arg_min(node, (best, node)) AS node FROM @prim WHERE pos IS NULL) c
LEFT JOIN WEIGHTS w ON w.a = c.node AND w.b = p.node WHERE c.node IS NOT NULL""",
        "order": """
SELECT node, pos, greatest(gap, 0.000001) AS gap FROM @prim WHERE step = (SELECT max(step) FROM @prim)""",
        "levels": """
SELECT CAST(row_number() OVER (ORDER BY gap) AS INTEGER) AS level, gap AS eps FROM (SELECT DISTINCT gap FROM @order WHERE isfinite(gap))""",
        "runs": """
SELECT level, node, count(*) FILTER (gap > eps) OVER (PARTITION BY level ORDER BY pos) AS run FROM @order CROSS JOIN @levels""",
        "nodes": "SELECT level, node, min(node) OVER (PARTITION BY level, run) AS component FROM @runs",
        "big": "SELECT level, component, count(*) AS size FROM @nodes GROUP BY level, component HAVING count(*) >= 15",
        "tree": """
SELECT b.*, p.component AS parent FROM @big b LEFT JOIN @nodes p ON p.level = b.level + 1 AND p.node = b.component""",
        "openings": """
SELECT t.level, t.component, t.parent IS NULL OR k.children > 1 AS opens FROM @tree t
LEFT JOIN (SELECT level + 1 AS level, parent, count(*) AS children FROM @tree GROUP BY 1, 2) k
 ON k.level = t.level + 1 AND k.parent = t.parent""",
        "lines": """
SELECT b.level, b.component, b.size, o.level AS up_level, o.component AS up_component FROM @big b
JOIN @nodes n ON n.node = b.component AND n.level >= b.level
JOIN @openings o ON o.level = n.level AND o.component = n.component AND o.opens""",
        "tops": """
SELECT level, component, any_value(size) AS size, min(up_level) AS top_level, arg_min(up_component, up_level) AS top
FROM @lines GROUP BY level, component""",
        "stable": """
SELECT top_level, top, min(t.level) AS tight,
 round(sum(size * (1 / here.eps - coalesce(1 / looser.eps, 0))), 6) AS stability
FROM @tops t JOIN @levels here ON here.level = t.level LEFT JOIN @levels looser ON looser.level = t.level + 1
GROUP BY top_level, top""",
        "above": """
SELECT s.top_level, s.top, min(up_level) AS up_level, arg_min(up_component, up_level) AS up
FROM @stable s JOIN @lines l ON l.level = s.top_level AND l.component = s.top AND l.up_level > s.top_level GROUP BY 1, 2""",
        "best_0": "SELECT top_level, top, tight, stability, CAST(0 AS DOUBLE) AS below, stability AS best FROM @stable",
    }
    for step in range(1, _DEPTH + 1):
        steps[f"best_{step}"] = f"""
SELECT s.*, coalesce(c.below, 0) AS below, greatest(s.stability, coalesce(c.below, 0)) AS best FROM @stable s LEFT JOIN (
 SELECT a.up_level, a.up, round(sum(best), 6) AS below FROM @best_{step - 1} b JOIN @above a
 ON a.top_level = b.top_level AND a.top = b.top GROUP BY 1, 2) c ON c.up_level = s.top_level AND c.up = s.top"""
    steps |= {
        "kept": f"""
SELECT * FROM @best_{_DEPTH} b WHERE stability >= below AND NOT (
 NOT EXISTS (SELECT 1 FROM @above a WHERE a.top_level = b.top_level AND a.top = b.top)
 AND (SELECT count(*) FROM @stable) - (SELECT count(*) FROM @above) = 1)""",
        "chosen": """
SELECT top_level, top, tight, row_number() OVER (ORDER BY top) - 1 AS cluster_id FROM @kept k WHERE NOT EXISTS (
 SELECT 1 FROM @lines l JOIN @kept o ON o.top_level = l.up_level AND o.top = l.up_component
 WHERE l.level = k.top_level AND l.component = k.top AND l.up_level > k.top_level)""",
        "found": """
SELECT node AS product_id, cluster_id, round(min(tight.eps) / min(here.eps), 6) AS cluster_probability
FROM @nodes n JOIN @tops t ON t.level = n.level AND t.component = n.component
JOIN @chosen c ON c.top_level = t.top_level AND c.top = t.top
JOIN @levels here ON here.level = n.level JOIN @levels tight ON tight.level = c.tight GROUP BY node, cluster_id""",
    }
    return {f"{name}_{key}": sql.replace("@", f"{name}_").replace("WEIGHTS", weights) for key, sql in steps.items()}


CTE |= _hierarchy("graph_tree", "edge_weights") | _hierarchy("whole_tree", "all_weights")
CTE["assigned"] = """
SELECT p.product_id, coalesce(cluster_id, -1) AS cluster_id, coalesce(cluster_probability, 0) AS cluster_probability
FROM planted p LEFT JOIN whole_tree_found f ON f.product_id = p.product_id"""
CTE["assigned_sample_words"] = CTE["sample_words"].replace("products_clustered", "assigned")
_LABELS = ORACLES["label_clusters"]
ORACLES |= {
    "select_clusters": "SELECT * FROM graph_tree_found",
    "assign_clusters": f"""
SELECT product_id, cluster_id, cluster_label, cluster_probability, cluster_id = -1 AS is_noise,
 'reachability-tree' AS clustering_algorithm, CAST(15 AS BIGINT) AS min_cluster_size_param
FROM assigned LEFT JOIN ({_LABELS.replace("sample_words", "assigned_sample_words")}) USING (cluster_id)""",
}
RECURSIVE = {"reach", "graph_tree_prim", "whole_tree_prim"}


def with_ctes(sql: str) -> str:
    """Put the common table expressions that `sql` mentions in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(re.sub(rf"\b{name}\b", "", CTE[name]))
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = [f"{n} AS {'' if n in RECURSIVE else 'MATERIALIZED '}({CTE[n]})" for n in needed]
    return ("WITH RECURSIVE " if RECURSIVE & set(needed) else "WITH ") + ",\n".join(parts) + "\n" + sql


def all_oracles() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in ORACLES.items()}
