"""Time the headline queries: every result row is produced and thrown away by Spark.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores; one JSON
line is printed. Arguments name other queries to time.
"""

import json
import os
import sys
import time

from checks.compare import session
from checks.queries import QUERIES

HEADLINES = [
    "stage_products", "category_median", "clean_products", "quality_snapshot", "run_rules",
    "cluster_distribution", "brands_per_cluster", "pricing_per_cluster", "sales_timeline",
    "heatmap_cat_dept", "heatmap_matrix", "dashboard_bundle", "cluster_products",
    "vector_top_k", "vector_top_k_batch", "ivf_build", "search_products", "intent_briefs", "price_constraints",
    "search_log", "embed_texts", "embed_incremental", "enrich_incremental", "knn_graph",
    "components_at_level", "assign_clusters", "label_clusters", "catalogue_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    QUERIES["cluster_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "catalogue_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
