"""Hot keys and plans: results stay whole, and plans are the wanted ones."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assortment.operators import labels, quality, staging, transform, vector, views
from checks.queries import QUERIES, Inputs

AT = dt.datetime(2001, 11, 4)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tight(spark):
    """Settings under which adaptive execution meets a hot key at test size."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_product_in_order_lines(spark, tight):
    rows = [(n, 7 if n % 3 == 0 else n % 50, AT - dt.timedelta(days=n % 200), float(n % 9)) for n in range(30000)]
    items = spark.createDataFrame(rows, "order_id long, product_id long, created_at timestamp, sale_price double").repartition(8)
    catalogue = spark.createDataFrame(
        [(p, f"n{p}", "b", 1.0, p % 4, f"L{p % 4}") for p in range(45)],
        "product_id long, name string, brand string, retail_price double, cluster_id long, cluster_label string",
    )
    got = {(r.sale_date, r.cluster_label): (r.sales_count, r.sales_revenue)
           for r in views.sales_timeline(items, catalogue, AT).collect()}
    orders, revenue = defaultdict(set), defaultdict(float)
    for order, product, at, price in rows:
        if product < 45 and at >= AT - dt.timedelta(days=180):
            orders[at.date(), f"L{product % 4}"].add(order)
            revenue[at.date(), f"L{product % 4}"] += price
    assert got == {k: (len(v), revenue[k]) for k, v in orders.items()}


def test_hot_id_and_category_in_cleaning(spark, tight):
    rows = [
        (5 if n % 3 == 0 else n, f"n{n}", "b", "HOT" if n % 2 else f"C{n % 5}", "d",
         None if n % 11 == 0 else n % 97 + 0.5, n % 13 - 1.0)
        for n in range(20000)
    ]
    source = spark.createDataFrame(
        rows, "id long, name string, brand string, category string, department string, retail_price double, cost double"
    ).repartition(8)
    raw = staging.stage_products(source, AT.date())
    kept = {}
    for id_, name, _, category, _, price, cost in rows:
        key = (cost, price is None, price or 0, name)
        if id_ not in kept or key < kept[id_][0]:
            kept[id_] = (key, category, price)
    clean = {r.product_id: r.retail_price for r in transform.clean_products(raw, AT).collect()}
    prices = defaultdict(list)
    for _, category, price in kept.values():
        if price is not None:
            prices[category].append(price)
    median = {c: sorted(p)[(len(p) + 1) // 2 - 1] for c, p in prices.items()}
    assert clean == {i: median[c] if p is None else p for i, (_, c, p) in kept.items()}


def test_hot_cluster_in_views_and_samples(spark, tight):
    n = 9000
    clustered = spark.range(n).select(
        F.col("id").alias("product_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("cluster_id")
    ).withColumn("cluster_label", F.concat(F.lit("L"), F.col("cluster_id"))).repartition(6)
    clean = spark.range(n).select(
        F.col("id").alias("product_id"), F.concat(F.lit("N"), F.col("id")).alias("name"),
        F.concat(F.lit("B"), F.col("id") % 40).alias("brand"), F.lit("C").alias("category"),
        (F.col("id") % 10).cast("double").alias("retail_price"),
    ).repartition(6)
    catalogue = views.clustered_catalogue(clean, clustered)
    cluster = {p: 1 if p % 3 == 0 else p % 7 for p in range(n)}
    sizes = defaultdict(int)
    for c in cluster.values():
        sizes[c] += 1
    assert {r.cluster_id: r.product_count for r in views.cluster_distribution(catalogue).collect()} == sizes
    assert sum(r.product_count for r in views.pricing_per_cluster(catalogue).collect()) == n
    samples = {r.cluster_id: r.samples for r in labels.label_samples(clustered, clean).collect()}
    for c in sizes:
        first = [p for p in range(n) if cluster[p] == c][:15]
        assert samples[c] == [f"N{p} (C)" for p in first]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in QUERIES if not n.startswith(("ivf", "embed_inc", "enrich_", "increm", "assign_cl", "select_", "catalogue"))]


def test_no_cross_joins(spark):
    for name in LAZY:
        text = plan(QUERIES[name](spark, SMALL))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_limits_reach_the_map_side(spark):
    i = Inputs(spark, SMALL)
    assert plan(i.raw).count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan(labels.label_samples(i.clustered, i.clean))
    assert "TakeOrderedAndProject" in plan(vector.vector_top_k(i.embedded, [1.0] * 64, 5))


def test_filters_and_columns_reach_the_scan(spark):
    i = Inputs(spark, SMALL)
    text = plan(views.sales_timeline(i.order_items, i.catalogue, AT))
    assert "GreaterThanOrEqual(l_shipdate,2001-05-08" in text
    assert "l_quantity" not in text and "l_discount" not in text
    stored = i.table("part").where(F.col("p_partkey") == 3)
    assert "EqualTo(p_partkey,3)" in plan(stored)


def test_rules_shuffle_the_catalogue_once(spark, tmp_path):
    i = Inputs(spark, SMALL)
    i.clean.write.parquet(str(tmp_path / "clean"))
    clean = spark.read.parquet(str(tmp_path / "clean"))
    text = plan(quality.run_rules(clean, i.embedded, i.clustered, i.enriched))
    assert text.count("Scan parquet") - text.count("embeddings.parquet") <= 2


def test_medians_do_not_shuffle_products_by_category(spark):
    i = Inputs(spark, SMALL)
    i.raw.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/raw")
    raw = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/raw")
    text = plan(transform.clean_products(raw, AT))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_many_medians_are_joined_by_a_shuffle(spark, monkeypatch, tight):
    monkeypatch.setattr(transform, "BROADCAST_MEDIANS", 0)
    i = Inputs(spark, SMALL)
    few = transform.clean_products(i.raw, AT).drop("cleaned_at").collect()
    monkeypatch.undo()
    assert sorted(few) == sorted(transform.clean_products(i.raw, AT).drop("cleaned_at").collect())
