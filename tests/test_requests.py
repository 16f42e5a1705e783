"""The requests a user can make of a catalogue."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assortment.operators import clusters, embed, labels
from assortment.plans import requests, run
from assortment.sources.fixtures import AS_OF
from checks.queries import Inputs

SMALL = "/root/testdata/sf0.001"


def test_requests(spark, catalogue):
    i = Inputs(spark, SMALL)
    run.run_sql_layers(catalogue, i.source, AS_OF)
    for name in run.LAYERS:
        catalogue.create(name)
    with pytest.raises(ValueError):
        requests.quality_report(catalogue)
    clean = catalogue.read("products_clean")
    embed.embed_incremental(catalogue, AS_OF, dim=64)
    department = F.dense_rank().over(Window.orderBy("department")).cast("long")
    found = clean.select("product_id", department.alias("cluster_id"), F.lit(1.0).alias("cluster_probability"))
    named = labels.label_clusters(found, clean)
    catalogue.reload(clusters.assign_clusters(found, named, AS_OF), "products_clustered")
    run.append_quality_report(catalogue, AS_OF)

    text = "SMALL RING | BRAND#2"
    rows = requests.search(catalogue, text, 5, dim=64).collect()
    assert len(rows) == 5 and [r.distance for r in rows] == sorted(r.distance for r in rows)
    assert "RING" in rows[0].name and rows[0].cluster_label
    assert all(905 <= r.retail_price <= 912 for r in requests.search(catalogue, text, 5, 905, 912, dim=64).collect())
    with pytest.raises(ValueError):
        requests.search(catalogue, "!?", dim=64)

    best = requests.analyze_intent(catalogue, text, 2, dim=64).collect()
    assert len(best) == 2 and best[0].hit_count >= best[1].hit_count and len(best[0].sample_products) == 5
    assert best[0].price_range.startswith("€") and best[0].buyer_action.startswith("Review ")

    def model(prompts):
        return [(json.dumps({"positioning": p.split('"')[1]}), 1, 1) for p in prompts]

    replied = requests.analyze_intent(catalogue, text, 2, generator=model, dim=64).collect()
    assert [(r.positioning, r.price_range) for r in replied] == [(text, "")] * 2
    with pytest.raises(ValueError):
        requests.analyze_intent(catalogue, "ab")

    listed = requests.clusters(catalogue).collect()
    assert sum(r.product_count for r in listed) == 195 and len(listed) == 4
    assert requests.clusters(catalogue, listed[0].cluster_label.lower(), 0).first().total_pages == 1
    one = requests.enrich_product(catalogue, rows[0].product_id, AS_OF).first()
    products = {r.product_id: r for r in requests.cluster_products(catalogue, 1).collect()}
    described = requests.search(catalogue, text, 1, dim=64).first()
    assert described.description_enriched == one.description_enriched
    assert len(products) == {r.cluster_id: r.product_count for r in listed}[1]
    with pytest.raises(ValueError):
        requests.enrich_product(catalogue, 10 ** 9, AS_OF)

    charts = requests.analytics(catalogue, i.order_items, AS_OF)
    assert charts["quality"].first().total_records == 195 == requests.quality_report(catalogue).first().total_records
    assert charts["heatmap"].count() == 23 and charts["cluster_distribution"].count() == 4
