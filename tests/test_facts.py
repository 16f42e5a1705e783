"""Known row counts of the derived catalogue at three scales."""

import pytest
from pyspark.sql import functions as F

from assortment.operators import views
from assortment.sources.lineage import cut
from checks.queries import Inputs

FACTS = {  # clean, priced 9.99, invalid, invalid without codes, unbranded, timeline, heatmap
    "sf0.001": (195, 6, 3, 1, 11, 294, 23),
    "sf0.01": (1939, 52, 43, 19, 115, 687, 27),
    "sf0.1": (19391, 503, 412, 183, 1108, 1329, 28),
}


@pytest.mark.parametrize("scale", FACTS)
def test_facts(spark, scale):
    i = Inputs(spark, f"/root/testdata/{scale}")
    clean = cut(i.clean)
    invalid = ~F.col("is_valid")
    counts = clean.agg(
        F.count(F.lit(1)), F.count_if(F.col("retail_price") == 9.99), F.count_if(invalid),
        F.count_if(invalid & F.col("validation_errors").isNull()), F.count_if(F.col("brand") == "UNBRANDED"),
    ).first()
    catalogue = cut(views.clustered_catalogue(clean, i.clustered))
    timeline = views.sales_timeline(i.order_items, catalogue, views.dt.datetime(2001, 11, 4)).count()
    heatmap = views.heatmap_cat_dept(clean).count()
    assert (*counts, timeline, heatmap) == FACTS[scale]
    assert views.cluster_distribution(catalogue).count() == 9
    assert views.pricing_per_cluster(catalogue).count() == 8
    assert views.brands_per_cluster(catalogue).count() == 80
