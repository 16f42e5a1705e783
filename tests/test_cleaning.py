"""Hand-made rows for the cleaning, quality and dashboard rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from assortment.functions import numbers, text
from assortment.operators import dashboard, quality, staging, transform, views

AT = dt.datetime(2001, 11, 4)
SOURCE = "id long, name string, brand string, category string, department string, retail_price double, cost double"


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCE)


def cleaned(spark, *rows, **options):
    raw = staging.stage_products(source(spark, *rows), AT.date())
    return {r.product_id: r for r in transform.clean_products(raw, AT, **options).collect()}


def test_mandatory_fields_are_tested_before_trimming(spark):
    rows = source(
        spark, (1, "", "b", "c", "d", 1.0, 1.0), (2, None, "b", "c", "d", 1.0, 1.0), (3, "  ", "b", "c", "d", 1.0, 1.0),
        (4, "n", "b", "", "d", 1.0, 1.0), (None, "n", "b", "c", "d", 1.0, 1.0), (5, "n", "b", " ", "d", 1.0, 1.0),
    )
    assert sorted(r.product_id for r in staging.stage_products(rows, AT.date()).collect()) == [3, 5]


def test_dedupe_keeps_lowest_cost_and_nulls_last(spark):
    rows = source(
        spark, (1, "a", "b", "c", "d", 1.0, None), (1, "b", "b", "c", "d", 1.0, 5.0), (1, "c", "b", "c", "d", 1.0, 4.0),
        (2, "z", "b", "c", "d", 2.0, 1.0), (2, "y", "b", "c", "d", 1.0, 1.0), (3, "x", "b", "c", "d", 1.0, None),
    )
    kept = {r.product_id: r.name for r in staging.stage_products(rows, AT.date()).collect()}
    assert kept == {1: "c", 2: "y", 3: "x"}


def test_nan_counts_as_missing(spark):
    got = cleaned(spark, (1, "a", "b", "c", "d", math.nan, 1.0), (2, "a", "b", "c", "d", 10.0, math.nan))
    assert got[1].retail_price == 9.99 and got[2].cost == 0.0


def test_raw_median_key_misses_mixed_case_categories(spark):
    rows = [(i, "n", "b", "Jeans", "d", float(i), 0.0) for i in (10, 20, 30, 40)]
    rows.append((99, "n", "b", "Jeans", "d", None, 0.0))
    assert cleaned(spark, *rows)[99].retail_price == 9.99
    assert cleaned(spark, *rows, median_key="normalised")[99].retail_price == 20.0
    upper = [(i, n, b, c.upper(), d, p, k) for i, n, b, c, d, p, k in rows]
    assert cleaned(spark, *upper)[99].retail_price == 20.0


@pytest.mark.parametrize("approximate", [False, True])
def test_median_is_the_lower_one(spark, approximate):
    rows = [(i, "n", "b", f"C{i % 7}", "d", (i * 37 % 101) / 10 + 0.5, 1.0) for i in range(1, 400)]
    rows += [(1000 + i, "n", "b", "HOT", "d", float(i % 3) + 0.25, 1.0) for i in range(300)]
    raw = staging.stage_products(source(spark, *rows), AT.date())
    got = {r.category: r.median_price for r in transform.category_median(raw, approximate=approximate).collect()}
    prices: dict = {}
    for row in rows:
        prices.setdefault(row[3], []).append(row[5])
    assert got == {c: sorted(p)[(len(p) + 1) // 2 - 1] for c, p in prices.items()}


def test_price_and_cost_repair(spark):
    got = cleaned(
        spark, (1, "a", " ", "C", None, 100000.0, 3.0), (2, "a", "b", "C", "d", 0.0, -1.0),
        (3, "a", "b", "C", "d", 50.0, 80.0), (4, "a", "b", "C", "d", 50.0, None), (5, "a", "b", "C", "d", 70.0, 70.0),
    )
    assert {i: (r.retail_price, r.cost, r.margin_pct) for i, r in got.items()} == {
        1: (50.0, 3.0, 94.0), 2: (50.0, 0.0, 100.0), 3: (50.0, 25.0, 50.0), 4: (50.0, 0.0, 100.0), 5: (70.0, 70.0, 0.0),
    }
    assert (got[1].brand, got[1].department) == ("UNBRANDED", "GENERAL")


def test_only_a_blank_name_gives_a_code(spark):
    got = cleaned(spark, (1, "  ", "b", "c", "d", 1.0, 0.5), (2, "a", "b", " ", "d", 1.0, 0.5), (3, "a", "b", "c", "d", 1.0, 0.5))
    assert got[1].validation_errors == '["ERR_MISSING_NAME"]' and not got[1].is_valid
    assert got[2].validation_errors is None and not got[2].is_valid
    assert got[3].validation_errors is None and got[3].is_valid


def test_all_codes(spark):
    rows = spark.createDataFrame(
        [("", -1.0, -2.0), ("a", 200000.0, 1.0), ("a", 1.0, 2.0)], "name string, retail_price double, cost double"
    )
    codes = [r.validation_errors for r in transform.validation_errors(rows).collect()]
    assert codes == [
        '["ERR_MISSING_NAME","ERR_INVALID_PRICE","ERR_NEGATIVE_COST"]', '["ERR_PRICE_TOO_HIGH"]', '["ERR_COST_GT_PRICE"]',
    ]


def test_all_white_space_is_trimmed(spark):
    got = cleaned(spark, (1, "\tjean\u00a0bleu \n", "\t\u2003", "\u00a0c\r", "\n", 1.0, 0.5))[1]
    assert (got.name, got.brand, got.category, got.department) == ("JEAN\u00a0BLEU", "UNBRANDED", "C", "GENERAL")


def test_empty_tables_give_null_percentages(spark):
    raw = staging.stage_products(source(spark), AT.date())
    clean = transform.clean_products(raw, AT)
    assert transform.transform_checks(clean).first().validity_pct is None
    assert quality.quality_snapshot(clean, AT).first().completeness_pct is None


def test_rounding_is_half_up(spark):
    rows = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (0.0,)], "x double")
    assert [r[0] for r in rows.select(numbers.round2("x")).collect()] == [0.13, 2.68, 1.01, 0.0]
    rows = spark.createDataFrame([(12.5,), (13.5,), (12.4,)], "x double")
    assert [r[0] for r in rows.select(numbers.whole_number(F.col("x"))).collect()] == ["12", "14", "12"]


def test_bands_and_percent(spark):
    rows = spark.createDataFrame([(80, 100), (50, 100), (49, 100), (1, 0), (None, 9)], "n long, total long")
    pct = numbers.percent(F.col("n"), F.col("total"))
    got = [(r[0], r[1]) for r in rows.select(pct, numbers.band(pct)).collect()]
    assert got == [(80, "green"), (50, "accent"), (49, "red"), (None, None), (None, None)]


def test_labels(spark):
    rows = spark.createDataFrame([(' "\'Silk\'" ',), ("x" * 120,)], "t string")
    got = [r[0] for r in rows.select(text.tidy_label(F.col("t"))).collect()]
    assert got == ["Silk", "x" * 100]
    names = spark.createDataFrame([(3, None), (4, ""), (5, "A")], "id long, label string")
    got = [r[0] for r in names.select(text.cluster_name(F.col("label"), F.col("id"))).collect()]
    assert got == ["Cluster 3", "Cluster 4", "A"]


def clean_rows(spark, *rows):
    return spark.createDataFrame(
        list(rows), "product_id long, name string, brand string, category string, department string, "
        "retail_price double, cost double, is_valid boolean",
    )


def test_rules_fail_and_strict_raises(spark):
    clean = clean_rows(spark, (1, "a", "b", "c", "d", -5.0, 1.0, True), (1, "", "b", "c", "d", 1.0, 9.0, True))
    embedded = spark.createDataFrame([(7, [1.0]), (8, None), (9, [])], "product_id long, embedding array<double>")
    clustered = spark.createDataFrame([(1, 0), (2, -1)], "product_id long, cluster_id long")
    enriched = spark.createDataFrame([(1,)], "product_id long")
    rules = quality.run_rules(clean, embedded, clustered, enriched, dim=1)
    got = {r.rule_id[-2:]: (r.passed, r.observed, r.limit) for r in rules.collect()}
    assert got == {
        "01": (False, 1, 0), "02": (False, 1, 0), "03": (False, 1, 0), "04": (False, 2, 0), "05": (False, 1, 0),
        "06": (False, 2, 1), "07": (False, 1, 0), "08": (False, 2, 0), "09": (True, 0, 1), "10": (False, 1, 0),
        "11": (False, 1, 10), "12": (True, 0, 1),
    }
    with pytest.raises(quality.QualityRuleFailed, match="ASSERT_01"):
        quality.run_rules(clean, embedded, clustered, enriched, dim=1, strict=True)


def test_labels_merge_clusters_unless_grouped_by_id(spark):
    catalogue = spark.createDataFrame(
        [(1, "a", "x", 10.0, 1, "L"), (2, "b", "x", 20.0, 2, "L")],
        "product_id long, name string, brand string, retail_price double, cluster_id long, cluster_label string",
    )
    assert views.pricing_per_cluster(catalogue).count() == 1
    assert views.pricing_per_cluster(catalogue, by="cluster_id").count() == 2
    assert views.brands_per_cluster(catalogue).first().product_count == 2


def test_two_descriptions_do_not_repeat_a_product(spark):
    clean = spark.createDataFrame([(1, "a", "b", 5.0)], "product_id long, name string, brand string, retail_price double")
    clustered = spark.createDataFrame([(1, 0, None)], "product_id long, cluster_id long, cluster_label string")
    texts = spark.createDataFrame(
        [(1, "old", AT), (1, "new", AT + dt.timedelta(days=1))],
        "product_id long, description_enriched string, description_created_at timestamp",
    )
    rows = dashboard.cluster_products(clean, clustered, texts, 0).collect()
    assert [(r.description_enriched, r.cluster_label) for r in rows] == [("new", "Cluster 0")]
    assert dashboard.cluster_products(clean, clustered, texts, 0, newest_only=False).count() == 2
    with pytest.raises(ValueError):
        dashboard.cluster_products(clean, clustered, texts, 0, limit=201)


def test_pages(spark):
    rows = [(i, f"Label {i}", 100 - i, 1.0) for i in range(65)]
    clusters = spark.createDataFrame(rows, "cluster_id long, cluster_label string, product_count long, avg_price double")
    page = dashboard.cluster_page(clusters, " ", page=2).collect()
    assert [r.cluster_id for r in page] == list(range(60, 65)) and page[0].total_pages == 3
    assert dashboard.cluster_page(clusters, "LABEL 6").count() == 6
