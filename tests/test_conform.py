import pytest

from pricekit.operators.conform import (canonical_clusters, conform_feed, spec_for, union_feeds)
from tests.conftest import rows


def test_spec_rules_from_name_and_columns():
    s = spec_for("print_uk_clustering_time_v8", ["SKU", "CLUSTER", "PATH", "cluster_size", "fiscal_quarter"])
    assert s.country == "GB" and s.brand_col is None
    s = spec_for("print_france_clustering_time_v2", ["sku", "ctx_vendor_first"])
    assert s.country == "FR" and s.brand_col == "ctx_vendor_first"
    s = spec_for("monitor_us_clustering", ["SKU", "Brand"])
    assert s.country == "US" and s.size_type == "decimal(10,0)"
    s = spec_for("bps_na_clustering", ["SKU", "COUNTRY", "Brand"])   # case-insensitive column test
    assert s.country is None and s.unmatched == "null" and s.country_map == {"united states": "US"}
    s = spec_for("monitor_emea_clustering", ["SKU", "country", "Brand"])
    assert s.country_map["United Kingdom"] == "GB" and s.unmatched == "keep"


def test_feed_without_country_is_an_error():
    with pytest.raises(ValueError):
        spec_for("other_clustering", ["SKU", "Brand"])


def test_conform_shapes(spark):
    emea = spark.createDataFrame([
        ("ab12345", 1, "2024q1,core", 2.0, "2024q1", "United Kingdom", "HP"),
        ("ab12346", 2, "2024q1", 3.0, "2024q2", "Spain", "hp"),
        ("ab12347", 3, "x", 4.0, "2024q3", "France", "other"),
    ], "SKU string, CLUSTER int, PATH string, asp_mean double, fiscal_quarter string, "
       "country string, Brand string")
    got = rows(conform_feed(emea, spec_for("monitor_emea_clustering", emea.columns)))
    assert got == [("ab12345", 1, "core", 2.0, "2024Q1", "GB"), ("ab12346", 2, None, 3.0, "2024Q2", "Spain")]
    us = spark.createDataFrame([("ZZ00001", 1, None, 2.6, "2024q4")],
                               "sku string, cluster int, path string, cluster_size double, year_quarter string")
    got = rows(conform_feed(us, spec_for("monitor_us_clustering", us.columns, ["US"])))
    assert got == [("ZZ00001", 1, None, 3.0, "2024Q4", "US")]   # decimal(10,0) rounds the size


def test_union_distinct_and_canonical(spark):
    a = spark.createDataFrame([("p00001", 1, "a", 1.0, "2024Q1", "GB")] * 2,
                              "SKU string, CLUSTER int, PATH string, cluster_size double, "
                              "fiscal_quarter string, country_code string")
    b = spark.createDataFrame([("x1", 1, "a", 1.0, "2024Q1", "GB"), ("p00002", 2, None, 1.0, "2024Q2", "FR")],
                              a.schema)
    got = rows(canonical_clusters(union_feeds([a, b])))
    assert got == [("P00001", 1, "a", 1.0, "2024Q01", "GB"), ("P00002", 2, None, 1.0, "2024Q02", "FR")]
    assert union_feeds([a, b], distinct=False).count() == 4


def test_sku_length_filter(spark):
    df = spark.createDataFrame([(s, 1, None, 1.0, "2024Q1", "GB") for s in
                                ["abcde", "abcdef", "abcdefg", "abcdefgh"]],
                               "SKU string, CLUSTER int, PATH string, cluster_size double, "
                               "fiscal_quarter string, country_code string")
    assert rows(canonical_clusters(df), "SKU") == [("ABCDEF",), ("ABCDEFG",)]
