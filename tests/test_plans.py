"""The physical plans that make the queries fit for large data."""

import re

import pytest

import __spark_entry__ as entry

PYTHON = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoop")

# Queries that only map or filter rows must not move them.
ROW_WISE = [
    "assigned_points",
    "demand_supply_points",
    "geohash8",
    "trip_documents",
    "box_a",
    "box_c",
    "within_10_miles",
    "geo_bbox",
    "text_match",
    "template_match",
    "bool_query",
    "json_decode",
    "json_fallback",
    "enriched_messages",
    "filtered_json_messages",
    "event_documents",
    "typed_documents",
    "iso_timestamps",
    "geo_point_forms",
    "last_7_days",
]
# Grouped queries shuffle their partial results once.
ONE_SHUFFLE = [
    "supply_demand_ratio",
    "cluster_documents",
    "cluster_counts",
    "tumbling_counts",
    "grid_count",
    "cluster_value_freq",
    "cluster_sums",
    "search_total",
]


def plan(spark, sf_dir, name):
    return entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_WISE)
def test_row_wise_queries_do_not_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "Exchange" not in text and not any(p in text for p in PYTHON)


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_grouped_queries_shuffle_partials_once(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert len(re.findall(r"Exchange (?:hashpartitioning|SinglePartition)", text)) == 1
    assert "partial_" in text and not any(p in text for p in PYTHON)


def test_pair_counts_scan_once(spark, sf_dir):
    assert plan(spark, sf_dir, "vendor_pair_counts").count("FileScan") == 1


def test_time_range_and_term_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "event_range")
    assert "EqualTo(event_type,purchase)" in text and "GreaterThanOrEqual(ts" in text
    assert "GreaterThanOrEqual(ts" in plan(spark, sf_dir, "last_7_days")


def test_scans_read_only_what_they_need(spark, sf_dir):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, sf_dir, "search_projection")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, sf_dir, "geo_bbox")).group(1)
    assert schema == "event_id:bigint,user_id:bigint"


def test_small_hit_lists_need_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "search_top3")


def test_stored_coordinates_reach_the_scan(spark, tmp_path):
    from curbflow.functions import geo
    from curbflow.operators.clean import drop_null_points

    spark.createDataFrame([(40.7, -73.9)], "lat double, lon double").write.parquet(str(tmp_path / "p"))
    stored = drop_null_points(spark.read.parquet(str(tmp_path / "p")), ["lat", "lon"])
    near = stored.filter(geo.within_distance("lat", "lon", (40.7, -73.9), 1000))
    text = near._jdf.queryExecution().executedPlan().toString()
    for pushed in ("IsNotNull(lat)", "IsNotNull(lon)", "GreaterThanOrEqual(lat", "LessThanOrEqual(lon"):
        assert pushed in text
