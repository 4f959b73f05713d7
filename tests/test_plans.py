"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import pytest
from conftest import SF_DIR, land_file, rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tripmart.operators import averages, conform, quality
from tripmart.roles import TripRoles
from tripmart.sources import readers

EVENTS = contract.EVENTS
WITHOUT_FILES = [
    "hourly_avg_passengers_with_vendor_baseline",
    "trips_with_vendor_baseline",
    "vendor_avg_passengers",
    "monthly_avg_passengers",
    "month_filter_rows",
    "hour_of_day_avg_fleet",
    "peak_low_hours",
    "monthly_trend",
    "amount_histogram",
    "quality_rule_counts",
    "preview_rows",
    "run_grid",
    "page_links",
    "category_links",
    "first_category_link",
    "missing_links",
    "missing_categories",
    "missing_categories_by_page",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", WITHOUT_FILES)
def test_no_plan_pairs_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["hourly_avg_passengers_with_vendor_baseline", "missing_links", "missing_categories"])
def test_nothing_is_broadcast_without_a_size_check(spark, no_broadcast, name):
    assert "Broadcast" not in plan_of(contract.queries()[name](spark, SF_DIR))


def test_small_sides_are_broadcast_by_their_written_size_only(spark, no_broadcast):
    trips = contract._events(spark, SF_DIR)
    joined = averages.with_vendor_baseline(trips, trips, EVENTS, EVENTS)
    assert "SortMergeJoin" in plan_of(joined)
    found = quality.outliers(trips, "ts", "value")
    assert "SortMergeJoin" in plan_of(found)
    without = rows(found.select("event_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert "BroadcastHashJoin" in plan_of(averages.with_vendor_baseline(trips, trips, EVENTS, EVENTS))
    assert rows(quality.outliers(trips, "ts", "value").select("event_id")) == without


def test_reports_read_the_columns_they_need(spark):
    plan = plan_of(contract.monthly_avg_amount(spark, SF_DIR))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert plan.count("HashAggregate") == 2
    joined = plan_of(contract.hourly_avg_passengers_with_vendor_baseline(spark, SF_DIR))
    below = joined[joined.index("HashJoin" if "HashJoin" in joined else "SortMergeJoin") :]
    assert "partial_sum" in below


def test_conforming_needs_no_shuffle(spark, folder):
    trips = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    land_file(trips, folder, "raw/orders_trips_1998-01.parquet")
    staged = conform.production_rows(conform.conform(readers.read_landed(spark, f"{folder}/raw")), ["o_totalprice", "source_date"], [])
    plan = plan_of(staged)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<o_totalprice:double>" in plan


def test_skewed_vendor_gives_the_same_report_with_and_without_broadcast(spark, no_broadcast):
    vendor = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
    trips = spark.range(30_000).select(
        "id",
        vendor.alias("VendorID"),
        F.expr("TIMESTAMP_NTZ'2023-05-01 00:00:00' + make_interval(0, 0, 0, 0, int(id % 40))").alias("tpep_pickup_datetime"),
        (F.col("id") % 7).cast("int").alias("passenger_count"),
    )

    def report():
        found = averages.hourly_average_with_vendor_baseline(trips, trips.filter("id % 5 <> 0"), "2023-05", TripRoles())
        return [tuple(r) for r in found.collect()]

    merged = report()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert merged == report()
    assert len(merged) == 40
