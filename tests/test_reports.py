"""Reports on hand-made trips."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import rows, session_zone
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.functions.time import utc_instant
from tripmart.operators import averages, distribution, quality, trends
from tripmart.plans import reports
from tripmart.roles import GREEN, YELLOW, TripRoles

TRIPS = """
    SELECT * FROM VALUES
    (1, TIMESTAMP_NTZ'2023-05-01 00:10:00', TIMESTAMP_NTZ'2023-05-01 00:20:00', 1, 10.0D),
    (1, TIMESTAMP_NTZ'2023-05-01 00:50:00', TIMESTAMP_NTZ'2023-05-01 00:40:00', 2, -1.0D),
    (2, TIMESTAMP_NTZ'2023-05-01 00:59:59', TIMESTAMP_NTZ'2023-05-01 01:40:00', 4, 20.0D),
    (NULL, TIMESTAMP_NTZ'2023-05-01 00:30:00', TIMESTAMP_NTZ'2023-05-01 00:40:00', 9, 5.0D),
    (2, TIMESTAMP_NTZ'2023-05-02 13:00:00', TIMESTAMP_NTZ'2023-05-02 13:20:00', NULL, 7.0D),
    (3, TIMESTAMP_NTZ'2023-05-02 14:00:00', TIMESTAMP_NTZ'2023-05-02 14:20:00', 3, NULL),
    (1, TIMESTAMP_NTZ'2023-06-01 00:00:00', TIMESTAMP_NTZ'2023-06-01 00:20:00', 50, 8.0D),
    (1, TIMESTAMP_NTZ'2023-04-30 23:59:59', TIMESTAMP_NTZ'2023-05-01 00:20:00', 50, 8.0D)
    AS t(VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, total_amount)
"""
OTHER = """
    SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2023-01-01 00:10:00', 1), (1, TIMESTAMP_NTZ'2023-05-01 00:10:00', 2),
    (2, TIMESTAMP_NTZ'2023-05-07 13:10:00', 10), (4, TIMESTAMP_NTZ'2023-05-07 13:10:00', 10)
    AS t(VendorID, lpep_pickup_datetime, passenger_count)
"""
# vendor 1 averages 1.5 and vendor 2 averages 10: (2.5 + 3.5 + 14) / 3
HOURLY = [("2023-05-01 00", 6.67), ("2023-05-02 13", None), ("2023-05-02 14", None)]
ZONES = ["UTC", "America/Sao_Paulo", "America/New_York"]


def as_instants(df):
    stamps = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: utc_instant(df, c) for c in stamps})


@pytest.mark.parametrize("zone", ZONES)
@pytest.mark.parametrize("instants", [False, True])
def test_hourly_average_with_vendor_baseline(spark, zone, instants):
    with session_zone(spark, zone):
        trips, other = spark.sql(TRIPS), spark.sql(OTHER)
        if instants:
            trips = as_instants(trips)
        report = averages.hourly_average_with_vendor_baseline(trips, other, "2023-05", YELLOW, GREEN)
        assert [tuple(r) for r in report.collect()] == HOURLY
        means = averages.monthly_average(trips, YELLOW.pickup, F.col("passenger_count"), "mean")
        assert [tuple(r) for r in means.collect()] == [("2023-04", 50.0), ("2023-05", 3.8), ("2023-06", 50.0)]


def test_summing_before_the_join_equals_joining_every_trip(spark):
    trips, other = spark.sql(TRIPS), spark.sql(OTHER)
    joined = averages.with_vendor_baseline(trips, other, YELLOW, GREEN)
    assert joined.count() == trips.count()
    hour = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH")
    expected = (
        joined.filter("tpep_pickup_datetime >= '2023-05-01' AND tpep_pickup_datetime < '2023-06-01'")
        .groupBy(hour)
        .agg(F.round(F.avg("combined"), 2))
    )
    assert rows(expected) == sorted(HOURLY, key=repr)


def test_sql_reports_keep_their_result(spark, folder):
    spark.sql(TRIPS).createOrReplaceTempView("yellow_trips")
    spark.sql(OTHER).createOrReplaceTempView("green_trips")
    report = reports.run_hourly_sql(spark, "yellow_trips", "green_trips", "2023-05", folder)
    assert rows(report) == sorted(HOURLY, key=repr)
    as_instants(spark.sql(TRIPS)).createOrReplaceTempView("yellow_instants")
    assert rows(reports.run_hourly_sql(spark, "yellow_instants", "green_trips", "2023-05", folder)) == rows(report)
    monthly = reports.run_monthly_sql(spark, "yellow_trips", folder)
    assert rows(monthly) == [("2023-04", 50.0), ("2023-05", 3.8), ("2023-06", 50.0)]
    assert rows(reports.monthly_average_report(spark, "yellow_trips")) == rows(monthly)
    files = {f.rsplit("/", 2)[1] for f in report.inputFiles() + monthly.inputFiles()}
    assert len(files) == 2


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "America/New_York"])
def test_sql_reports_over_instants_are_the_same_in_every_zone(spark, folder, zone):
    as_instants(spark.sql(TRIPS)).createOrReplaceTempView("yellow_instants")
    as_instants(spark.sql(OTHER)).createOrReplaceTempView("green_instants")
    with session_zone(spark, zone):
        hourly = rows(reports.run_hourly_sql(spark, "yellow_instants", "green_instants", "2023-05", folder))
        monthly = rows(reports.run_monthly_sql(spark, "yellow_instants", folder))
    assert hourly == sorted(HOURLY, key=repr)
    assert monthly == [("2023-04", 50.0), ("2023-05", 3.8), ("2023-06", 50.0)]


def test_text_records(spark):
    report = spark.sql("SELECT * FROM VALUES (1, 2.5D, TRUE), (2, NULL, FALSE) AS t(a, b, c)")
    assert list(reports.as_records(report)) == [{"a": "1", "b": "2.5", "c": "true"}, {"a": "2", "b": None, "c": "false"}]
    assert list(reports.as_records(report.limit(0))) == []


def test_fleet_pools_trips_of_all_tables(spark):
    pooled = averages.fleet([(spark.sql(TRIPS), YELLOW), (spark.sql(OTHER), GREEN)])
    assert pooled.columns == ["pickup", "vendor", "passengers", "amount"]
    found = [tuple(r) for r in averages.hour_of_day_average(pooled, "2023-05").collect()]
    assert found == [(0, 5, 3.6), (13, 3, 10.0), (14, 1, 3.0)]


def test_peaks_share_ranks(spark):
    found = [tuple(r) for r in trends.peak_and_low_hours(spark.sql(TRIPS), YELLOW.pickup).collect()]
    assert found == [(0, 5, 1, 4), (13, 1, 2, 1), (14, 1, 2, 1), (23, 1, 2, 1)]


def test_trend(spark):
    found = trends.monthly_trend(spark.sql(TRIPS), YELLOW.pickup, F.col("total_amount"), "avg")
    assert [tuple(r) for r in found.collect()] == [
        ("2023-04", 1, 8.0, None, None),
        ("2023-05", 6, 8.2, 8.0, 0.2),
        ("2023-06", 1, 8.0, 8.2, -0.2),
    ]


def test_histogram_classes(spark):
    found = distribution.monthly_histogram(spark.sql(TRIPS), YELLOW.pickup, "total_amount", 5.0)
    assert [tuple(r) for r in found.filter("month = '2023-05'").collect()] == [
        ("2023-05", -5.0, 1), ("2023-05", 5.0, 2), ("2023-05", 10.0, 1), ("2023-05", 20.0, 1),
    ]


def test_quality_rules(spark):
    trips = spark.sql(TRIPS).withColumn("source_date", F.lit("2023-05"))
    trips = trips.unionByName(trips.filter("total_amount = 20"))
    counts = quality.quality_rule_counts(trips, trips.columns)
    found = {r.rule: (r.n_rows, r.n_bad) for r in counts.collect()}
    assert found == {
        "dropoff_before_pickup": (9, 1),
        "negative_amount": (9, 1),
        "null_amount": (9, 1),
        "null_passengers": (9, 1),
        "null_pickup": (9, 0),
        "null_vendor": (9, 1),
        "pickup_outside_source_date": (9, 2),
        "repeated_row": (9, 1),
    }
    empty = quality.quality_rule_counts(trips.filter("FALSE"), ["VendorID"])
    assert {(r.n_rows, r.n_bad, r.bad_rate) for r in empty.collect()} == {(0, 0, None)}


def skewed(n: int = 30_000, seed: int = 5) -> pd.DataFrame:
    """A third of the rows in one group, and a third of all values equal."""
    rng = np.random.default_rng(seed)
    groups = np.where(rng.random(n) < 1 / 3, "hot", rng.integers(0, 12, n).astype(str)).astype(object)
    groups[rng.random(n) < 0.01] = None
    values = np.where(rng.random(n) < 1 / 3, 7.0, rng.lognormal(0, 3, n)) * rng.choice([1, -1], n)
    return pd.DataFrame({"g": groups, "v": values})


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("values_per_task", [1_000_000, 500, 4])
def test_quantiles_equal_brute_force_however_often_groups_are_cut(spark, values_per_task):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    found = {r.g: (r.n, r.q) for r in distribution.quantiles(df, "g", "v", PROBS, values_per_task).collect()}
    expected = {None if pd.isna(g) else g: part.v.to_numpy() for g, part in pdf.groupby("g", dropna=False)}
    assert set(found) == set(expected)
    for g, values in expected.items():
        assert found[g][0] == len(values)
        np.testing.assert_allclose(found[g][1], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert distribution.quantiles(df, "g", "v", [0.5]).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.sampled_from([0.1, 0.25, 0.5, 0.9]))
def test_quantiles_of_small_groups(spark, values, p):
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    found = distribution.quantiles(df, "g", "v", [p], values_per_task=5).first()
    np.testing.assert_allclose(found.q, [np.quantile(values, p)], rtol=1e-9, atol=1e-9)


def test_approximate_distribution_has_the_same_shape(spark):
    exact = distribution.monthly_distribution(spark.sql(TRIPS), YELLOW.pickup, "total_amount")
    rough = distribution.monthly_distribution(spark.sql(TRIPS), YELLOW.pickup, "total_amount", approximate=True)
    assert exact.schema == rough.schema
    assert tuple(exact.filter("month = '2023-05'").first()) == ("2023-05", 5, -1.0, 5.0, 7.0, 10.0, 20.0, 8.2)


def test_outliers_equal_brute_force(spark):
    pdf = skewed(5_000).assign(id=range(5_000)).dropna()
    df = spark.createDataFrame(pdf).withColumn("ts", F.expr("TIMESTAMP_NTZ'2023-05-01 00:00:00' + make_interval(0, int(length(g) - 1))"))
    found = {r.id for r in quality.outliers(df, "ts", "v").collect()}
    expected = set()
    for _, part in pdf.groupby(pdf.g.str.len()):
        low, high = np.quantile(part.v, [0.25, 0.75])
        reach = 1.5 * (high - low)
        expected |= set(part[(part.v < low - reach) | (part.v > high + reach)].id)
    assert found == expected


def test_preview_needs_no_full_sort(spark):
    from tripmart.operators.conform import preview

    df = spark.range(100).select((F.lit(100) - F.col("id")).alias("x"))
    assert [r.x for r in preview(df, ["x"]).collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in preview(df, ["x"])._jdf.queryExecution().toString()


def test_roles_default_to_the_yellow_columns():
    assert TripRoles() == YELLOW
    assert GREEN.vendor == YELLOW.vendor
