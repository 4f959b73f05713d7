"""Runs whose schemas differ: nothing is cut, nothing is lost, and what cannot be kept raises before any write."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from conftest import SF_DIR, land_file, rows, session_zone
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from tripmart.functions import names
from tripmart.functions.html import decode_entities
from tripmart.functions.numeric import to_int
from tripmart.operators import catalog, distribution, sinks
from tripmart.operators.schemas import SchemaConflictError, common_type
from tripmart.plans import etl
from tripmart.session import delete_folder
from tripmart.sources import landing, readers
from tripmart.streaming import incremental

RUN = date(2023, 6, 1)
AMOUNTS = ["VendorID", "tpep_pickup_datetime", "total_amount", "source_date"]


def trips(spark, amounts: list, kind: str):
    df = spark.createDataFrame([(i, str(a)) for i, a in enumerate(amounts)], "VendorID bigint, a string")
    pickup = F.expr("TIMESTAMP_NTZ'2023-01-01 00:30:00'").alias("tpep_pickup_datetime")
    return df.select("VendorID", pickup, F.col("a").try_cast(kind).alias("total_amount"))


def database(spark, folder: str) -> str:
    name = "db_" + uuid.uuid4().hex
    catalog.create_database(spark, name, f"{folder}/{name}")
    return name


def sums(df) -> list[tuple]:
    return rows(df.groupBy("source_date").agg(F.sum(F.col("total_amount").cast("double"))))


@pytest.mark.parametrize(("first", "second"), [("int", "double"), ("bigint", "double"), ("double", "int"), ("int", "bigint")])
def test_runs_of_two_types_keep_every_amount(spark, folder, first, second):
    name, late = database(spark, folder), [10, 2] if second != "double" else [10.75, 2.5]
    for month, amounts, kind in (("2023-01", [10, 5], first), ("2023-02", late, second)):
        land_file(trips(spark, amounts, kind), folder, f"raw/yellow_tripdata_{month}.parquet")
        published = etl.run_etl(
            spark, f"{folder}/raw", f"{folder}/run", name, ["yellow_tripdata"], [month], columns=AMOUNTS, integers=[], run_date=RUN
        )
    expected = [("2023-01", 15.0), ("2023-02", float(sum(late)))]
    assert sums(published["yellow_tripdata"]) == expected
    assert sums(readers.read_zone(spark, f"{folder}/run/staging/yellow_tripdata")) == expected
    assert len(readers.zone_groups(spark, f"{folder}/run/staging/yellow_tripdata")) == 1
    registered = database(spark, folder)
    catalog.register_zone(spark, registered, f"{folder}/run/staging")
    assert sums(spark.table(f"{registered}.yellow_tripdata")) == expected


def test_a_conflict_changes_nothing(spark, folder):
    name = database(spark, folder)
    land_file(trips(spark, [1, 2], "double"), folder, "raw/yellow_tripdata_2023-01.parquet")
    arguments = dict(columns=AMOUNTS, integers=[], run_date=RUN)
    etl.run_etl(spark, f"{folder}/raw", f"{folder}/run", name, ["yellow_tripdata"], **arguments)
    land_file(trips(spark, ["many"], "string"), folder, "raw/yellow_tripdata_2023-02.parquet")
    with pytest.raises(SchemaConflictError):
        etl.run_etl(spark, f"{folder}/raw", f"{folder}/run", name, ["yellow_tripdata"], ["2023-02"], **arguments)
    for zone in (f"{folder}/run/staging/yellow_tripdata", f"{folder}/run/production/yellow_tripdata_parquet"):
        assert sums(readers.read_objects(spark, [zone], with_source=False) if "production" in zone else readers.read_zone(spark, zone)) == [("2023-01", 3.0)]
    assert sums(spark.table(f"{name}.yellow_tripdata")) == [("2023-01", 3.0)]


def test_a_number_too_large_for_a_double_raises(spark, folder):
    table, place = f"{database(spark, folder)}.t", f"{folder}/t"
    whole = spark.createDataFrame([(2**53 + 1, "2023-01")], "x bigint, source_date string")
    catalog.publish(spark, whole, table, place)
    with pytest.raises(SchemaConflictError):
        catalog.publish(spark, spark.createDataFrame([(0.5, "2023-02")], "x double, source_date string"), table, place)
    assert rows(spark.table(table)) == [(2**53 + 1, "2023-01")]


def test_a_folder_of_two_types_is_not_registered(spark, folder):
    name = database(spark, folder)
    for month, kind in (("2023-01", "bigint"), ("2023-02", "double")):
        dated = trips(spark, [1], kind).withColumn("source_date", F.lit(month))
        sinks.write_partitions(dated, f"{folder}/zone/trips", ["source_date"])
    with pytest.raises(SchemaConflictError):
        catalog.register_folder(spark, f"{name}.trips", f"{folder}/zone/trips")


@pytest.mark.parametrize("conflict", [False, True])
def test_an_object_of_several_files_keeps_all_their_columns(spark, folder, conflict):
    place = f"{folder}/raw/yellow_tripdata_2023-01.parquet"
    for column in ("x", "y"):
        spark.range(1).select(F.col("id").cast("int").alias(column)).coalesce(1).write.mode("append").parquet(place)
    if conflict:
        land_file(spark.range(1).select(F.lit(0.5).alias("x")), folder, "raw/yellow_tripdata_2023-02.parquet")
    found = readers.read_landed(spark, f"{folder}/raw")
    assert {"x", "y"} <= set(found.columns) and found.count() == 2 + conflict


def test_files_of_one_object_may_differ(spark, folder):
    place = f"{folder}/raw/yellow_tripdata_2023-01.parquet"
    for kind in ("int", "double"):
        spark.range(2).select((F.col("id") + 0.5).cast(kind).alias("x")).coalesce(1).write.mode("append").parquet(place)
    assert rows(readers.read_landed(spark, f"{folder}/raw").select("x")) == [(0.0,), (0.5,), (1.0,), (1.5,)]


def test_jobs_grow_with_schema_changes_and_not_with_objects(spark, folder):
    paths = []
    for n in range(60):
        kind = ("int", "bigint", "double")[n // 20]
        name = f"yellow_tripdata_{2000 + n // 12}-{n % 12 + 1:02}.parquet"
        spark.range(1).select(F.col("id").cast(kind).alias("x")).coalesce(1).write.parquet(f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "schemas")
    groups = readers.schema_groups(spark, paths)
    spark.sparkContext.setJobGroup("", "")
    assert [len(members) for _, members in groups] == [20, 20, 20]
    assert len(tracker.getJobIdsForGroup(group)) <= 30


def test_incremental_runs_keep_columns_and_types(spark, folder):
    raw, target = f"{folder}/raw", f"{folder}/target"
    for month, kind, extra in (("2023-01", "int", []), ("2023-02", "double", [F.lit(1.5).alias("airport_fee")])):
        land_file(trips(spark, [1, 2.5], kind).select("*", *extra), raw, f"yellow_tripdata_{month}.parquet")
        incremental.stream_drifting(spark, raw, target, run_date=RUN)
    loaded = incremental.read_loaded(spark, target)
    found = loaded.groupBy("source_date").agg(F.sum("total_amount"), F.sum("airport_fee"))
    assert rows(found) == [("2023-01", 1.0, None), ("2023-02", 3.5, 3.0)]


def test_a_month_that_lands_without_rows_is_emptied(spark, folder):
    name = database(spark, folder)
    arguments = dict(columns=AMOUNTS, integers=[], run_date=RUN)
    for month in ("2023-01", "2023-02"):
        land_file(trips(spark, [1, 2], "double"), folder, f"raw/yellow_tripdata_{month}.parquet")
    etl.run_etl(spark, f"{folder}/raw", f"{folder}/run", name, ["yellow_tripdata"], **arguments)
    land_file(trips(spark, [], "double"), folder, "raw/yellow_tripdata_2023-02.parquet")
    etl.run_etl(spark, f"{folder}/raw", f"{folder}/run", name, ["yellow_tripdata"], ["2023-02"], **arguments)
    assert sums(spark.table(f"{name}.yellow_tripdata")) == [("2023-01", 3.0)]
    assert sums(readers.read_zone(spark, f"{folder}/run/staging/yellow_tripdata")) == [("2023-01", 3.0)]
    produced = readers.read_objects(spark, [f"{folder}/run/production/yellow_tripdata_parquet"], with_source=False)
    assert sums(produced) == [("2023-01", 3.0)]


def test_listing_tasks_do_not_grow_with_bytes(spark, folder):
    for n in range(1, 13):
        land_file(spark.range(20_000).select("id", F.rand(n).alias("x")), folder, f"raw/yellow_tripdata_2023-{n:02}.parquet")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        assert landing.manifest(spark, f"{folder}/raw").select("path").rdd.getNumPartitions() <= 12
        scan = landing.manifest(spark, f"{folder}/raw")
        assert scan.count() == 12
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize(
    ("path", "name", "month"),
    [
        ("/data/x.parquet/yellow_t/yellow_t_2023-01.parquet", "yellow_t_2023-01.parquet", "2023-01"),
        ("/data/x.parquet/yellow_t/yellow_t_2023-01.parquet/part-0.parquet", "yellow_t_2023-01.parquet", "2023-01"),
        ("/data/yellow_t/object=yellow_t_2023-02.parquet/part-0.snappy.parquet", "yellow_t_2023-02.parquet", "2023-02"),
        ("yellow_t_2023-03.parquet", "yellow_t_2023-03.parquet", "2023-03"),
    ],
)
def test_the_last_folder_named_as_an_object_decides(spark, path, name, month):
    df = spark.createDataFrame([(path,)], "p string")
    found = df.select(names.object_name(names.object_path(F.col("p"))), names.source_date(F.col("p"))).first()
    assert tuple(found) == (name, month)


def test_text_numbers_are_truncated(spark):
    df = spark.createDataFrame([("1.0",), ("-1.9",), ("7",), ("x",), ("3e9",), (None,)], "a string")
    assert [r[0] for r in df.select(to_int(F.col("a"))).collect()] == [1, -1, 7, None, None, None]


def test_entities_as_the_standard_library_reads_them(spark):
    from html import unescape

    texts = ["a &ndash; b &eacute;&#0000000065;&#x0000000041;", "&amp;lt; &lt;&gt;&quot;&apos;&nbsp;", "&no; &#0; &#x110000; &#128;", "&NotEqualTilde;&&amp;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(decode_entities(F.col("t"))).collect()] == [unescape(t) for t in texts]


def test_common_types():
    types = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(), "text": T.StringType()}
    assert common_type(types["int"], types["bigint"]) == types["bigint"]
    assert common_type(types["float"], types["int"]) == types["double"]
    assert common_type(types["bigint"], types["double"]) == types["double"]
    assert common_type(T.DecimalType(10, 2), types["int"]) == T.DecimalType(12, 2)
    assert common_type(types["text"], types["int"]) is None


def test_quality_rules_read_each_source_once(spark):
    plan = contract.quality_rule_counts(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_quantiles_cut_large_groups_only(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = spark.range(6000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 40).alias("g"), (F.col("id") * 7919 % 6007).alias("v"))
        cut = distribution.quantiles(df, "g", "v", [0.1, 0.5, 0.9], values_per_task=500)
        plain = df.groupBy("g").agg(F.count("*"), F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))))
        assert [(g, n, [round(x, 6) for x in q]) for g, n, q in rows(cut)] == [(g, n, [round(x, 6) for x in q]) for g, n, q in rows(plain)]
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "UTC"])
def test_zones_read_the_same_in_every_session_zone(spark, folder, zone):
    land_file(trips(spark, [1], "int"), folder, "raw/yellow_tripdata_2023-01.parquet")
    with session_zone(spark, zone):
        etl.load_zones(spark, f"{folder}/raw", f"{folder}/s", f"{folder}/p", "yellow_tripdata", integers=[], run_date=RUN)
        found = readers.read_zone(spark, f"{folder}/s/yellow_tripdata")
        assert rows(found.select(F.unix_micros("tpep_pickup_datetime"))) == [(1672533000000000,)]


def test_deleting_a_folder(spark, folder):
    spark.range(1).write.parquet(f"{folder}/x")
    assert delete_folder(spark, f"{folder}/x") and not delete_folder(spark, f"{folder}/x")
