"""Landing, conforming, writing and publishing on hand-made files."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from conftest import land_file, rows, session_zone
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmart.functions import names
from tripmart.operators import catalog, conform, sinks
from tripmart.operators.schemas import SchemaConflictError
from tripmart.plans import etl
from tripmart.roles import CATEGORIES, MONTHS, PRODUCTION_COLUMNS
from tripmart.session import (
    CHECKPOINT_DIR,
    OVERWRITE_MODE,
    clear_scratch,
    delete_folder,
    materialize,
    scratch_dir,
    sized_conf,
    temporary,
)
from tripmart.sources import landing, readers

RUN = date(2023, 6, 1)


def trips(spark, month: str, n: int, passengers: str = "double", start: int = 0):
    """n trips of a month, passengers 0.5, 1.5, ..."""
    return spark.range(start, start + n).select(
        F.col("id").alias("VendorID"),
        F.expr(f"TIMESTAMP_NTZ'{month}-01 00:30:00'").alias("tpep_pickup_datetime"),
        F.expr(f"TIMESTAMP_NTZ'{month}-01 02:30:00'").alias("tpep_dropoff_datetime"),
        (F.col("id") + 0.5).cast(passengers).alias("passenger_count"),
        F.lit(10.25).alias("total_amount"),
    )


@pytest.fixture
def zone(spark, folder):
    """Two months of yellow and one of green, as single files below a folder."""
    land_file(trips(spark, "2023-01", 3), folder, "raw/yellow_tripdata/yellow_tripdata_2023-01.parquet")
    land_file(trips(spark, "2023-02", 2), folder, "raw/yellow_tripdata/yellow_tripdata_2023-02.parquet")
    land_file(trips(spark, "2023-01", 4).drop("tpep_dropoff_datetime"), folder, "raw/green_tripdata/green_tripdata_2023-01.parquet")
    return folder


def database(spark, folder: str) -> str:
    name = "db_" + uuid.uuid4().hex
    catalog.create_database(spark, name, f"{folder}/{name}")
    return name


def test_manifest_lists_objects(spark, zone):
    found = landing.manifest(spark, f"{zone}/raw").select("dataset", "file_name", "source_date", "n_files")
    assert rows(found) == [
        ("green_tripdata", "green_tripdata_2023-01.parquet", "2023-01", 1),
        ("yellow_tripdata", "yellow_tripdata_2023-01.parquet", "2023-01", 1),
        ("yellow_tripdata", "yellow_tripdata_2023-02.parquet", "2023-02", 1),
    ]


def test_only_files_that_have_not_landed_are_fetched(spark, zone):
    links = spark.createDataFrame(
        [(f"https://host/d/{n}",) for n in ("yellow_tripdata_2023-01.parquet ", "yellow_tripdata_2023-03.parquet", "fhv_tripdata_2023-01.parquet")],
        "href string",
    )
    landed = landing.manifest(spark, f"{zone}/raw")
    missing = landing.files_to_fetch(landing.wanted_files(links), landed)
    assert rows(missing.select("dataset", "file_name")) == [
        ("fhv_tripdata", "fhv_tripdata_2023-01.parquet"),
        ("yellow_tripdata", "yellow_tripdata_2023-03.parquet"),
    ]
    present = missing.join(landed, "file_name", "left_semi")
    assert present.isEmpty()


def test_lookup_by_prefix_takes_the_first_path(spark, zone):
    wanted = spark.createDataFrame([("yellow",), ("yellow_tripdata_2023-02.parquet",), ("hv",)], "file_name string")
    found = landing.resolve(wanted, landing.manifest(spark, f"{zone}/raw"))
    assert rows(found.select("file_name", names.object_name(F.col("path")))) == [
        ("hv", None),
        ("yellow", "yellow_tripdata_2023-01.parquet"),
        ("yellow_tripdata_2023-02.parquet", "yellow_tripdata_2023-02.parquet"),
    ]


def test_configured_grid(spark):
    grid = rows(landing.configured_grid(spark, CATEGORIES, MONTHS[0], MONTHS[-1]))
    assert len(grid) == 20
    assert grid[0] == ("For-Hire Vehicle Trip Records", "2023-01")
    assert {m for _, m in grid} == set(MONTHS)


def test_fetch_plan(spark, zone):
    anchors = [
        ("yellow_tripdata_2023-01.parquet", "Yellow Taxi Trip Records"),
        ("yellow_tripdata_2023-03.parquet", "Yellow Taxi Trip Records"),
        ("green_tripdata_2023-02.parquet", "Green Taxi Trip Records"),
        ("green_tripdata_2023-02_fixed.parquet", "Green Taxi Trip Records"),
    ]
    page = "".join(f'<a href="https://host/{file}">{text}</a>' for file, text in anchors)
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    plan = etl.plan_fetch(pages, ["page_id"], landing.manifest(spark, f"{zone}/raw"))
    assert rows(plan.to_fetch.select("dataset", "file_name")) == [
        ("green_tripdata", "green_tripdata_2023-02.parquet"),
        ("yellow_tripdata", "yellow_tripdata_2023-03.parquet"),
    ]
    missing = rows(plan.missing)
    assert len(missing) == 20 - 3
    assert (1, "Yellow Taxi Trip Records", "2023-02") in missing
    assert (1, "Yellow Taxi Trip Records", "2023-03") not in missing


@pytest.mark.parametrize("zone_name", ["UTC", "America/Sao_Paulo", "America/New_York"])
def test_conform_keeps_wall_clock_and_adds_audit_columns(spark, folder, zone_name):
    wall = spark.sql("SELECT TIMESTAMP_NTZ'2023-03-12 02:30:00' AS at UNION ALL SELECT TIMESTAMP_NTZ'2023-05-01 00:30:00'")
    land_file(wall, folder, "raw/yellow_tripdata/yellow_tripdata_2023-03.parquet")
    with session_zone(spark, zone_name):
        staged = conform.conform(readers.read_landed(spark, f"{folder}/raw"), RUN)
        assert staged.columns == ["at", "ingestion_date", "data_source", "source_date"]
        assert dict(staged.dtypes)["at"] == "timestamp"
        found = rows(staged.select(F.unix_seconds("at"), "ingestion_date", "source_date"))
    assert found == [(1678588200, RUN, "2023-03"), (1682901000, RUN, "2023-03")]


def test_conform_dates_rows_by_the_day_of_the_run(spark, zone):
    staged = conform.conform(readers.read_landed(spark, f"{zone}/raw", "yellow_tripdata"))
    assert staged.select("ingestion_date").distinct().count() == 1
    assert dict(staged.dtypes)["ingestion_date"] == "date"


def test_projection_keeps_order_case_and_what_is_present(spark):
    df = spark.createDataFrame([(1, 2.7, "x")], "vendorid int, passenger_count double, extra string")
    assert conform.select_present(df, PRODUCTION_COLUMNS).columns == ["passenger_count"]
    assert conform.select_present(df, PRODUCTION_COLUMNS, ignore_case=True).columns == ["VendorID", "passenger_count"]
    assert conform.select_present(df, ["nothing"]).columns == df.columns
    order = ["extra", "missing", "vendorid"]
    assert conform.select_present(df, order).columns == ["extra", "vendorid"]


def test_each_integer_column_is_cast_on_its_own(spark):
    df = spark.createDataFrame([(1.9, "a")], "VendorID double, other string")
    assert conform.production_rows(df, ["VendorID", "passenger_count"]).dtypes == [("VendorID", "int")]


def test_profile_and_sources(spark, zone):
    staged = conform.conform(readers.read_landed(spark, f"{zone}/raw", "yellow_tripdata"), RUN)
    assert rows(conform.profile(staged)) == [("yellow_tripdata", "2023-01", 3, 8), ("yellow_tripdata", "2023-02", 2, 8)]
    assert len(rows(conform.distinct_sources(staged))) == 2


def test_drifting_schemas_are_read_together(spark, folder):
    raw = f"{folder}/raw/yellow_tripdata"
    for month, kind, extra in (("2023-01", "int", "Airport_fee"), ("2023-02", "bigint", "airport_fee"), ("2023-03", "double", None), ("2023-04", "int", None)):
        df = trips(spark, month, 2, kind)
        land_file(df.withColumn(extra, F.lit(1.0)) if extra else df, raw, f"yellow_tripdata_{month}.parquet")
    land_file(
        trips(spark, "2023-05", 1, "string").withColumn("tpep_pickup_datetime", F.lit(datetime(2023, 5, 1)).cast("timestamp")),
        raw, "yellow_tripdata_2023-05.parquet",
    )
    merged = readers.read_landed(spark, raw)
    assert dict(merged.dtypes)["passenger_count"] == "string"
    assert dict(merged.dtypes)["tpep_pickup_datetime"] == "timestamp"
    assert [c.lower() for c in merged.columns].count("airport_fee") == 1
    typed = readers.read_landed(spark, raw, targets={"passenger_count": "int"})
    assert dict(typed.dtypes)["passenger_count"] == "int"
    assert typed.count() == 9
    assert typed.agg(F.sum("passenger_count"), F.sum("airport_fee")).first()[1] == 4.0
    groups = readers.schema_groups(spark, readers.object_paths(landing.manifest(spark, raw)))
    assert len(groups) == 4
    report = rows(readers.schema_report(spark, raw).filter("column_name = 'passenger_count'").drop("dataset"))
    assert report == [
        ("passenger_count", "bigint", "2023-02", "2023-02", 1),
        ("passenger_count", "double", "2023-03", "2023-03", 1),
        ("passenger_count", "int", "2023-01", "2023-04", 2),
        ("passenger_count", "string", "2023-05", "2023-05", 1),
    ]


def test_numbers_of_different_width_are_widened(spark, folder):
    for month, kind in (("2023-01", "int"), ("2023-02", "bigint"), ("2023-03", "double")):
        land_file(trips(spark, month, 2, kind), folder, f"raw/yellow_tripdata_{month}.parquet")
    assert dict(readers.read_landed(spark, f"{folder}/raw").dtypes)["passenger_count"] == "double"


def _months(spark, path: str) -> list[tuple]:
    return rows(readers.read_zone(spark, path).groupBy("source_date").count())


def test_a_month_replaces_itself_and_no_other(spark, folder):
    def dated(month, n):
        return trips(spark, month, n).withColumn("source_date", F.lit(month))

    path = f"{folder}/staging"
    sinks.write_partitions(dated("2023-01", 3), path, ["source_date"])
    sinks.write_partitions(dated("2023-02", 2), path, ["source_date"])
    assert _months(spark, path) == [("2023-01", 3), ("2023-02", 2)]
    for _ in range(2):
        sinks.write_partitions(dated("2023-02", 4), path, ["source_date"], rebalance=True)
        assert _months(spark, path) == [("2023-01", 3), ("2023-02", 4)]


def test_append_adds_every_time(spark, folder):
    for _ in range(2):
        sinks.append_rows(trips(spark, "2023-01", 3), f"{folder}/out")
    assert readers.scan(spark, f"{folder}/out").count() == 6


def test_zone_of_drifting_months_is_read_together(spark, folder):
    for month, kind in (("2023-01", "int"), ("2023-02", "double")):
        rows_ = trips(spark, month, 2, kind).withColumn("source_date", F.lit(month))
        sinks.write_partitions(rows_, f"{folder}/staging", ["source_date"])
    zone = readers.read_zone(spark, f"{folder}/staging")
    assert dict(zone.dtypes)["passenger_count"] == "double"
    assert rows(zone.groupBy("source_date").count()) == [("2023-01", 2), ("2023-02", 2)]


def test_empty_source_stops_the_run(spark, folder):
    land_file(trips(spark, "2023-01", 0), folder, "raw/yellow_tripdata/yellow_tripdata_2023-01.parquet")
    name = database(spark, folder)
    with pytest.raises(readers.EmptySourceError):
        catalog.publish_folder(spark, f"{folder}/raw", f"{name}.yellow", f"{folder}/table")
    with pytest.raises(readers.EmptySourceError):
        readers.read_landed(spark, f"{folder}/raw", "green_tripdata")
    with pytest.raises(readers.EmptySourceError):
        etl.load_zones(spark, f"{folder}/raw", f"{folder}/s", f"{folder}/p", "yellow_tripdata", ["2023-07"])
    assert not spark.catalog.tableExists(f"{name}.yellow")


def test_publish_creates_once_then_replaces_months(spark, folder):
    name = database(spark, folder)
    table, place = f"{name}.yellow", f"{folder}/tables/yellow"

    def dated(month, n):
        return trips(spark, month, n).withColumn("source_date", F.lit(month))

    catalog.publish(spark, dated("2023-01", 3).unionByName(dated("2023-02", 2)), table, place, properties={"owner": "trips"})
    assert "owner=trips" in spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Table Properties'").first()[1]
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["source_date"]
    assert place in spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").first()[1]
    assert catalog.list_tables(spark, name) == ["yellow"]
    for _ in range(2):
        # columns in another order
        again = dated("2023-02", 4)
        catalog.publish(spark, again.select(*reversed(again.columns)), table, place)
        assert rows(spark.table(table).groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 4)]
    catalog.publish(spark, dated("2023-02", 1), table, place, append=True, rebalance=True)
    assert rows(spark.table(table).groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 5)]
    assert spark.table(table).agg(F.max("passenger_count")).first()[0] == 3.5


def test_published_and_registered_tables_gain_columns(spark, folder):
    name = database(spark, folder)

    def dated(month, n, *extra):
        return trips(spark, month, n).select("*", F.lit(month).alias("source_date"), *extra)

    later = dated("2023-02", 2, F.lit(1.75).alias("airport_fee")).drop("total_amount")
    for rows_ in (dated("2023-01", 3), later):
        catalog.publish(spark, rows_, f"{name}.published", f"{folder}/published")
        sinks.write_partitions(rows_, f"{folder}/zone", ["source_date"])
        catalog.register_folder(spark, f"{name}.registered", f"{folder}/zone")
    for table in ("published", "registered"):
        found = spark.table(f"{name}.{table}").groupBy("source_date").agg(F.sum("total_amount"), F.sum("airport_fee"))
        assert rows(found) == [("2023-01", 30.75, None), ("2023-02", None, 3.5)]
    with pytest.raises(SchemaConflictError):
        text = dated("2023-03", 1).withColumn("VendorID", F.lit("x"))
        catalog.publish(spark, text, f"{name}.published", f"{folder}/published")


def test_register_a_folder_without_months(spark, folder):
    name = database(spark, folder)
    sinks.append_rows(trips(spark, "2023-01", 3), f"{folder}/plain")
    catalog.register_folder(spark, f"{name}.plain", f"{folder}/plain")
    sinks.append_rows(trips(spark, "2023-01", 2), f"{folder}/plain")
    catalog.register_folder(spark, f"{name}.plain", f"{folder}/plain")
    assert spark.table(f"{name}.plain").count() == 5
    assert not any(c.isPartition for c in spark.catalog.listColumns(f"{name}.plain"))


def test_table_without_source_date_is_not_partitioned(spark, folder):
    name = database(spark, folder)
    for n in (3, 2):
        catalog.publish(spark, trips(spark, "2023-01", n), f"{name}.plain", f"{folder}/plain")
        assert spark.table(f"{name}.plain").count() == n


def test_register_zone_finds_folders_and_new_months(spark, zone):
    for dataset in ("yellow_tripdata", "green_tripdata"):
        etl.load_zones(spark, f"{zone}/raw", f"{zone}/staging", f"{zone}/production", dataset, ["2023-01"], run_date=RUN)
    land_file(trips(spark, "2023-01", 1), zone, "staging/yellow_tripdata/_delta_log/x.parquet")
    name = database(spark, zone)
    assert catalog.register_zone(spark, name, f"{zone}/staging") == ["green_tripdata", "yellow_tripdata"]
    table = spark.table(f"{name}.yellow_tripdata")
    assert rows(table.groupBy("source_date").count()) == [("2023-01", 3)]
    etl.load_zones(spark, f"{zone}/raw", f"{zone}/staging", f"{zone}/production", "yellow_tripdata", ["2023-02"], run_date=RUN)
    catalog.register_zone(spark, name, f"{zone}/staging")
    assert rows(spark.table(f"{name}.yellow_tripdata").groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 2)]


def test_whole_run_twice_and_publish_all(spark, zone):
    name = database(spark, zone)
    for months in (None, None, ["2023-02"]):
        etl.run_etl(spark, f"{zone}/raw", f"{zone}/run", name, ["yellow_tripdata"], months, run_date=RUN)
    yellow = spark.table(f"{name}.yellow_tripdata")
    assert rows(yellow.groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 2)]
    assert sorted(yellow.columns) == sorted(PRODUCTION_COLUMNS)
    assert dict(yellow.dtypes)["passenger_count"] == dict(yellow.dtypes)["VendorID"] == "int"
    assert rows(yellow.select("passenger_count").distinct()) == [(0,), (1,), (2,)]

    etl.load_zones(spark, f"{zone}/raw", f"{zone}/run/staging", f"{zone}/run/production", "green_tripdata", run_date=RUN)
    staging, target = database(spark, zone), database(spark, zone)
    catalog.register_zone(spark, staging, f"{zone}/run/staging")
    for _ in range(2):
        tables = catalog.publish_all(spark, staging, target, f"{zone}/run/production", f"{zone}/published")
        assert tables == [f"{target}.green_tripdata", f"{target}.yellow_tripdata"]
        assert [spark.table(t).count() for t in tables] == [4, 5]


def test_run_of_one_month_reads_and_replaces_that_month_only(spark, zone):
    name = database(spark, zone)
    land_file(trips(spark, "2023-03", 0), zone, "raw/yellow_tripdata/yellow_tripdata_2023-03.parquet")
    etl.run_etl(spark, f"{zone}/raw", f"{zone}/run", name, ["yellow_tripdata"], run_date=RUN)
    before = {f for f in spark.table(f"{name}.yellow_tripdata").inputFiles()}
    land_file(trips(spark, "2023-02", 6), zone, "raw/yellow_tripdata/yellow_tripdata_2023-02.parquet")
    etl.run_etl(spark, f"{zone}/raw", f"{zone}/run", name, ["yellow_tripdata"], ["2023-02"], run_date=RUN)
    table = spark.table(f"{name}.yellow_tripdata")
    assert rows(table.groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 6)]
    kept = before & set(table.inputFiles())
    assert kept and all("2023-01" in f for f in kept) and len(kept) == len([f for f in before if "2023-01" in f])


def test_months_are_replaced_whatever_the_session_is_set_to(spark, folder):
    table, before = f"{database(spark, folder)}.yellow", spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "static")
    try:
        for month, n in (("2023-01", 3), ("2023-02", 2), ("2023-02", 4)):
            catalog.publish(spark, trips(spark, month, n).withColumn("source_date", F.lit(month)), table, f"{folder}/yellow")
            assert spark.conf.get(OVERWRITE_MODE) == "static"
        assert rows(spark.table(table).groupBy("source_date").count()) == [("2023-01", 3), ("2023-02", 4)]
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def test_scratch_output_is_deleted(spark):
    df = trips(spark, "2023-01", 3)
    with temporary(df, "test") as copy:
        place = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert rows(copy) == rows(df)
    assert not delete_folder(spark, place)
    kept = materialize(df, "test").inputFiles()[0].rsplit("/", 1)[0]
    assert clear_scratch(spark) > 0
    assert not delete_folder(spark, kept)


def test_scratch_folder_needs_the_shared_folder_on_a_cluster():
    def session(master, conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch_dir(session("yarn", {CHECKPOINT_DIR: "hdfs:///shared/"}), "x").startswith("hdfs:///shared/tripmart/x-")
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        scratch_dir(session("yarn", {}), "x")
    assert scratch_dir(session("local[4]", {}), "x").startswith("/")


def test_partition_settings_grow_with_the_input():
    def numbers(size):
        return [int(v) for v in sized_conf(size).values()]

    assert numbers(10**9) == [128 * 2**20, 200]
    assert numbers(10**12) == [128 * 2**20, 931]
    assert numbers(10**13) == [128 * 2**20, 9313]
    assert numbers(10**14) == [500_000_000, 50_000]


def test_scratch_folders_are_new_and_materialize_keeps_rows(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    df = trips(spark, "2023-01", 3)
    kept = materialize(df, "test")
    assert rows(kept) == rows(df)
    assert kept.inputFiles()
