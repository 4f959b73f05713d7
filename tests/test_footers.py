"""Footers by one job, the recorded schema of a zone, partitions by listing, and listings that are kept."""

from __future__ import annotations

import json
import shutil
import uuid
from datetime import date

import pytest
from conftest import land_file, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import catalog, sinks
from tripmart.plans import etl
from tripmart.sources import footers, landing, readers


def jobs_of(spark, run) -> int:
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def land(spark, folder, dataset, n, kinds):
    paths = []
    for at in range(n):
        path = f"{dataset}_{2000 + at // 12}-{at % 12 + 1:02}.parquet"
        land_file(spark.range(1).select(F.col("id").cast(kinds[at % len(kinds)]).alias("x"), F.lit(at).alias("y")), folder, path)
        paths.append(f"{folder}/{path}")
    return paths


@pytest.mark.parametrize("kinds", [["int"], ["int", "bigint", "double"]])
def test_jobs_do_not_grow_with_objects_or_alternating_types(spark, folder, kinds):
    counted = {}
    for n in (6, 48):
        paths = land(spark, f"{folder}/{n}", "yellow_tripdata", n, kinds)
        counted[n] = jobs_of(spark, lambda paths=paths: readers.schema_groups(spark, paths))
        groups = readers.schema_groups(spark, paths)
        assert sorted(path for _, members in groups for path in members) == sorted(paths)
        assert len(groups) == len(kinds) == len({schema["x"].dataType for schema, _ in groups})
    # a listing of more than 32 folders is a job of its own
    assert counted[48] <= counted[6] + 1 and counted[48] <= 8


def test_footers_tell_rows_nulls_and_ranges(spark, folder):
    values = spark.createDataFrame([(1, "a", None), (None, "b", 2.5), (7, None, 0.5)], "x int, s string, d double")
    values.coalesce(1).write.parquet(f"{folder}/t")
    row = footers.footers(spark, footers.files_of(spark, [f"{folder}/t"])).first()
    assert row.n_rows == 3 and T.StructType.fromJson(json.loads(row.schema)) == values.schema
    assert [tuple(c) for c in row.columns] == [("x", "int", 1, "1", "7"), ("s", "string", 1, "a", "b"), ("d", "double", 1, "0.5", "2.5")]


def test_schemas_of_files_that_spark_did_not_write(spark, folder):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"i": pa.array([1], pa.int32()), "wall": pa.array([0], pa.timestamp("us")), "instant": pa.array([0], pa.timestamp("us", tz="UTC"))})
    pq.write_table(table, f"{folder}/a_b_2023-01.parquet")
    pq.write_table(table, f"{folder}/a_b_2023-02.parquet", use_deprecated_int96_timestamps=True)
    for name in ("a_b_2023-01.parquet", "a_b_2023-02.parquet"):
        ((found, _),) = readers.schema_groups(spark, [f"{folder}/{name}"])
        assert {f.name: f.dataType for f in found} == {f.name: f.dataType for f in spark.read.parquet(f"{folder}/{name}").schema}


def test_a_zone_reads_no_footer_of_its_history(spark, folder, monkeypatch):
    month = lambda at: f"{2000 + at // 12}-{at % 12 + 1:02}"
    rows_ = spark.range(36).select((F.col("id") / 2).alias("x"), F.lit("").alias("source_date"))
    rows_ = rows_.withColumn("source_date", F.concat((F.col("x") / 6 + 2000).cast("int"), F.lit("-"), F.lpad(((F.col("x") * 2) % 12 + 1).cast("int"), 2, "0")))
    sinks.write_zone(rows_, f"{folder}/zone", "source_date", {}, [])
    assert readers.recorded_schema(spark, f"{folder}/zone") == rows_.schema
    asked = []
    monkeypatch.setattr(footers, "footers", lambda *a: asked.append(a))
    later = spark.createDataFrame([(0.5, 9, month(40))], "x double, more int, source_date string")
    sinks.write_zone(later, f"{folder}/zone", "source_date", {}, [month(40)])
    found = readers.read_zone(spark, f"{folder}/zone")
    assert found.count() == 37 and found.filter("more = 9").count() == 1 and not asked
    # a writer that tells nothing leaves no record, and footers are asked again
    monkeypatch.undo()
    sinks.write_partitions(later, f"{folder}/zone", ["source_date"])
    assert readers.recorded_schema(spark, f"{folder}/zone") is None
    assert readers.read_zone(spark, f"{folder}/zone").count() == 37


def test_folders_that_are_gone_leave_the_table(spark, folder):
    name = f"f_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name, f"{folder}/database")
    dated = spark.createDataFrame([(1, "2023-01"), (2, "2023-02"), (3, None)], "x int, source_date string")
    sinks.write_partitions(dated, f"{folder}/zone", ["source_date"])
    catalog.register_folder(spark, f"{name}.t", f"{folder}/zone")
    assert rows(spark.table(f"{name}.t")) == [(1, "2023-01"), (2, "2023-02"), (3, None)]
    shutil.rmtree(f"{folder}/zone/source_date=2023-01")
    sinks.write_partitions(spark.createDataFrame([(4, "2023-03")], "x int, source_date string"), f"{folder}/zone", ["source_date"])
    catalog.register_folder(spark, f"{name}.t", f"{folder}/zone")
    assert rows(spark.table(f"{name}.t")) == [(2, "2023-02"), (3, None), (4, "2023-03")]


def test_republished_files_are_found_and_their_months_loaded(spark, folder):
    name, kept = f"f_{uuid.uuid4().hex[:8]}", f"{folder}/kept"
    trips = lambda n: spark.range(n).select(F.col("id").alias("trip_id"), F.lit(1.5).alias("total_amount"))
    arguments = dict(columns=["trip_id", "total_amount", "source_date"], integers=[], run_date=date(2023, 6, 1))
    for month, n in (("2023-01", 3), ("2023-02", 2)):
        land_file(trips(n), folder, f"raw/yellow_tripdata_{month}.parquet")
    run = lambda: etl.run_changes(spark, f"{folder}/raw", f"{folder}/run", name, kept, **arguments)
    assert run() == {"yellow_tripdata": ["2023-01", "2023-02"]}
    assert run() == {}
    # a correction under the same name, with as many files
    land_file(trips(5), folder, "raw/yellow_tripdata_2023-02.parquet")
    land_file(trips(1), folder, "raw/yellow_tripdata_2023-03.parquet")
    found = landing.changes(landing.listing(spark, f"{folder}/raw"), spark.read.parquet(kept))
    assert rows(found.select("file_name", "change")) == [("yellow_tripdata_2023-02.parquet", "republished"), ("yellow_tripdata_2023-03.parquet", "new")]
    assert run() == {"yellow_tripdata": ["2023-02", "2023-03"]}
    counted = spark.table(f"{name}.yellow_tripdata").groupBy("source_date").count()
    assert rows(counted) == [("2023-01", 3), ("2023-02", 5), ("2023-03", 1)]
