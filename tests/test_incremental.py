"""Incremental runs: nothing twice, nothing lost."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import land_file, rows
from pyspark.sql import functions as F

from tripmart.streaming import incremental

RUN = date(2023, 6, 1)


def month(spark, n: int, kind: str = "int"):
    return spark.range(n).select(F.col("id").cast(kind).alias("passenger_count"))


def counts(spark, target: str) -> list[tuple]:
    return rows(incremental.read_loaded(spark, target).groupBy("source_date").count())


def test_each_file_is_loaded_once(spark, folder):
    raw, target = f"{folder}/raw", f"{folder}/target"
    schema = month(spark, 1).schema

    def run():
        incremental.stream_uniform(spark, raw, target, schema, RUN)
        return counts(spark, target)

    land_file(month(spark, 3), raw, "yellow_tripdata_2023-01.parquet")
    assert run() == [("2023-01", 3)]
    assert run() == [("2023-01", 3)]
    land_file(month(spark, 7), raw, "yellow_tripdata_2023-02.parquet")
    land_file(month(spark, 2), raw, "late/yellow_tripdata_2023-01.parquet")
    assert run() == [("2023-01", 5), ("2023-02", 7)]


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_files_of_differing_schemas(spark, folder, files_per_batch):
    raw, target = f"{folder}/raw", f"{folder}/target"

    def run():
        incremental.stream_drifting(spark, raw, target, {"passenger_count": "int"}, RUN, files_per_batch)
        return counts(spark, target)

    for name, kind in (("2023-01", "int"), ("2023-02", "bigint"), ("2023-03", "double")):
        land_file(month(spark, 3, kind), raw, f"yellow_tripdata_{name}.parquet")
    expected = [("2023-01", 3), ("2023-02", 3), ("2023-03", 3)]
    assert run() == expected
    assert run() == expected
    land_file(month(spark, 4, "double"), raw, "late/yellow_tripdata_2023-01.parquet")
    assert run() == [("2023-01", 7), *expected[1:]]
    loaded = incremental.read_loaded(spark, target)
    assert dict(loaded.dtypes) == {
        "passenger_count": "int", "ingestion_date": "date", "data_source": "string", "source_date": "string",
    }


def test_a_batch_that_failed_after_its_write_adds_nothing_when_repeated(spark, folder, monkeypatch):
    raw, target = f"{folder}/raw", f"{folder}/target"
    land_file(month(spark, 3), raw, "yellow_tripdata_2023-01.parquet")
    land_file(month(spark, 2), raw, "yellow_tripdata_2023-02.parquet")
    write = incremental.write_partitions

    def lost(*args):
        write(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(incremental, "write_partitions", lost)
    with pytest.raises(Exception, match="driver lost"):
        incremental.stream_drifting(spark, raw, target, run_date=RUN)
    monkeypatch.setattr(incremental, "write_partitions", write)
    incremental.stream_drifting(spark, raw, target, run_date=RUN)
    assert counts(spark, target) == [("2023-01", 3), ("2023-02", 2)]
