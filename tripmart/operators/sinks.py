"""Parquet sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.schemas import widened
from tripmart.session import OVERWRITE_OPTION, child_folders, delete_folder, months_side_by_side, write_text
from tripmart.sources.readers import RECORD, read_zone, zone_groups


def write_partitions(df: DataFrame, path: str, by: list[str], rebalance: bool = False) -> None:
    """Replace exactly the partitions that occur in ``df``; others stay as they are.

    No shuffle by default: rows read from monthly files arrive month by month, so each task writes
    few partitions. ``rebalance`` is for rows in no such order. It shuffles by the partition columns
    and lets AQE split a month that is too large for one task and join small ones.
    """
    # what is recorded of the folder holds again when its writer has told so
    delete_folder(df.sparkSession, f"{path.rstrip('/')}/{RECORD}")
    rows = df.hint("rebalance", *by) if rebalance else df
    with months_side_by_side(df.sparkSession):
        rows.write.mode("overwrite").option(OVERWRITE_OPTION, "dynamic").partitionBy(*by).parquet(path)


def zone_schema(spark: SparkSession, path: str, by: str) -> T.StructType | None:
    """Columns of a zone as its runs wrote them; None where nothing has been written."""
    try:
        return read_zone(spark, path, (by,)).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_zone(df: DataFrame, path: str, by: str, types: dict[str, T.DataType], months: list[str]) -> None:
    """``write_partitions`` into a zone that holds one type per column over all its runs.

    ``types`` are those that ``schemas.resolved`` finds for the zone and the rows. Where the zone's own
    are narrower, its other months are written anew in them first. A month of ``months`` that has no rows
    any more is emptied. The zone keeps a record of its columns, which the next run extends by those of its
    rows, so the footers of the months before are not read again; a run that dies leaves no record, and the
    next one reads them all.
    """
    spark = df.sparkSession
    known, groups = zone_schema(spark, path, by), []
    if known is not None:
        groups = zone_groups(spark, path, by)
    rows = widened(df, types, path)
    landed = {name for name in child_folders(spark, path) if name.removeprefix(f"{by}=").replace("_", "-") in months}
    if landed:
        brought = {f"{by}={row[0]}" for row in df.select(by).distinct().toLocalIterator()}
        for name in sorted(landed - brought):
            delete_folder(spark, f"{path}/{name}")
    if len(groups) > 1 or any(types.get(f.name.lower(), f.dataType) != f.dataType for f in known or []):
        label = F.replace(F.col(by), F.lit("_"), F.lit("-"))
        others = widened(read_zone(spark, path, (by,)).filter(~label.isin(months)), types, path)
        # a month is replaced when all have been written aside, so they are read where they lie
        write_partitions(others, path, [by])
    write_partitions(rows, path, [by])
    held = [T.StructField(f.name, types.get(f.name.lower(), f.dataType)) for f in known or []]
    names = {f.name.lower() for f in held}
    schema = T.StructType(held + [T.StructField(f.name, f.dataType) for f in rows.schema if f.name.lower() not in names])
    write_text(spark, f"{path.rstrip('/')}/{RECORD}", schema.json())


def append_rows(df: DataFrame, path: str) -> None:
    """Plain append: a second run adds the rows a second time."""
    df.write.mode("append").parquet(path)


def write_objects(df: DataFrame, path: str, name: Column) -> None:
    """Land rows as monthly objects: folders ``object=<name>.parquet``, named by an expression."""
    write_partitions(df.withColumn("object", name), path, ["object"], rebalance=True)
