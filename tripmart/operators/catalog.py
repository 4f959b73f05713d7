"""Databases, registered zones and published tables."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import loads
from tripmart.operators.loads import PARTITION
from tripmart.operators.schemas import SchemaConflictError, resolved, widened
from tripmart.session import delete_folder
from tripmart.sources.landing import manifest
from tripmart.sources.readers import EmptySourceError, partition_folders, read_objects, read_zone, require_rows, zone_groups

PERIOD = "period"
FILE_FORMATS = ("parquet", "orc")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def _add_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give a table the columns it lacks; rows loaded before show NULL in them."""
    known = {c.lower() for c in spark.table(table).columns}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def _aligned(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows in the table's columns and types, NULL where they have none; ``insertInto`` goes by position."""
    present = {c.lower() for c in rows.columns}
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.schema
        ]
    )


def check_types(spark: SparkSession, table: str, new: T.StructType) -> dict[str, T.DataType]:
    """Type of each column of a table and of new rows together; raises before anything is written if there is none."""
    known = spark.table(table).schema if spark.catalog.tableExists(table) else T.StructType()
    return resolved(known, new, table)


def register_folder(spark: SparkSession, table: str, path: str) -> None:
    """A landed folder as a table, its columns taken from the files and its partitions from the folders.

    A table that exists picks up new partitions and new columns; one whose types the zone has outgrown is
    defined anew, as it holds no rows of its own. A folder in which a column has two types is refused,
    as a table could not be read over it.
    """
    groups = zone_groups(spark, path)
    if len(groups) > 1:
        raise SchemaConflictError(f"{path} holds columns of several types; write it with write_zone")
    schema = read_zone(spark, path).schema
    if spark.catalog.tableExists(table):
        known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
        if any(known.get(f.name.lower(), f.dataType) != f.dataType for f in schema):
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        in_files = spark.read.option("recursiveFileLookup", "true").parquet(path).columns
        by_folder = PARTITION in schema.names and PARTITION not in in_files
        partitioned = f" PARTITIONED BY ({PARTITION})" if by_folder else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{partitioned} LOCATION '{path}'")
    else:
        _add_columns(spark, table, schema)
    if loads.is_partitioned(spark, table):
        sync_partitions(spark, table, path)
    spark.catalog.refreshTable(table)


def sync_partitions(spark: SparkSession, table: str, path: str) -> None:
    """The table's months made those that have a folder: new ones added, gone ones dropped, in batches.

    One listing of the folder itself, whatever lies below its months.
    """
    folders, known = loads.months_of(spark, path.rstrip("/")), loads.known_months(spark, table)
    loads.add_months(spark, table, {month: place for month, place in folders.items() if month not in known})
    loads.drop_months(spark, table, known - set(folders))


def register_zone(spark: SparkSession, database: str, root: str) -> list[str]:
    """One table per dataset folder of a zone; returns the table names.

    Folders whose names begin with ``_`` hold logs, and the file source skips them.
    """
    base = re.sub(r"^\w+:/+", "/", root.rstrip("/")) + "/"
    folder = F.substring_index(F.substring_index("path", base, -1), "/", 1)
    names = manifest(spark, root).select(folder.alias("name")).distinct().orderBy("name")
    registered = []
    for row in names.toLocalIterator():
        register_folder(spark, f"{database}.{row.name}", f"{root.rstrip('/')}/{row.name}")
        registered.append(row.name)
    return registered


def publish(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    location: str,
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
    append: bool = False,
    rebalance: bool = False,
    months: list[str] | None = None,
    run_id: str | None = None,
    undated_month: Column | None = None,
) -> DataFrame:
    """Create the table, or load into it; returns the published table.

    The table is partitioned by ``source_date`` from its creation on if the rows have that column.
    A later run replaces the months it brings, so that running twice changes nothing; ``append``
    adds them instead. Rows read from monthly files come month by month and are written where they
    are; ``rebalance`` is for rows in no such order. ``months`` names further months that the rows stand
    for: those without rows are emptied. New columns are added to the table, and columns the rows
    lack are NULL. Rows of a narrower type are cast; if they need a wider one than the table has, it is
    promoted (see ``loads.promote``); types that have none in common raise before any change.

    Rows are written to a folder of their own, and the table's months are pointed to it then, so readers
    see a month as it was or as it is. ``run_id`` names that folder: a run that died is completed by another
    with its id, and one that was published is not repeated. Folders that were replaced stay for readers
    until ``loads.expire_loads``. Dated rows for a table without months partition it first, its rows
    lying in the month that ``undated_month`` gives them, or in none (see ``loads.partition_table``).
    """
    run_id = run_id or uuid.uuid4().hex
    partitioned = PARTITION in rows.columns
    if fmt not in FILE_FORMATS:
        return _publish_elsewhere(spark, rows, table, location, fmt, properties or {}, append)
    loads.finish_pending(spark, table)
    folder = loads.load_folder(location, run_id)
    if loads.is_published(spark, folder):
        return spark.table(table)
    if rebalance and partitioned:
        rows = rows.hint("rebalance", PARTITION)
    if not spark.catalog.tableExists(table):
        if not loads.write_load(rows, folder, fmt):
            delete_folder(spark, folder)
            raise EmptySourceError(f"no rows in the source of {table}")
        loads.create_table(rows, table, location, fmt, properties or {}, partitioned)
        loads.switch(spark, table, folder)
        return spark.table(table)
    if months is None and append:
        require_rows(rows, f"the source of {table}")
    types = check_types(spark, table, rows.schema)
    rows = widened(rows, types, table)
    dated = loads.is_partitioned(spark, table)
    if partitioned and not dated:
        loads.partition_table(spark, table, location, fmt, run_id, undated_month)
        dated = True
    loads.promote(spark, table, types, location, run_id, fmt)
    _add_columns(spark, table, rows.schema)
    aligned = _aligned(rows, spark.table(table))
    if append:
        aligned.write.insertInto(table)
        return spark.table(table)
    if not loads.write_load(aligned, folder, fmt) and months is None:
        delete_folder(spark, folder)
        raise EmptySourceError(f"no rows in the source of {table}")
    loads.switch(spark, table, folder)
    if months and dated:
        loads.drop_months(spark, table, set(months) - set(loads.months_of(spark, folder)))
    return spark.table(table)


def _publish_elsewhere(
    spark: SparkSession, rows: DataFrame, table: str, location: str, fmt: str, properties: dict[str, str], append: bool
) -> DataFrame:
    """``publish`` into a table format that commits its own loads."""
    require_rows(rows, f"the source of {table}")
    if not spark.catalog.tableExists(table):
        writer = rows.writeTo(table).using(fmt).tableProperty("location", location)
        for key, value in properties.items():
            writer = writer.tableProperty(key, value)
        (writer.partitionedBy(F.col(PARTITION)) if PARTITION in rows.columns else writer).create()
        return spark.table(table)
    types = check_types(spark, table, rows.schema)
    for f in spark.table(table).schema:
        if types[f.name.lower()] != f.dataType:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{f.name}` TYPE {types[f.name.lower()].simpleString()}")
    _add_columns(spark, table, rows.schema)
    aligned = _aligned(widened(rows, types, table), spark.table(table))
    if append:
        aligned.writeTo(table).append()
    else:
        aligned.writeTo(table).overwritePartitions()
    return spark.table(table)


def publish_folder(
    spark: SparkSession, source: str, table: str, location: str, months: list[str] | None = None, **options
) -> DataFrame:
    """Publish a production folder: all files below it, or the ``period`` folders of some months.

    Periods written by different runs may differ in schema and are read by groups. A month of
    ``months`` without a folder is emptied in the table.
    """
    folders = partition_folders(spark, source, PERIOD)
    if months is not None:
        wanted = {month.replace("-", "_") for month in months}
        folders = [f for f in folders if f.rsplit("=", 1)[-1] in wanted]
    if not folders:
        if not spark.catalog.tableExists(table):
            raise EmptySourceError(f"no rows in {source}")
        return publish(spark, spark.table(table).limit(0), table, location, months=months, **options)
    # the files' own data_source is that of the landed file
    rows = read_objects(spark, folders, with_source=False)
    return publish(spark, rows, table, location, months=months, **options)


def publish_all(
    spark: SparkSession, staging_db: str, target_db: str, production_root: str, table_root: str, parallel: int = 4
) -> list[str]:
    """Publish the production folder ``<dataset>_parquet`` of every table of the staging database.

    The tables are independent, so several publish jobs share the cluster. The first failure raises.
    """
    tables = list_tables(spark, staging_db)

    def run(name: str) -> str:
        table = f"{target_db}.{name}"
        publish_folder(spark, f"{production_root}/{name}_parquet", table, f"{table_root}/{name}")
        return table

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(run, tables))
