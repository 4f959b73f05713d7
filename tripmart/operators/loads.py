"""Loads of a published table: written aside, and made visible by changing where the table's months lie.

A load is a folder of its own beside the table's, ``<location>-loads/<run id>``, with a folder per month. Readers see a month
as it was until the catalog points to the new folder, which is one change for each month, and as it is from then on.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.schemas import widened
from tripmart.session import OVERWRITE_OPTION, child_folders, delete_folder, months_side_by_side, path_exists, touch

PARTITION = "source_date"
LOADS = "-loads/"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
FINISHED, PUBLISHED = "_SUCCESS", "_PUBLISHED"
#: A table's property while its files and its types are changed one after the other.
PENDING = "tripmart.pending_load"
#: Suffix of the definition that takes a table's place.
NEXT = "__next"
PARTITIONS_AT_A_TIME = 200


def load_folder(location: str, run_id: str) -> str:
    return f"{location.rstrip('/')}{LOADS}{run_id}"


def write_load(rows: DataFrame, folder: str, fmt: str) -> bool:
    """Write the rows, by month if they have one; whether there are any.

    What an earlier attempt finished stays, and what it left unfinished is written anew.
    """
    spark = rows.sparkSession
    if not path_exists(spark, f"{folder}/{FINISHED}"):
        delete_folder(spark, folder)
        writer = rows.write.format(fmt)
        with months_side_by_side(spark):
            (writer.partitionBy(PARTITION) if PARTITION in rows.columns else writer).save(folder)
    if PARTITION in rows.columns:
        return bool(months_of(spark, folder))
    return not spark.read.format(fmt).schema(rows.schema).load(folder).isEmpty()


def is_published(spark: SparkSession, folder: str) -> bool:
    return path_exists(spark, f"{folder}/{PUBLISHED}")


def mark_published(spark: SparkSession, folder: str) -> None:
    touch(spark, f"{folder}/{PUBLISHED}")


def months_of(spark: SparkSession, folder: str) -> dict[str, str]:
    """Folder of each month of a load."""
    prefix = f"{PARTITION}="
    return {unquote(name[len(prefix):]): f"{folder}/{name}" for name in child_folders(spark, folder) if name.startswith(prefix)}


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def known_months(spark: SparkSession, table: str) -> set[str]:
    found = {unquote(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}
    return {NO_MONTH if month == "null" else month for month in found}


def month_location(spark: SparkSession, table: str, month: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({PARTITION} = {_literal(month)})")
    return next(row.data_type for row in described.collect() if row.col_name == "Location")


def table_location(spark: SparkSession, table: str) -> str:
    return next(row.data_type for row in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if row.col_name == "Location")


def add_months(spark: SparkSession, table: str, folders: dict[str, str]) -> None:
    """New partitions at their folders, many in one change."""
    items = sorted(folders.items())
    for at in range(0, len(items), PARTITIONS_AT_A_TIME):
        clauses = [f"PARTITION ({PARTITION} = {_literal(m)}) LOCATION {_literal(f)}" for m, f in items[at : at + PARTITIONS_AT_A_TIME]]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")


def drop_months(spark: SparkSession, table: str, months: Iterable[str]) -> None:
    """Take partitions out of the catalog; the files of a published table stay until ``expire_loads``."""
    items = sorted(months)
    for at in range(0, len(items), PARTITIONS_AT_A_TIME):
        clauses = [f"PARTITION ({PARTITION} = {_literal(m)})" for m in items[at : at + PARTITIONS_AT_A_TIME]]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(clauses)}")


def switch_months(spark: SparkSession, table: str, folder: str) -> None:
    """Point the months of a load to it, one change per month that the table has, and mark the load as published."""
    known, folders = known_months(spark, table), months_of(spark, folder)
    for month in sorted(known & set(folders)):
        spark.sql(f"ALTER TABLE {table} PARTITION ({PARTITION} = {_literal(month)}) SET LOCATION {_literal(folders[month])}")
    add_months(spark, table, {month: place for month, place in folders.items() if month not in known})
    mark_published(spark, folder)


def switch(spark: SparkSession, table: str, folder: str) -> None:
    """Make a load visible, month by month or, in a table without months, all at once."""
    if is_partitioned(spark, table):
        switch_months(spark, table, folder)
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
        mark_published(spark, folder)


def create_table(
    rows: DataFrame, table: str, location: str, fmt: str, properties: dict[str, str], partitioned: bool
) -> None:
    """An external table with the columns of ``rows`` and none of them."""
    # the table's own option, so that no session's setting has to change while months are replaced
    writer = rows.limit(0).writeTo(table).using(fmt).option("path", location).option(OVERWRITE_OPTION, "dynamic")
    for key, value in properties.items():
        writer = writer.tableProperty(key, value)
    (writer.partitionedBy(F.col(PARTITION)) if partitioned else writer).create()


def readable_as(old: T.DataType, new: T.DataType, fmt: str) -> bool:
    """Whether Spark reads files with a column of the one type in the other, wider one."""
    if old == new:
        return True
    if fmt != "parquet":
        return False
    short = isinstance(old, (T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(new, T.DecimalType):
        digits = new.precision - new.scale
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and digits >= old.precision - old.scale
        return (short and digits >= 10) or (isinstance(old, T.LongType) and digits >= 20)
    if isinstance(new, T.DoubleType):
        return short or isinstance(old, T.FloatType)
    return short and isinstance(new, (T.ShortType, T.IntegerType, T.LongType))


def _set_types(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give the table's columns their types by one change of the catalog, which SQL has no statement for here."""
    session = spark._jsparkSession.sessionState()
    columns = T.StructType([f for f in schema if f.name != PARTITION or not is_partitioned(spark, table)])
    new = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(columns.json())
    session.catalog().alterTableDataSchema(session.sqlParser().parseTableIdentifier(table), new)
    spark.catalog.refreshTable(table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def promote(spark: SparkSession, table: str, types: dict[str, T.DataType], location: str, run_id: str, fmt: str) -> None:
    """Give the columns of a table wider types.

    Where its files can be read in them, as whole numbers can as longer ones or doubles, that is one change
    of the catalog and no file is touched. Otherwise (longer whole numbers as doubles) all months are written
    anew first; types and months change one after the other then, and readers in between get an
    error. ``finish_pending`` completes that if the job dies there.
    """
    known = spark.table(table).schema
    wanted = T.StructType([T.StructField(f.name, types.get(f.name.lower(), f.dataType), f.nullable, f.metadata) for f in known])
    if wanted == known:
        return
    if all(readable_as(old.dataType, new.dataType, fmt) for old, new in zip(known, wanted)):
        _set_types(spark, table, wanted)
        return
    folder = load_folder(location, f"{run_id}-widened")
    write_load(widened(spark.table(table), types, table), folder, fmt)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}' = {_literal(folder)}, '{PENDING}.types' = {_literal(wanted.json())})")
    finish_pending(spark, table)


def finish_pending(spark: SparkSession, table: str) -> None:
    """Complete what a run that died has begun: a change of definitions, or of types and months."""
    if not spark.catalog.tableExists(table):
        if spark.catalog.tableExists(table + NEXT):
            spark.sql(f"ALTER TABLE {table + NEXT} RENAME TO {table}")
        return
    properties = _properties(spark, table)
    if PENDING in properties:
        _set_types(spark, table, T.StructType.fromJson(json.loads(properties[f"{PENDING}.types"])))
        switch(spark, table, properties[PENDING])
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}', '{PENDING}.types')")


def partition_table(spark: SparkSession, table: str, location: str, fmt: str, run_id: str, month: Column | None = None) -> None:
    """Partition a table that was created without months by ``source_date``, keeping its rows and properties.

    ``month`` tells the month of the rows it has; without it, and without such a column among its own, they
    lie in the partition of no month, which is their old folder as it is. The new definition, complete
    with its partitions, takes the old one's place by two renames; a run that dies between them is completed by
    ``finish_pending``.
    """
    old = spark.table(table)
    # a table that owns its files would take them along when its definition is dropped
    moves = month is not None or PARTITION in old.columns or spark.catalog.getTable(table).tableType != "EXTERNAL"
    rows = old.withColumn(PARTITION, (F.col(PARTITION) if PARTITION in old.columns else F.lit(None)) if month is None else month)
    rows = rows.withColumn(PARTITION, F.col(PARTITION).cast("string"))
    rows = rows.select(*[c for c in rows.columns if c != PARTITION], PARTITION)
    if moves:
        folder = load_folder(location, f"{run_id}-partitioned")
        write_load(rows.hint("rebalance", PARTITION), folder, fmt)
        folders = months_of(spark, folder)
    else:
        folders = {NO_MONTH: table_location(spark, table)}
    kept = {k: v for k, v in _properties(spark, table).items() if not k.startswith(("transient", "spark."))}
    spark.sql(f"DROP TABLE IF EXISTS {table + NEXT}")
    create_table(rows, table + NEXT, f"{location.rstrip('/')}-{run_id}", fmt, kept, partitioned=True)
    add_months(spark, table + NEXT, folders)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before")
    spark.sql(f"ALTER TABLE {table + NEXT} RENAME TO {table}")
    spark.sql(f"DROP TABLE {table}__before")


def expire_loads(spark: SparkSession, table: str, location: str) -> list[str]:
    """Delete the loads that no month of the table points to any more; returns their run ids.

    For times when no reader is under way that began before the last load.
    """
    places = {table_location(spark, table)}
    if is_partitioned(spark, table):
        places |= {month_location(spark, table, month) for month in known_months(spark, table)}
    used = {place.rstrip("/").rsplit(LOADS, 1)[1].split("/", 1)[0] for place in places if LOADS in place}
    expired = sorted(set(child_folders(spark, load_folder(location, ""))) - used)
    for run_id in expired:
        delete_folder(spark, load_folder(location, run_id))
    return expired
