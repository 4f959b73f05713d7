"""Landed rows to staging rows to production rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import names
from tripmart.functions.numeric import to_int
from tripmart.functions.time import utc_instant
from tripmart.roles import INTEGER_COLUMNS, PRODUCTION_COLUMNS


def conform(landed: DataFrame, run_date: date | None = None) -> DataFrame:
    """Staging rows: every TIMESTAMP_NTZ as an instant, and the audit columns at the end.

    ``landed`` carries the path of its file in ``data_source``, as the readers put it there. One
    projection, so the scan, the casts and the write run as a single stage.
    """
    audit = {"ingestion_date", "data_source", "source_date"}
    columns = [
        utc_instant(landed, f.name).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in landed.schema
        if f.name not in audit
    ]
    return landed.select(
        *columns,
        (F.current_date() if run_date is None else F.lit(run_date)).alias("ingestion_date"),
        "data_source",
        names.source_date(F.col("data_source")).alias("source_date"),
    )


def select_present(df: DataFrame, wanted: list[str], ignore_case: bool = False) -> DataFrame:
    """The wanted columns that exist, in the wanted order; all columns if none exists.

    Names are compared by case unless ``ignore_case``, which also gives them the wanted spelling.
    """
    if ignore_case:
        present = {c.lower(): c for c in df.columns}
        columns = [F.col(present[c.lower()]).alias(c) for c in wanted if c.lower() in present]
    else:
        columns = [F.col(c) for c in wanted if c in df.columns]
    return df.select(*columns) if columns else df


def production_rows(
    staging: DataFrame,
    wanted: list[str] = PRODUCTION_COLUMNS,
    integers: list[str] = INTEGER_COLUMNS,
    ignore_case: bool = False,
) -> DataFrame:
    """The common columns that are present, with each present integer column cast on its own."""
    rows = select_present(staging, wanted, ignore_case)
    return rows.select(*[to_int(F.col(c)).alias(c) if c in integers else F.col(c) for c in rows.columns])


def profile(staging: DataFrame) -> DataFrame:
    """Rows and columns per dataset and month. Reads the path only, and takes it apart once per file."""
    path = names.object_path(F.col("data_source"))
    counts = staging.groupBy("data_source").agg(F.count("*").alias("n_rows"))
    return (
        counts.groupBy(
            names.dataset(names.object_name(path)).alias("dataset"), names.source_date(path).alias("source_date")
        )
        .agg(F.sum("n_rows").alias("n_rows"))
        .withColumn("n_columns", F.lit(len(staging.columns)).cast("bigint"))
    )


def distinct_sources(staging: DataFrame) -> DataFrame:
    """The objects the rows came from."""
    files = staging.select("data_source").distinct()
    paths = files.select(names.object_path(F.col("data_source")).alias("path")).distinct()
    return paths.select("path", names.object_name(F.col("path")).alias("file_name"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows in a given order; each task keeps ``n`` rows, without a full sort."""
    return df.orderBy(*order).limit(n)
