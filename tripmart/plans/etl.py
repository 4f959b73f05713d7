"""The whole batch run: landed objects to staging, production and published tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.catalog import PERIOD, check_types, create_database, publish_all, publish_folder, register_zone
from tripmart.operators.conform import conform, production_rows
from tripmart.operators.schemas import resolved
from tripmart.operators.sinks import write_zone, zone_schema
from tripmart.roles import CATEGORIES, INTEGER_COLUMNS, MONTHS, PRODUCTION_COLUMNS
from tripmart.session import materialize, path_exists, temporary
from tripmart.sources import landing, links
from tripmart.sources.landing import manifest
from tripmart.sources.readers import EmptySourceError, read_objects, require_rows


@dataclass(frozen=True)
class FetchPlan:
    """What a run has to fetch, and the categories and months it finds no link for."""

    to_fetch: DataFrame
    missing: DataFrame


def plan_fetch(
    pages: DataFrame, keys: list[str], landed: DataFrame, categories: list[str] = CATEGORIES, months: list[str] = MONTHS
) -> FetchPlan:
    """First link per page, category and month, less the files that have landed.

    Raises nothing for what is missing: it is a table of its own, for the caller to act on.
    """
    first = links.first_links(links.category_links(links.page_links(pages, keys), categories, months), keys)
    to_fetch = landing.files_to_fetch(landing.wanted_files(first).distinct(), landed)
    return FetchPlan(to_fetch, links.missing_links(pages, first, keys, categories, months))


def load_zones(
    spark: SparkSession,
    raw: str,
    staging: str,
    production: str,
    dataset: str,
    months: list[str] | None = None,
    columns: list[str] = PRODUCTION_COLUMNS,
    integers: list[str] = INTEGER_COLUMNS,
    run_date: date | None = None,
    ignore_case: bool = False,
    landed: DataFrame | None = None,
    table: str | None = None,
) -> list[str]:
    """Conform the landed objects of a dataset and write both zones; returns the months loaded.

    ``months`` limits the run; the months loaded replace themselves in both zones and no others, and one
    that has landed without rows is emptied. A zone holds one type per column over all runs: the wider
    one where they differ. Types that have none in common, in a zone or in ``table``, which the rows are to
    be published to, raise before anything is written. ``landed`` is a listing of ``raw`` made before.

    Production keeps ``source_date`` in its files and lies in one folder per month,
    ``<dataset>_parquet/period=<yyyy_MM>``. It is computed from the landed files again, which reads
    eight columns, rather than from the staging copy of all of them.
    """
    landed = (manifest(spark, raw) if landed is None else landed).filter(F.col("dataset") == dataset)
    if months is not None:
        landed = landed.filter(F.col("source_date").isin(months))
    periods = {row.path: row.source_date for row in landed.select("path", "source_date").toLocalIterator()}
    if not periods:
        raise EmptySourceError(f"nothing has landed for {dataset} {months or ''} under {raw}")
    paths, loaded = sorted(periods, key=lambda path: (periods[path], path)), sorted(set(periods.values()))
    rows = conform(read_objects(spark, paths, {c: "int" for c in integers}), run_date)
    common = production_rows(rows, columns, integers, ignore_case)
    period = F.replace(F.col("source_date"), F.lit("-"), F.lit("_"))
    zones = [
        (rows, f"{staging}/{dataset}", "source_date"),
        (common.withColumn(PERIOD, period), f"{production}/{dataset}_parquet", PERIOD),
    ]
    known = [zone_schema(spark, path, by) for _, path, by in zones]
    if all(schema is None for schema in known):
        require_rows(rows, f"{dataset} under {raw}")
    types = [resolved(schema or T.StructType(), own.schema, path) for (own, path, _), schema in zip(zones, known)]
    if table is not None:
        check_types(spark, table, common.schema)
    for (own, path, by), wider in zip(zones, types):
        write_zone(own, path, by, wider, loaded)
    return loaded


def run_etl(
    spark: SparkSession,
    raw: str,
    root: str,
    database: str,
    datasets: list[str],
    months: list[str] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Load each dataset under ``root`` and publish the months loaded; returns the tables by dataset.

    The landed files are listed once.
    """
    create_database(spark, database, f"{root}/database")
    published = {}
    with temporary(manifest(spark, raw), "landed") as landed:
        for dataset in datasets:
            table = f"{database}.{dataset}"
            loaded = load_zones(
                spark, raw, f"{root}/staging", f"{root}/production", dataset, months, landed=landed, table=table, **options
            )
            source = f"{root}/production/{dataset}_parquet"
            published[dataset] = publish_folder(spark, source, table, f"{root}/tables/{dataset}", loaded)
    return published


def run_changes(spark: SparkSession, raw: str, root: str, database: str, kept: str, **options) -> dict[str, list[str]]:
    """Load and publish the months whose objects are new or were published again since the listing in ``kept``.

    Returns the months by dataset. The listing is kept anew when all have been loaded, so a run that dies
    is repeated; the first run loads everything. Months whose objects are gone stay as they are.
    """
    with temporary(landing.listing(spark, raw), "now") as now:
        if path_exists(spark, kept):
            due = landing.changes(now, spark.read.parquet(kept)).filter("change != 'gone'")
        else:
            due = now
        months: dict[str, list[str]] = {}
        for row in due.select("dataset", "source_date").distinct().orderBy("dataset", "source_date").toLocalIterator():
            months.setdefault(row.dataset, []).append(row.source_date)
        for dataset, own in months.items():
            run_etl(spark, raw, root, database, [dataset], own, **options)
        landing.keep_listing(now, kept)
    return months


@dataclass(frozen=True)
class Run:
    """What a whole run had to fetch, what it found no link for, and the tables it published."""

    plan: FetchPlan
    tables: list[str]


def run_all(
    spark: SparkSession,
    pages: DataFrame,
    keys: list[str],
    raw: str,
    root: str,
    staging_db: str,
    target_db: str,
    categories: list[str] = CATEGORIES,
    months: list[str] = MONTHS,
    **options,
) -> Run:
    """The whole job: plan, load, register staging, publish.

    The links of the pages, for the given categories and months, tell which files there are; those that
    have not landed are in the plan for the caller to fetch, and the wanted ones that have are loaded,
    dataset by dataset. Staging is registered as ``staging_db``, and every dataset in it is published
    to ``target_db``.
    """
    landed = materialize(manifest(spark, raw), "landed")
    plan = plan_fetch(pages, keys, landed, categories, months)
    create_database(spark, staging_db, f"{root}/{staging_db}")
    create_database(spark, target_db, f"{root}/{target_db}")
    first = links.first_links(links.category_links(links.page_links(pages, keys), categories, months), keys)
    wanted = landed.join(landing.wanted_files(first).select("dataset", "file_name").distinct(), ["dataset", "file_name"])
    datasets = [row.dataset for row in wanted.select("dataset").distinct().orderBy("dataset").toLocalIterator()]
    for dataset in datasets:
        load_zones(
            spark, raw, f"{root}/staging", f"{root}/production", dataset, landed=wanted, table=f"{target_db}.{dataset}", **options
        )
    if datasets:
        register_zone(spark, staging_db, f"{root}/staging")
    return Run(plan, publish_all(spark, staging_db, target_db, f"{root}/production", f"{root}/tables"))
