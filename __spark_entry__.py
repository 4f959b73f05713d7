"""

The test tables play the trip tables as FIXTURES.md says: ``events`` for hourly reports, ``orders``
and ``lineitem`` for monthly ones and as monthly landed files, ``pages`` as link pages.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmart.functions import names  # noqa: E402
from tripmart.functions.numeric import round_half_up, to_int  # noqa: E402
from tripmart.functions.time import in_month, month_label, month_start, wall_clock  # noqa: E402
from tripmart.operators import averages, catalog, conform, distribution, quality, sinks, trends  # noqa: E402
from tripmart.plans import etl, reports  # noqa: E402
from tripmart.roles import TripRoles  # noqa: E402
from tripmart.session import delete_folder, scratch_dir  # noqa: E402
from tripmart.sources import landing, links, readers  # noqa: E402
from tripmart.streaming import incremental  # noqa: E402

try:
    import corpus_pipeline
    from tripmart.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tripmart.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_DATE = date(2023, 6, 1)
EVENTS = TripRoles(pickup="ts", vendor="event_type", passengers="passengers", amount="value")
ORDERS = TripRoles(pickup="o_orderdate", vendor="o_orderpriority", amount="o_totalprice")
LINEITEM = TripRoles(pickup="l_shipdate", vendor="l_linenumber", passengers="l_quantity", amount="l_extendedprice")
HOURLY_MONTH = "2024-01"
FILTER_MONTH = "1998-05"
CATEGORIES = ["The", "que", "DER", "nt", "no such category"]
PERIODS = ["/th", "/en", "on"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.scan(spark, f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    passengers = F.get_json_object("props", "$.k").cast("int").alias("passengers")
    return _table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", passengers)


def _second_fleet(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin("view", "click"))


def _first_fleet(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("event_type").isin("view", "click"))


def _text(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").cast("string")


# Reports


def hourly_avg_passengers_with_vendor_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return averages.hourly_average_with_vendor_baseline(events, _second_fleet(events), HOURLY_MONTH, EVENTS, EVENTS)


def trips_with_vendor_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    joined = averages.with_vendor_baseline(events, _second_fleet(events), EVENTS, EVENTS)
    return joined.select(
        "event_id",
        "event_type",
        "passengers",
        round_half_up(F.col("baseline")).alias("baseline"),
        round_half_up(F.col("combined")).alias("combined"),
    )


def vendor_avg_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return averages.vendor_average(_events(spark, sf_dir), EVENTS.vendor, F.col(EVENTS.passengers))


def monthly_avg_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _table(spark, sf_dir, "lineitem")
    passengers = to_int(F.col(LINEITEM.passengers))
    return averages.monthly_average(trips, LINEITEM.pickup, passengers, "average_passenger_count")


def monthly_avg_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _table(spark, sf_dir, "orders")
    return averages.monthly_average(trips, ORDERS.pickup, F.col(ORDERS.amount), "average_total_amount")


def month_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _table(spark, sf_dir, "lineitem")
    month = trips.filter(in_month(trips, LINEITEM.pickup, FILTER_MONTH))
    return month.groupBy("l_linenumber").agg(F.count("*").alias("n_trips"))


def hour_of_day_avg_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    second = _second_fleet(events).withColumnRenamed("ts", "second_pickup")
    second_roles = TripRoles(pickup="second_pickup", vendor="event_type", passengers="passengers", amount="value")
    pooled = averages.fleet([(_first_fleet(events), EVENTS), (second, second_roles)])
    return averages.hour_of_day_average(pooled, HOURLY_MONTH)


def peak_low_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.peak_and_low_hours(_events(spark, sf_dir), EVENTS.pickup)


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _table(spark, sf_dir, "orders")
    return trends.monthly_trend(trips, ORDERS.pickup, F.col(ORDERS.amount), "avg_amount")


def amount_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.monthly_distribution(_table(spark, sf_dir, "lineitem"), LINEITEM.pickup, LINEITEM.amount)


def amount_quantiles_by_cutting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles with so few values allowed per task that every month is cut, some of them repeatedly."""
    trips = _table(spark, sf_dir, "lineitem")
    rows = trips.select(month_start(trips, LINEITEM.pickup).alias("first_day"), LINEITEM.amount)
    found = distribution.quantiles(rows, "first_day", LINEITEM.amount, [0.1, 0.5, 0.99], values_per_task=40)
    return found.select(
        month_label(F.col("first_day")).alias("month"),
        "n",
        *[round_half_up(F.col("q")[i]).alias(name) for i, name in enumerate(["p10", "p50", "p99"])],
    )


def approximate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles from the sketch alone, with as much accuracy as the largest group has rows, which makes them exact."""
    events = _events(spark, sf_dir)
    found = distribution.approximate_quantiles(events, "event_type", "value", [0.25, 0.5, 0.75], accuracy=1_000_000)
    return found.select("event_type", "n", *[F.col("q")[i].alias(name) for i, name in enumerate(["q1", "q2", "q3"])])


def amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.monthly_histogram(_table(spark, sf_dir, "orders"), ORDERS.pickup, ORDERS.amount, 50_000.0)


def amount_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.outliers(_events(spark, sf_dir), EVENTS.pickup, EVENTS.amount)
    return found.select("event_id", "month", "value", "low_fence", "high_fence")


def quality_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a trip is picked up on the order date, dropped off on the ship date, and filed under the latter
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem")
    trips = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "source_date", month_label(month_start(lines, "l_shipdate"))
    )
    roles = TripRoles("o_orderdate", "l_shipdate", "l_linenumber", "l_quantity", "l_extendedprice")
    return quality.quality_rule_counts(trips, ["l_orderkey", "l_linenumber"], roles)


# Landed files


def _trips(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table under the trip files' column names; the pickup column is first."""
    if table == "orders":
        return _table(spark, sf_dir, "orders").select(
            F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("o_custkey").alias("VendorID"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderkey").alias("trip_id"),
            F.col("o_orderpriority").alias("priority"),
        )
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_linenumber").alias("VendorID"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_orderkey").alias("trip_id"),
    )


def _object_name(trips: DataFrame, dataset: str) -> Column:
    month = month_label(month_start(trips, "tpep_pickup_datetime"))
    return F.concat(F.lit(f"{dataset}_"), month, F.lit(".parquet"))


def _land(trips: DataFrame, root: str, dataset: str) -> None:
    sinks.write_objects(trips, f"{root}/{dataset}", _object_name(trips, dataset))


def _landed(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """A new landing zone with one object per month of each table."""
    root = scratch_dir(spark, "landing")
    for table in tables:
        _land(_trips(spark, sf_dir, table), root, f"{table}_trips")
    return root


def _before(trips: DataFrame, year: int) -> Column:
    return F.year("tpep_pickup_datetime") < year


def _drifting(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Months of lineitem in three schemas: other types of passenger_count, one column more or renamed."""
    trips = _trips(spark, sf_dir, "lineitem")
    early, late = _before(trips, 1997), ~_before(trips, 2000)
    count = F.col("passenger_count")
    return [
        trips.filter(early).withColumn("passenger_count", count.cast("int")),
        trips.filter(~early & ~late).withColumns({"passenger_count": count.cast("bigint"), "Airport_fee": F.lit(1.5)}),
        trips.filter(late).withColumns({"passenger_count": count + 0.25, "airport_fee": F.lit(2.5)}),
    ]


def _land_drifting(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "landing")
    for part in _drifting(spark, sf_dir):
        _land(part, root, "lineitem_trips")
    return root


def _drift_sums(rows: DataFrame) -> DataFrame:
    """What must be the same however the months' types came together."""
    return rows.groupBy("source_date").agg(
        F.count("*").alias("n_trips"),
        round_half_up(F.sum("passenger_count").cast("double")).alias("passengers"),
        F.sum("airport_fee").alias("airport_fees"),
        round_half_up(F.sum("total_amount")).alias("amount"),
    )


def schema_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.schema_report(spark, _land_drifting(spark, sf_dir))


def drift_safe_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform.conform(
        readers.read_landed(spark, _land_drifting(spark, sf_dir), targets={"passenger_count": "int"}), RUN_DATE
    )
    return rows.groupBy("source_date").agg(
        F.count("*").alias("n_trips"),
        F.sum("passenger_count").alias("passengers"),
        F.sum("airport_fee").alias("airport_fees"),
    )


def conform_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "orders")), RUN_DATE)
    name = names.object_name(names.object_path(F.col("data_source")))
    return rows.select(
        "trip_id",
        wall_clock(rows, "tpep_pickup_datetime").alias("pickup"),
        F.col("ingestion_date").cast("string").alias("ingestion_date"),
        name.alias("file_name"),
        names.dataset(name).alias("dataset"),
        "source_date",
    )


def target_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.manifest(spark, _landed(spark, sf_dir, "orders", "lineitem"))
    return landed.select(
        "file_name", "dataset", "source_date", names.target_path("zone/production", F.col("file_name")).alias("target")
    )


def tolerant_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "lineitem")), RUN_DATE)
    common = conform.production_rows(staging)
    return common.withColumns(
        {
            "tpep_pickup_datetime": wall_clock(common, "tpep_pickup_datetime"),
            "ingestion_date": F.col("ingestion_date").cast("string"),
            "data_source": names.object_name(names.object_path(F.col("data_source"))),
        }
    )


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed(spark, sf_dir, "orders", "lineitem")
    profiles = [
        conform.profile(conform.conform(readers.read_landed(spark, root, dataset), RUN_DATE))
        for dataset in ("orders_trips", "lineitem_trips")
    ]
    return reduce(DataFrame.unionByName, profiles)


def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.read_landed(spark, _landed(spark, sf_dir, "orders", "lineitem"))
    return conform.distinct_sources(rows).select("file_name")


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return conform.preview(trips, ["o_totalprice", "o_orderkey"])


def landed_file_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.manifest(spark, _landed(spark, sf_dir, "orders"))
    trips = _trips(spark, sf_dir, "lineitem")
    wanted = trips.select(F.regexp_replace(_object_name(trips, "orders_trips"), "\\.parquet$", "").alias("file_name"))
    found = landing.resolve(wanted.distinct(), landed)
    return found.select("file_name", names.object_name(F.col("path")).alias("found"))


def files_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.manifest(spark, _landed(spark, sf_dir, "orders"))
    trips = _trips(spark, sf_dir, "lineitem")
    offered = trips.select(F.concat(F.lit("files/"), _object_name(trips, "orders_trips")).alias("href")).distinct()
    return landing.files_to_fetch(landing.wanted_files(offered), landed)


def run_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    day = month_start(orders, "o_orderdate")
    categories = orders.select(F.col("o_orderpriority").alias("category")).distinct()
    first, last = orders.agg(F.min(day)).scalar(), orders.agg(F.max(day)).scalar()
    return landing.run_grid(categories, first, last)


# Zones and tables


def _by_month(rows: DataFrame) -> DataFrame:
    pickup = wall_clock(rows, "tpep_pickup_datetime")
    return rows.groupBy("source_date").agg(
        F.count("*").alias("n_trips"),
        F.sum("trip_id").alias("id_sum"),
        F.sum("VendorID").cast("bigint").alias("vendor_sum"),
        F.min(pickup).cast("string").alias("first_pickup"),
        F.max(pickup).cast("string").alias("last_pickup"),
        F.sum(F.datediff(pickup, F.lit("1990-01-01"))).cast("bigint").alias("pickup_days"),
        round_half_up(F.sum("total_amount")).alias("amount"),
    )


def _stage(spark: SparkSession, root: str, path: str, dataset: str = "orders_trips", keep: Column | None = None) -> None:
    rows = conform.conform(readers.read_landed(spark, root, dataset), RUN_DATE)
    sinks.write_partitions(rows if keep is None else rows.filter(keep), path, ["source_date"])


def staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of different months: the second leaves the first as it is."""
    root, staging = _landed(spark, sf_dir, "orders"), scratch_dir(spark, "staging")
    _stage(spark, root, staging, keep=F.col("source_date") < "1998-01")
    _stage(spark, root, staging, keep=F.col("source_date") >= "1998-01")
    return _by_month(readers.read_zone(spark, staging))


def staging_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, staging = _landed(spark, sf_dir, "orders"), scratch_dir(spark, "staging")
    _stage(spark, root, staging)
    _stage(spark, root, staging)
    return _by_month(readers.read_zone(spark, staging))


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "orders")), RUN_DATE)
    target = scratch_dir(spark, "appended")
    sinks.append_rows(rows, target)
    sinks.append_rows(rows, target)
    return _by_month(readers.scan(spark, target))


def _database(spark: SparkSession) -> tuple[str, str]:
    place = scratch_dir(spark, "database")
    name = "tripmart_" + place.rsplit("-", 1)[1]
    catalog.create_database(spark, name, place)
    return name, place


def _published(spark: SparkSession, sf_dir: str, runs: int, append: bool = False) -> DataFrame:
    database, place = _database(spark)
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "orders")), RUN_DATE)
    table = f"{database}.orders_trips"
    for _ in range(runs):
        catalog.publish(spark, rows, table, f"{place}/tables/orders_trips", append=append)
    return _by_month(spark.table(table))


def publish_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, runs=1)


def publish_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, runs=2)


def publish_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early months with one column less: the table gains it with the later months."""
    database, place = _database(spark)
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "orders")), RUN_DATE)
    early = F.col("source_date") < "1998-01"
    for part in (rows.filter(early).drop("priority"), rows.filter(~early)):
        catalog.publish(spark, part, f"{database}.orders_trips", f"{place}/tables/orders_trips")
    table = spark.table(f"{database}.orders_trips")
    return table.groupBy("source_date", "priority").agg(F.count("*").alias("n_trips"))


def publish_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, runs=2, append=True)


def _load(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    landed, root = _landed(spark, sf_dir, *tables), scratch_dir(spark, "zones")
    for table in tables:
        etl.load_zones(
            spark, landed, f"{root}/staging", f"{root}/production", f"{table}_trips",
            columns=["trip_id", "VendorID", "tpep_pickup_datetime", "passenger_count", "total_amount", "source_date"],
            run_date=RUN_DATE,
        )
    return root


def register_landed_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = _database(spark)
    tables = catalog.register_zone(spark, database, f"{_load(spark, sf_dir, 'orders', 'lineitem')}/staging")
    counted = [_by_month(spark.table(f"{database}.{t}")).withColumn("table_name", F.lit(t)) for t in tables]
    return reduce(DataFrame.unionByName, counted)


def publish_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _load(spark, sf_dir, "orders", "lineitem")
    staging_db, _ = _database(spark)
    target_db, place = _database(spark)
    catalog.register_zone(spark, staging_db, f"{root}/staging")
    tables = catalog.publish_all(spark, staging_db, target_db, f"{root}/production", f"{place}/tables")
    counted = [_by_month(spark.table(t)).withColumn("table_name", F.lit(t.split(".")[1])) for t in tables]
    return reduce(DataFrame.unionByName, counted)


def publish_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early months in whole numbers, later ones with fractions: the table's types widen, and no amount is cut."""
    database, place = _database(spark)
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "lineitem")), RUN_DATE)
    table, early = f"{database}.lineitem_trips", F.col("source_date") < "1998-01"
    whole = {"total_amount": F.col("total_amount").cast("int"), "passenger_count": F.col("passenger_count").cast("bigint")}
    for part in (rows.filter(early).withColumns(whole), rows.filter(~early)):
        catalog.publish(spark, part, table, f"{place}/tables/lineitem_trips")
    return spark.table(table).groupBy("source_date").agg(
        F.count("*").alias("n_trips"),
        round_half_up(F.sum("passenger_count")).alias("passengers"),
        round_half_up(F.sum("total_amount")).alias("amount"),
    )


def publish_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads with ever wider types: whole numbers, longer ones, fractions. The catalog's types change, no file does."""
    database, place = _database(spark)
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "lineitem")), RUN_DATE)
    table, month = f"{database}.lineitem_trips", F.col("source_date")
    steps = [
        (month < "1996-01", {"total_amount": "int", "passenger_count": "int"}),
        ((month >= "1996-01") & (month < "1998-01"), {"total_amount": "int", "passenger_count": "bigint"}),
        (month >= "1998-01", {"total_amount": "double", "passenger_count": "bigint"}),
    ]
    for months, types in steps:
        part = rows.filter(months).withColumns({c: F.col(c).cast(t) for c, t in types.items()})
        catalog.publish(spark, part, table, f"{place}/tables/lineitem_trips")
    return spark.table(table).groupBy("source_date").agg(
        F.count("*").alias("n_trips"),
        F.sum("passenger_count").alias("passengers"),
        round_half_up(F.sum("total_amount")).alias("amount"),
    )


def publish_gains_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables created without months: later, dated loads partition them, by none or a derived month, and replace months.

    The first rows stay, in no month or in the one of their pickup; half of the later ones come in a first load, and all in a second.
    """
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "orders")), RUN_DATE)
    early, found = F.col("source_date") < "1998-01", []
    for name, derived in (("no month", None), ("derived month", month_label(month_start(rows, "tpep_pickup_datetime")))):
        database, place = _database(spark)
        table, location = f"{database}.orders_trips", f"{place}/tables/orders_trips"
        catalog.publish(spark, rows.filter(early).drop("source_date"), table, location)
        for part in (rows.filter(~early & (F.col("trip_id") % 2 == 0)), rows.filter(~early)):
            catalog.publish(spark, part, table, location, undated_month=derived)
        counted = spark.table(table).groupBy("source_date").agg(F.count("*").alias("n_trips"), F.sum("trip_id").alias("id_sum"))
        found.append(counted.select(F.lit(name).alias("undated"), "source_date", "n_trips", "id_sum"))
    return found[0].unionByName(found[1])


def files_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kept listing against the landing zone after some months were corrected, some added and one taken away."""
    trips, root, kept = _trips(spark, sf_dir, "orders"), scratch_dir(spark, "landing"), scratch_dir(spark, "kept")
    year = F.year("tpep_pickup_datetime")
    _land(trips.filter(year < 2000), root, "orders_trips")
    landing.keep_listing(landing.listing(spark, root), kept)
    _land(trips.filter((year == 1997) & (F.col("trip_id") % 2 == 0)), root, "orders_trips")
    _land(trips.filter(year >= 2000), root, "orders_trips")
    delete_folder(spark, f"{root}/orders_trips/object=orders_trips_1996-03.parquet")
    found = landing.changes(landing.listing(spark, root), spark.read.parquet(kept))
    return found.select("dataset", "file_name", "source_date", "change")


def republished_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by a kept listing: the second finds the months of a corrected year and loads them alone."""
    database, place = _database(spark)
    trips, root = _trips(spark, sf_dir, "orders"), scratch_dir(spark, "landing")
    corrected = F.year("tpep_pickup_datetime") == 1997
    columns = ["trip_id", "VendorID", "tpep_pickup_datetime", "passenger_count", "total_amount", "source_date"]
    for part in (trips, trips.filter(corrected & (F.col("trip_id") % 2 == 0))):
        _land(part, root, "orders_trips")
        etl.run_changes(spark, root, place, database, f"{place}/listing", columns=columns, run_date=RUN_DATE)
    return _by_month(spark.table(f"{database}.orders_trips"))


def column_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls of every column of the drifting months, by their footers, without a scan."""
    found = readers.column_profile(spark, _land_drifting(spark, sf_dir))
    return found.select("dataset", "source_date", "column_name", "type", "n_rows", "n_nulls")


def _run_by_run(spark: SparkSession, sf_dir: str, load: Callable[[str], object]) -> None:
    """Each schema of the drifting months landed and loaded in a run of its own."""
    for part in _drifting(spark, sf_dir):
        landed = scratch_dir(spark, "landing")
        _land(part, landed, "lineitem_trips")
        load(landed)


def register_drifting_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging zone that three runs of differing schemas wrote, as a table."""
    root, (database, _) = scratch_dir(spark, "zones"), _database(spark)

    def load(landed: str) -> None:
        etl.load_zones(spark, landed, f"{root}/staging", f"{root}/production", "lineitem_trips", integers=[], run_date=RUN_DATE)
        catalog.register_zone(spark, database, f"{root}/staging")

    _run_by_run(spark, sf_dir, load)
    return _drift_sums(spark.table(f"{database}.lineitem_trips"))


def publish_all_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production months that were written in three schemas, published in one go."""
    root, (staging_db, _), (target_db, place) = scratch_dir(spark, "zones"), _database(spark), _database(spark)
    for part in _drifting(spark, sf_dir):
        label = month_label(month_start(part, "tpep_pickup_datetime"))
        dated = part.withColumns({"source_date": label, "period": F.replace(label, F.lit("-"), F.lit("_"))})
        sinks.write_partitions(dated, f"{root}/production/lineitem_trips_parquet", ["period"], rebalance=True)
    spark.sql(f"CREATE TABLE {staging_db}.lineitem_trips (trip_id bigint) USING parquet")
    (table,) = catalog.publish_all(spark, staging_db, target_db, f"{root}/production", f"{place}/tables")
    return _drift_sums(spark.table(table))


def etl_month_by_month_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three whole runs into the same zones and table, each with another schema."""
    database, place = _database(spark)
    columns = ["trip_id", "VendorID", "tpep_pickup_datetime", "passenger_count", "total_amount", "airport_fee", "source_date"]

    def load(landed: str) -> None:
        etl.run_etl(
            spark, landed, place, database, ["lineitem_trips"], columns=columns, integers=[], run_date=RUN_DATE, ignore_case=True
        )

    _run_by_run(spark, sf_dir, load)
    return _drift_sums(spark.table(f"{database}.lineitem_trips"))


def _link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per table with a link to the file of each month, as a site would offer them."""
    pages = []
    for number, table in enumerate(("orders", "lineitem")):
        trips = _trips(spark, sf_dir, table)
        link = F.concat(F.lit('<a href="files/'), _object_name(trips, f"{table}_trips"), F.lit(f'">{table} trip records</a>'))
        links_of = trips.select(link.alias("link")).distinct()
        html = F.array_join(F.sort_array(F.collect_list("link")), " ")
        pages.append(links_of.agg(F.lit(number).cast("bigint").alias("page_id"), html.alias("html")))
    return pages[0].unionByName(pages[1])


def _run_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """All months that the two tables have; a list of names."""
    months = [_trips(spark, sf_dir, table).select(month_label(F.trunc("tpep_pickup_datetime", "MM")).alias("month")) for table in ("orders", "lineitem")]
    return [row.month for row in months[0].union(months[1]).distinct().orderBy("month").toLocalIterator()]


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, landed files, zones, registered staging and published tables in one job, for all months."""
    landed, root = _landed(spark, sf_dir, "orders", "lineitem"), scratch_dir(spark, "run")
    staging_db, target_db = (f"tripmart_{root.rsplit('-', 1)[1]}_{part}" for part in ("staging", "target"))
    run = etl.run_all(
        spark, _link_pages(spark, sf_dir), ["page_id"], landed, root, staging_db, target_db,
        ["Orders Trip Records", "Lineitem Trip Records"], _run_months(spark, sf_dir), run_date=RUN_DATE,
        columns=["trip_id", "VendorID", "tpep_pickup_datetime", "passenger_count", "total_amount", "source_date"],
    )
    counted = [_by_month(spark.table(t)).withColumn("table_name", F.lit(t.split(".")[1])) for t in run.tables]
    return reduce(DataFrame.unionByName, counted)


def _fetch_plan(spark: SparkSession, sf_dir: str) -> etl.FetchPlan:
    """The months of both tables are offered, those of orders have landed."""
    landed = landing.manifest(spark, _landed(spark, sf_dir, "orders"))
    categories = ["Orders Trip Records", "Lineitem Trip Records", "No Such Records"]
    return etl.plan_fetch(_link_pages(spark, sf_dir), ["page_id"], landed, categories, _run_months(spark, sf_dir))


def plan_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetch_plan(spark, sf_dir).to_fetch.select("dataset", "file_name", "href")


def plan_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetch_plan(spark, sf_dir).missing


def monthly_sql_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report as SQL over a published table of instants."""
    database, place = _database(spark)
    rows = conform.conform(readers.read_landed(spark, _landed(spark, sf_dir, "lineitem")), RUN_DATE)
    catalog.publish(spark, conform.production_rows(rows), f"{database}.lineitem_trips", f"{place}/tables/lineitem_trips")
    return reports.run_monthly_sql(spark, f"{database}.lineitem_trips", scratch_dir(spark, "reports"))


def etl_monthly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed files with drifting schemas through all zones to the report on the published table."""
    database, place = _database(spark)
    etl.run_etl(spark, _land_drifting(spark, sf_dir), place, database, ["lineitem_trips"], run_date=RUN_DATE)
    return reports.monthly_average_report(spark, f"{database}.lineitem_trips")


def etl_hourly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship on two catalog tables."""
    database, place = _database(spark)
    events = _events(spark, sf_dir)
    for name, rows in (("yellow", events), ("green", _second_fleet(events))):
        dated = rows.withColumn("source_date", month_label(month_start(rows, "ts")))
        catalog.publish(spark, dated, f"{database}.{name}", f"{place}/tables/{name}")
    return reports.hourly_average_report(spark, f"{database}.yellow", f"{database}.green", HOURLY_MONTH, EVENTS, EVENTS)


def report_as_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.as_strings(monthly_trend(spark, sf_dir))


def report_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly report as SQL over catalog tables, its result kept in a folder."""
    database, place = _database(spark)
    events = _events(spark, sf_dir).select(
        F.col("event_type").alias("vendorid"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("passengers").alias("passenger_count"),
    )
    green = events.filter(F.col("vendorid").isin("view", "click"))
    catalog.publish(spark, events, f"{database}.yellow", f"{place}/tables/yellow")
    catalog.publish(spark, green, f"{database}.green", f"{place}/tables/green")
    return reports.run_hourly_sql(
        spark, f"{database}.yellow", f"{database}.green", HOURLY_MONTH, scratch_dir(spark, "reports")
    )


# Link pages


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.page_links(_table(spark, sf_dir, "pages"), ["page_id"])


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir)


def category_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.category_links(_links(spark, sf_dir), CATEGORIES, PERIODS)


def category_links_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.category_links(_links(spark, sf_dir), CATEGORIES, PERIODS, exact=True)


def first_category_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.first_links(category_links(spark, sf_dir), ["page_id"])


def missing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return links.missing_links(pages, first_category_link(spark, sf_dir), ["page_id"], CATEGORIES, PERIODS)


def missing_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.missing_categories(_table(spark, sf_dir, "pages"), CATEGORIES)


def missing_categories_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.missing_by_page(_table(spark, sf_dir, "pages"), ["page_id"], CATEGORIES)


# Incremental runs


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: early months, the rest, and nothing new."""
    landed, target = scratch_dir(spark, "landing"), scratch_dir(spark, "incremental")
    trips = _trips(spark, sf_dir, "orders")
    early = _before(trips, 1998)
    for part in (trips.filter(early), trips.filter(~early), None):
        if part is not None:
            _land(part, landed, "orders_trips")
        incremental.stream_uniform(spark, landed, target, trips.schema, RUN_DATE)
    return _by_month(incremental.read_loaded(spark, target))


def incremental_load_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over files of three schemas; the second finds nothing new."""
    landed, target = _land_drifting(spark, sf_dir), scratch_dir(spark, "incremental")
    for _ in range(2):
        incremental.stream_drifting(spark, landed, target, {"passenger_count": "int"}, RUN_DATE, files_per_batch=50)
    return _drift_sums(incremental.read_loaded(spark, target))


def incremental_runs_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: the second adds a column, and the second and third widen another."""
    landed, target = scratch_dir(spark, "landing"), scratch_dir(spark, "incremental")
    for part in _drifting(spark, sf_dir):
        _land(part, landed, "lineitem_trips")
        incremental.stream_drifting(spark, landed, target, run_date=RUN_DATE)
    return _drift_sums(incremental.read_loaded(spark, target))


QUERIES = [
    hourly_avg_passengers_with_vendor_baseline,
    trips_with_vendor_baseline,
    vendor_avg_passengers,
    monthly_avg_passengers,
    monthly_avg_amount,
    month_filter_rows,
    hour_of_day_avg_fleet,
    peak_low_hours,
    monthly_trend,
    amount_distribution,
    amount_quantiles_by_cutting,
    amount_histogram,
    amount_outliers,
    quality_rule_counts,
    schema_drift_report,
    drift_safe_read,
    conform_audit_columns,
    target_paths,
    tolerant_projection,
    dataset_profile,
    distinct_sources,
    preview_rows,
    landed_file_lookup,
    files_to_fetch,
    run_grid,
    staging_roundtrip,
    staging_rerun,
    append_roundtrip,
    publish_create,
    publish_rerun,
    publish_append,
    publish_evolving,
    publish_widening,
    publish_promoted,
    publish_gains_partition,
    files_republished,
    republished_reload,
    column_footers,
    register_drifting_zone,
    publish_all_drifting,
    etl_month_by_month_drifting,
    whole_run,
    plan_to_fetch,
    plan_missing,
    monthly_sql_report,
    approximate_quantiles,
    register_landed_dir,
    publish_all_tables,
    etl_monthly_report,
    etl_hourly_report,
    report_as_strings,
    report_persisted,
    page_links,
    category_links,
    category_links_exact,
    first_category_link,
    missing_links,
    missing_categories,
    missing_categories_by_page,
    incremental_load,
    incremental_load_drifting,
    incremental_runs_drifting,
]


def entry(spark: SparkSession) -> DataFrame:
    """The flagship on the smallest tables."""
    return hourly_avg_passengers_with_vendor_baseline(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {query.__name__: query for query in QUERIES}
    return own | llm.queries() | {"pipeline": corpus_pipeline.run} if llm else own


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLES

    return ORACLES | llm.ORACLES if llm else ORACLES
