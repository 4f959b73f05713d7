"""The reports on published tables, as SQL with its result kept, and as text rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.time import month_bounds, wall_clock_sql
from tripmart.operators.averages import hourly_average_with_vendor_baseline, monthly_average
from tripmart.roles import YELLOW, TripRoles

# Both queries name the pickup's wall clock {clock}, which the functions below fill in by the column's
# type, so that a table of instants gives the same months and hours in every session zone.
MONTHLY_AVERAGE_SQL = """
SELECT date_format(first_day, 'yyyy-MM') AS month, round(round(mean, 10), 2) AS average_passenger_count
FROM (
    SELECT trunc(to_date({clock}), 'MM') AS first_day, avg(passenger_count) AS mean
    FROM IDENTIFIER(:trips)
    GROUP BY 1
)
ORDER BY 1
"""

# Hourly average with the other fleet's baseline per vendor. The trips are summed per vendor and
# hour before the join, as in the DataFrame operator of that name.
HOURLY_AVERAGE_SQL = """
WITH base AS (
    SELECT vendorid, avg(passenger_count) AS base
    FROM IDENTIFIER(:baseline)
    GROUP BY vendorid
),
sums AS (
    SELECT vendorid, to_date({clock}) AS day, hour({clock}) AS hour,
           sum(passenger_count) AS total, count(passenger_count) AS n
    FROM IDENTIFIER(:trips)
    WHERE tpep_pickup_datetime >= :first AND tpep_pickup_datetime < :following
    GROUP BY ALL
)
SELECT concat(date_format(day, 'yyyy-MM-dd'), ' ', lpad(hour, 2, '0')) AS pickup_hour,
       round(round(try_divide(sum(total + n * base), sum(n) FILTER (WHERE base IS NOT NULL)), 10), 2)
           AS avg_passenger_count
FROM sums LEFT JOIN base USING (vendorid)
GROUP BY ALL
ORDER BY 1
"""


def monthly_average_report(spark: SparkSession, trips: str, roles: TripRoles = YELLOW) -> DataFrame:
    """Average passengers per month of a catalog table."""
    df = spark.table(trips)
    return monthly_average(df, roles.pickup, F.col(roles.passengers), "average_passenger_count")


def hourly_average_report(
    spark: SparkSession, trips: str, baseline: str, month: str, roles: TripRoles = YELLOW, baseline_roles: TripRoles = YELLOW
) -> DataFrame:
    """Average passengers per hour of a month, with the baseline table's vendor averages added."""
    return hourly_average_with_vendor_baseline(spark.table(trips), spark.table(baseline), month, roles, baseline_roles)


def run_sql(spark: SparkSession, query: str, output: str, args: dict | None = None) -> DataFrame:
    """Run a query, keep its result in a folder of its own below ``output``, and return what was kept."""
    return persist(spark.sql(query, args=args or {}), output)


def persist(report: DataFrame, output: str) -> DataFrame:
    path = f"{output.rstrip('/')}/{uuid.uuid4().hex}"
    report.write.parquet(path)
    return report.sparkSession.read.schema(report.schema).parquet(path)


def as_strings(report: DataFrame) -> DataFrame:
    """Every cell as text, NULL kept."""
    return report.select(*[F.col(c).cast("string").alias(c) for c in report.columns])


def as_records(report: DataFrame) -> Iterator[dict[str, str | None]]:
    """The report as text records, one per row, fetched partition by partition.

    For reports, which are aggregates; the caller decides how many records to take.
    """
    for row in as_strings(report).toLocalIterator():
        yield row.asDict()


def _pickup(spark: SparkSession, table: str) -> tuple[str, str]:
    """Type of a table's pickup column, and the SQL of its wall clock."""
    rows = spark.table(table)
    return rows.schema["tpep_pickup_datetime"].dataType.simpleString(), wall_clock_sql(rows, "tpep_pickup_datetime")


def run_monthly_sql(spark: SparkSession, trips: str, output: str) -> DataFrame:
    """MONTHLY_AVERAGE_SQL over a catalog table, its result kept below ``output``."""
    return run_sql(spark, MONTHLY_AVERAGE_SQL.format(clock=_pickup(spark, trips)[1]), output, {"trips": trips})


def run_hourly_sql(spark: SparkSession, trips: str, baseline: str, month: str, output: str) -> DataFrame:
    """HOURLY_AVERAGE_SQL over two catalog tables, its result kept below ``output``."""
    kind, clock = _pickup(spark, trips)
    zone = "" if kind == "timestamp_ntz" else "Z"
    first, following = (F.expr(f"{kind}'{day} 00:00:00{zone}'") for day in month_bounds(month))
    args = {"trips": trips, "baseline": baseline, "first": first, "following": following}
    return run_sql(spark, HOURLY_AVERAGE_SQL.format(clock=clock), output, args)
