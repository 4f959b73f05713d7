"""Averages by month, vendor and hour.

Every average is a partial and a final aggregation on a key of few values, so a vendor or month
that holds a third of the rows is summed where it is read and leaves each task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.numeric import round_half_up
from tripmart.functions.time import hour_label, in_month, month_label, month_start, wall_clock
from tripmart.roles import TripRoles
from tripmart.session import materialize


def monthly_average(trips: DataFrame, pickup: str, value: Column, name: str) -> DataFrame:
    """Rounded average of a value per pickup month, in order of the month."""
    return (
        trips.groupBy(month_start(trips, pickup).alias("first_day"))
        .agg(F.avg(value).alias("mean"))
        .select(month_label(F.col("first_day")).alias("month"), round_half_up(F.col("mean")).alias(name))
        .orderBy("month")
    )


def vendor_average(trips: DataFrame, vendor: str, value: Column, name: str = "passenger_count") -> DataFrame:
    """Average of a value per vendor, not rounded."""
    return trips.groupBy(F.col(vendor).alias("vendorid")).agg(F.avg(value).alias(name))


def hourly_average_with_vendor_baseline(
    trips: DataFrame,
    baseline: DataFrame,
    month: str,
    roles: TripRoles = TripRoles(),
    baseline_roles: TripRoles = TripRoles(),
) -> DataFrame:
    """Average per date and hour of (passengers + the other fleet's average for the same vendor).

    Trips of a vendor unknown to the other fleet count as NULL and drop out of the average. The
    other fleet is not limited to the month.

    A vendor has one baseline, so the trips are summed per (date, hour, vendor) first, and the join
    sees those sums instead of the trips:
    sum(p + b) over a vendor's trips is sum(p) + count(p) * b.
    """
    passengers = F.col(roles.passengers)
    clock = wall_clock(trips, roles.pickup)
    sums = (
        trips.filter(in_month(trips, roles.pickup, month))
        .groupBy(F.col(roles.vendor).alias("vendorid"), F.to_date(clock).alias("day"), F.hour(clock).alias("hour"))
        .agg(F.sum(passengers).alias("total"), F.count(passengers).alias("n"))
    )
    base = vendor_average(baseline, baseline_roles.vendor, F.col(baseline_roles.passengers), "base")
    known = F.col("base").isNotNull()
    return (
        sums.join(base, "vendorid", "left")
        .groupBy("day", "hour")
        .agg(
            F.sum(F.col("total") + F.col("n") * F.col("base")).alias("total"),
            F.sum(F.when(known, F.col("n"))).alias("n"),
        )
        .select(
            hour_label(F.col("day"), F.col("hour")).alias("pickup_hour"),
            round_half_up(F.try_divide("total", "n")).alias("avg_passenger_count"),
        )
        .orderBy("pickup_hour")
    )


def with_vendor_baseline(
    trips: DataFrame, baseline: DataFrame, roles: TripRoles = TripRoles(), baseline_roles: TripRoles = TripRoles()
) -> DataFrame:
    """Every trip with the other fleet's average for its vendor, and the sum of the two.

    The averages are written out first: their true size decides between a broadcast join and a
    shuffle join, whose skewed vendors AQE splits.
    """
    base = vendor_average(baseline, baseline_roles.vendor, F.col(baseline_roles.passengers), "baseline")
    base = materialize(base.withColumnRenamed("vendorid", "baseline_vendor"), "vendor-baseline")
    return (
        trips.join(base, F.col(roles.vendor) == F.col("baseline_vendor"), "left")
        .drop("baseline_vendor")
        .withColumn("combined", F.col(roles.passengers) + F.col("baseline"))
    )


def fleet(parts: list[tuple[DataFrame, TripRoles]]) -> DataFrame:
    """Trips of several fleets under common names: pickup (wall clock), vendor, passengers, amount.

    A column that a fleet lacks is NULL. Only the named columns are read.
    """

    def common(df: DataFrame, roles: TripRoles) -> DataFrame:
        present = {c.lower() for c in df.columns}
        named = {"vendor": roles.vendor, "passengers": roles.passengers, "amount": roles.amount}
        columns = [F.col(c).alias(name) for name, c in named.items() if c.lower() in present]
        return df.select(wall_clock(df, roles.pickup).alias("pickup"), *columns)

    result = common(*parts[0])
    for part in parts[1:]:
        result = result.unionByName(common(*part), allowMissingColumns=True)
    return result


def hour_of_day_average(trips: DataFrame, month: str) -> DataFrame:
    """Average passengers per hour of day in one month, all trips of a ``fleet`` pooled."""
    return (
        trips.filter(in_month(trips, "pickup", month))
        .groupBy(F.hour("pickup").alias("hour"))
        .agg(F.count("*").alias("n_trips"), F.avg("passengers").alias("mean"))
        .select("hour", "n_trips", round_half_up(F.col("mean")).alias("avg_passenger_count"))
        .orderBy("hour")
    )
