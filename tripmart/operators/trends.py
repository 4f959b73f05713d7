"""Peak hours and the monthly trend.

The windows here have no partition key. They run over aggregates with one row per hour of day or
per month, never over trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.numeric import round_half_up
from tripmart.functions.time import month_label, month_start, wall_clock


def peak_and_low_hours(trips: DataFrame, pickup: str) -> DataFrame:
    """Trips per hour of day, ranked from the busiest and from the quietest; equal hours share a rank."""
    counts = trips.groupBy(F.hour(wall_clock(trips, pickup)).alias("hour")).agg(F.count("*").alias("n_trips"))
    return counts.select(
        "hour",
        "n_trips",
        F.rank().over(Window.orderBy(F.desc("n_trips"))).alias("peak_rank"),
        F.rank().over(Window.orderBy(F.asc("n_trips"))).alias("low_rank"),
    ).orderBy("hour")


def monthly_trend(trips: DataFrame, pickup: str, value: Column, name: str) -> DataFrame:
    """Monthly average beside the average of the month before it and the change."""
    monthly = trips.groupBy(month_start(trips, pickup).alias("first_day")).agg(
        F.count("*").alias("n_trips"), F.avg(value).alias("mean")
    )
    before = F.lag("mean").over(Window.orderBy("first_day"))
    return (
        monthly.withColumn("before", before)
        .select(
            month_label(F.col("first_day")).alias("month"),
            "n_trips",
            round_half_up(F.col("mean")).alias(name),
            round_half_up(F.col("before")).alias(f"previous_{name}"),
            round_half_up(F.col("mean") - F.col("before")).alias("change"),
        )
        .orderBy("month")
    )
