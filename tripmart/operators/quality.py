"""Data-quality rules and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.numeric import round_half_up
from tripmart.functions.time import month_label, month_start, wall_clock
from tripmart.operators.distribution import quantiles
from tripmart.roles import TripRoles
from tripmart.session import materialize


def quality_rule_counts(trips: DataFrame, keys: list[str], roles: TripRoles = TripRoles()) -> DataFrame:
    """Rows that break each rule: rule, n_rows, n_bad, bad_rate.

    One pass over the rows: they are counted per ``keys``, with what they break, which combines equal
    keys before the shuffle. Repeated rows are those beyond the first with the same keys.
    """
    pickup, dropoff = wall_clock(trips, roles.pickup), wall_clock(trips, roles.dropoff)
    row_rules = {
        "null_pickup": pickup.isNull(),
        "null_vendor": F.col(roles.vendor).isNull(),
        "null_passengers": F.col(roles.passengers).isNull(),
        "null_amount": F.col(roles.amount).isNull(),
        "negative_amount": F.col(roles.amount) < 0,
        "dropoff_before_pickup": dropoff < pickup,
    }
    outside = month_label(month_start(trips, roles.pickup)) != F.col("source_date")
    flagged = {**row_rules, "pickup_outside_source_date": outside}
    per_key = trips.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), *[F.count_if(rule).alias(name) for name, rule in flagged.items()]
    )
    names = [*flagged, "repeated_row"]
    totals = per_key.withColumn("repeated_row", F.col("n_rows") - 1).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n_rows", *names)]
    )
    rate = F.round(F.try_divide("n_bad", "n_rows"), 6)
    by_rule = totals.unpivot("n_rows", names, "rule", "n_bad").select("rule", "n_rows", "n_bad")
    return by_rule.withColumn("bad_rate", rate).orderBy("rule")


def outliers(trips: DataFrame, pickup: str, value: str, reach: float = 1.5) -> DataFrame:
    """Trips whose value lies beyond the month's quartiles by more than ``reach`` times their distance.

    Adds month, low_fence and high_fence. The fences have one row per month and are written out, so
    their true size decides how they are joined.
    """
    rows = trips.withColumn("first_day", month_start(trips, pickup))
    quartiles = quantiles(rows.select("first_day", value), "first_day", value, [0.25, 0.75])
    low, high = F.col("q")[0], F.col("q")[1]
    fences = materialize(
        quartiles.select(
            F.col("first_day").alias("fence_month"),
            (low - (high - low) * reach).alias("low_fence"),
            (high + (high - low) * reach).alias("high_fence"),
        ),
        "fences",
    )
    beyond = (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))
    return (
        rows.join(fences, (F.col("first_day") == F.col("fence_month")) & beyond)
        .withColumn("month", month_label(F.col("first_day")))
        .withColumn("low_fence", round_half_up(F.col("low_fence")))
        .withColumn("high_fence", round_half_up(F.col("high_fence")))
        .drop("first_day", "fence_month")
    )
