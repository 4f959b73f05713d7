"""Wall-clock time, independent of the session time zone.

A trip's pickup is a wall-clock value. It is stored either as TIMESTAMP_NTZ or, once conformed, as
the instant which shows that wall clock in UTC. Everything here reads the wall clock directly; an
implicit cast would go through the session zone, and move times that fall in a DST gap.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT")
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.select(name).schema[0].dataType


def wall_clock_sql(df: DataFrame, name: str) -> str:
    """The column as TIMESTAMP_NTZ, as SQL text."""
    if isinstance(_type(df, name), T.TimestampType):
        return f"timestampadd(MICROSECOND, unix_micros(`{name}`), {EPOCH})"
    return f"CAST(`{name}` AS TIMESTAMP_NTZ)"


def wall_clock(df: DataFrame, name: str) -> Column:
    """The column as TIMESTAMP_NTZ."""
    return F.expr(wall_clock_sql(df, name))


def utc_instant(df: DataFrame, name: str) -> Column:
    """A TIMESTAMP_NTZ column as the instant with the same wall clock in UTC."""
    ts = F.col(name)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return ts.cast("timestamp")
    return F.make_timestamp(
        F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts),
        F.date_part(F.lit("SECOND"), ts), F.lit("UTC"),
    )


def month_start(df: DataFrame, name: str) -> Column:
    """First day of the month as DATE: a 4-byte grouping key, formatted after the aggregation."""
    return F.trunc(F.to_date(wall_clock(df, name)), "MM")


def month_label(first_day: Column) -> Column:
    return F.date_format(first_day, "yyyy-MM")


def hour_label(day: Column, hour: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"))


def month_bounds(month: str) -> tuple[date, date]:
    first = date.fromisoformat(f"{month}-01")
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first, following


def in_month(df: DataFrame, name: str, month: str) -> Column:
    """Rows of one ``yyyy-MM``, as a half-open range on the bare column.

    The same rows as comparing the formatted month, but the range reaches the parquet reader, which
    skips row groups by it.
    """
    first, following = month_bounds(month)
    if isinstance(_type(df, name), T.TimestampType):
        return F.expr(f"`{name}` >= TIMESTAMP'{first} 00:00:00Z' AND `{name}` < TIMESTAMP'{following} 00:00:00Z'")
    return F.expr(
        f"`{name}` >= TIMESTAMP_NTZ'{first} 00:00:00' AND `{name}` < TIMESTAMP_NTZ'{following} 00:00:00'"
    )
