"""Rounding and casting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 2) -> Column:
    """HALF_UP rounding that does not depend on the order in which doubles were summed.

    The last bits of a distributed sum vary with the partitioning. Rounding to ten digits first
    removes them, so that a tie such as 2.675 always goes the same way.
    """
    return F.round(F.round(value, 10), digits)


def to_int(value: Column) -> Column:
    """Truncates toward zero, text such as ``1.0`` too; NULL where the value has no place in an int."""
    return F.coalesce(value.try_cast("int"), value.try_cast("double").try_cast("int"))


def try_cast(value: Column, kind: str) -> Column:
    return to_int(value) if kind in ("int", "integer") else value.try_cast(kind)
