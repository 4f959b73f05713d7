"""One type per column for tables and zones that several runs write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.time import utc_instant

EXACT_IN_DOUBLE = 2**53
TIMES = (T.TimestampType, T.TimestampNTZType)


class SchemaConflictError(ValueError):
    """Two runs bring types of a column that no type can hold without loss."""


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, None where there is none."""
    if a == b:
        return a
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for one, other in ((a, b), (b, a)):
        if isinstance(one, whole) and isinstance(other, whole) and whole.index(type(one)) <= whole.index(type(other)):
            return other
        if isinstance(one, (*whole, T.FloatType)) and isinstance(other, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(one, whole) and isinstance(other, T.DecimalType):
            digits = max((3, 5, 10, 19)[whole.index(type(one))], other.precision - other.scale)
            return T.DecimalType(min(digits + other.scale, 38), other.scale) if digits + other.scale <= 38 else None
    if isinstance(a, TIMES) and isinstance(b, TIMES):
        return T.TimestampType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return None


def resolved(known: T.StructType, new: T.StructType, what: str) -> dict[str, T.DataType]:
    """Type of each column of both schemas, by lower-case name; raises where two types have none in common."""
    types = {f.name.lower(): f.dataType for f in known}
    for field in new:
        name = field.name.lower()
        found = common_type(types.get(name, field.dataType), field.dataType)
        if found is None:
            raise SchemaConflictError(
                f"column {field.name} of {what} is {types[name].simpleString()} and cannot take {field.dataType.simpleString()}"
            )
        types[name] = found
    return types


def widened(rows: DataFrame, types: dict[str, T.DataType], what: str) -> DataFrame:
    """``rows`` cast to the types, columns without one as they are; raises if a value would change.

    Wall clock times become instants as the readers make them so.
    """
    changed = {f.name: (f.dataType, types[f.name.lower()]) for f in rows.schema if types.get(f.name.lower(), f.dataType) != f.dataType}
    large = [
        ~F.col(name).between(-EXACT_IN_DOUBLE, EXACT_IN_DOUBLE)
        for name, (old, new) in changed.items()
        if isinstance(old, T.LongType) and isinstance(new, T.DoubleType)
    ]
    if large and not rows.filter(reduce(Column.__or__, [F.coalesce(one, F.lit(False)) for one in large])).isEmpty():
        raise SchemaConflictError(f"a whole number of {what} is too large for a double")
    casts = {
        name: utc_instant(rows, name) if isinstance(old, T.TimestampNTZType) and isinstance(new, T.TimestampType) else F.col(name).cast(new)
        for name, (old, new) in changed.items()
    }
    return rows.withColumns(casts) if casts else rows
