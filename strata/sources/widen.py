"""Types that hold the values of several types, and unions of frames whose columns differ in type."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = (3, 5, 10, 19)
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_MOST_DIGITS = 38


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text where there is no other.

    Whole numbers widen among themselves, to a decimal beside a decimal and to double beside a real number; decimals
    keep all digits on both sides of the point, or become double beyond 38; dates widen to times. Structs widen field
    by field, arrays and maps by their parts. All else (such as a number beside a text) meets as text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda t: _TIMES.index(type(t)))
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    numbers = (*_WHOLE, *_REAL, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType() if isinstance(a, _REAL) or isinstance(b, _REAL) else _decimal(_exact(a), _exact(b))
    return T.StringType()


def _exact(a: T.DataType) -> T.DecimalType:
    return a if isinstance(a, T.DecimalType) else T.DecimalType(_DIGITS[_WHOLE.index(type(a))], 0)


def _decimal(a: T.DecimalType, b: T.DecimalType) -> T.DataType:
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else T.DoubleType()


def wider_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of both by name (in any case), those of ``a`` first, each with the wider type."""
    rest = {f.name.lower(): f for f in b}
    fields = []
    for field in a:
        other = rest.pop(field.name.lower(), None)
        fields.append(T.StructField(field.name, field.dataType if other is None else wider(field.dataType, other.dataType)))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in rest.values())])


def widened(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A value as the wider type; nested values that become text are written as JSON."""
    if given == wanted:
        return value
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        own = {f.name.lower(): f for f in given}
        parts = []
        for field in wanted:
            mine = own.get(field.name.lower())
            part = F.lit(None).cast(field.dataType) if mine is None else widened(value.getField(mine.name), mine.dataType, field.dataType)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: widened(x, given.elementType, wanted.elementType))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                widened(e["key"], given.keyType, wanted.keyType).alias("key"),
                widened(e["value"], given.valueType, wanted.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(wanted, T.StringType) and isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(wanted)


def as_schema(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """The frame with the columns and types of a wider schema; columns that it lacks are null."""
    own = {f.name.lower(): (F.col(f"c{i}"), f.dataType) for i, f in enumerate(df.schema)}
    picked = []
    for i, field in enumerate(wanted):
        value = F.lit(None).cast(field.dataType)
        if field.name.lower() in own:
            value = widened(*own[field.name.lower()], field.dataType)
        picked.append(value.alias(f"p{i}"))
    return by_position(df).select(*picked).toDF(*wanted.names)


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column has the type that holds the values of all frames (see :func:`wider`)."""
    wanted = reduce(wider_schema, (df.schema for df in frames))
    return reduce(DataFrame.unionAll, (as_schema(df, wanted) for df in frames))


def clashes(frames: Sequence[DataFrame]) -> DataFrame:
    """``(column, types, merged)`` for every column whose type differs among the frames, in column order."""
    wanted = reduce(wider_schema, (df.schema for df in frames))
    seen: dict[str, list[str]] = {}
    for df in frames:
        for field in df.schema:
            kinds = seen.setdefault(field.name.lower(), [])
            if field.dataType.simpleString() not in kinds:
                kinds.append(field.dataType.simpleString())
    rows = [(f.name, seen[f.name.lower()], f.dataType.simpleString()) for f in wanted if len(seen[f.name.lower()]) > 1]
    return frames[0].sparkSession.createDataFrame(rows, "column string, types array<string>, merged string")
