"""Cleaning: full-row deduplication and type-driven null filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position
from strata.operators import lookup
from strata.session import scratch_path

# Column types whose nulls are filled, and with what.
FILL_STRING = "unknown"
FILL_NUMBER = 0
_NUMBERS = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_FLOATS = (T.FloatType, T.DoubleType)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one row of each set of equal rows; null equals null and NaN equals NaN.

    Copies collapse before the shuffle, so a row with very many copies costs no
    more than one row per task.
    """
    _check_groupable(df)
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows as ``c0, c1, …`` with the number of their ``copies``.

    Same plan as :func:`dedupe` plus one long per row. It lets the stage that
    writes the result also report how many rows went in.
    """
    _check_groupable(df)
    frame = by_position(df)
    return frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("copies"))


def count_copies_screened(df: DataFrame) -> DataFrame:
    """:func:`count_copies` for large inputs in which few different rows repeat.

    A first pass shuffles row hashes only and keeps those seen more than once. If
    they fit a broadcast, rows with any other hash are known to be single and stay
    where they are, in the order and clustering of the source; only the rest is
    compared in full. Unequal rows that share a hash are told apart there.
    """
    _check_groupable(df)
    spark = df.sparkSession
    keyed = by_position(df).withColumn("hash", F.xxhash64(*[f"c{i}" for i in range(len(df.columns))]))
    path = scratch_path(spark, "repeated")
    counts = keyed.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    counts.where(F.col("n") > 1).select("hash").write.parquet(path)
    repeated = spark.read.parquet(path)
    if not lookup.fits_broadcast(repeated):
        return count_copies(df)
    repeated = F.broadcast(repeated)
    single = keyed.join(repeated, "hash", "left_anti").drop("hash").withColumn("copies", F.lit(1).cast("bigint"))
    others = keyed.join(repeated, "hash", "left_semi").drop("hash")
    return single.unionByName(others.groupBy(*others.columns).agg(F.count(F.lit(1)).alias("copies")))


def dedupe_stats(df: DataFrame) -> DataFrame:
    """One row: ``rows_before``, ``rows_after``, ``duplicates_removed``."""
    before = F.coalesce(F.sum("copies"), F.lit(0))
    after = F.count(F.lit(1))
    return count_copies(df).agg(
        before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("duplicates_removed")
    )


def is_filled(dtype: T.DataType) -> bool:
    """Whether :func:`fill_nulls` fills columns of this type."""
    return isinstance(dtype, (T.StringType, *_NUMBERS)) and dtype.simpleString() in (
        "string",
        "int",
        "bigint",
        "float",
        "double",
    )


def is_gap(value: Column, dtype: T.DataType) -> Column:
    """Whether :func:`fill_nulls` replaces a value of a filled type."""
    return value.isNull() | F.isnan(value) if isinstance(dtype, _FLOATS) else value.isNull()


def filled(value: Column, dtype: T.DataType, string: str = FILL_STRING, number=FILL_NUMBER) -> Column:
    """Fill one column by its type: text, int, bigint, float and double only; NaN counts as null."""
    if not is_filled(dtype):
        return value
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit(string))
    if isinstance(dtype, _FLOATS):
        value = F.nanvl(value, F.lit(None).cast(dtype))
    return F.coalesce(value, F.lit(number).cast(dtype))


def fill_nulls(df: DataFrame, string: str = FILL_STRING, number=FILL_NUMBER) -> DataFrame:
    """Fill the nulls of every column whose type is filled; other columns pass unchanged."""
    values = [
        filled(F.col(f"c{i}"), field.dataType, string, number).alias(f"c{i}") for i, field in enumerate(df.schema)
    ]
    return by_position(df).select(*values).toDF(*df.columns)


def _check_groupable(df: DataFrame) -> None:
    bad = [f.name for f in df.schema if _holds_map(f.dataType)]
    if bad:
        raise ValueError(f"rows with map columns cannot be compared for deduplication: {bad}")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, T.MapType)
