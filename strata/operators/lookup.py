"""Left join against a table with one row per key, safe for large and skewed inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col
from strata.session import scratch_path

# A lookup is broadcast only where it is counted to stay within both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 1_000


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure whether ``df`` stays within the broadcast bounds, by one distributed aggregate."""
    size = sum((_cell_bytes(col(f.name), f.dataType) for f in df.schema), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


def _cell_bytes(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8
    return F.lit(8)


def attach(
    left: DataFrame,
    right: DataFrame,
    on: str,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left outer join where ``right`` has at most one row per ``on``.

    A small ``right`` is broadcast. Beyond the bound ``right`` is written once to the shared scratch folder, as it is
    needed more than once. The ``hot_keys`` most frequent keys of ``left`` and its null keys then stay where they are
    and get their matches by broadcast (at most one row per hot key, counted to stay within the bytes); all other rows
    meet in a shuffle in which no key holds more than ``1 / hot_keys`` of them. Matches too large to broadcast meet
    there as well, where adaptive execution splits a hot key.
    """
    if fits_broadcast(right, max_broadcast_rows):
        return left.join(F.broadcast(right), on, "left")
    spark, path = left.sparkSession, scratch_path(left.sparkSession, "lookup")
    right.write.parquet(path)
    right = spark.read.schema(right.schema).parquet(path)
    hot = (
        left.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .orderBy(F.col("n").desc(), on)
        .limit(hot_keys)
        .select(on, F.lit(True).alias("is_hot"))
    )
    matches = right.join(F.broadcast(hot.select(on)), on, "left_semi")
    if not fits_broadcast(matches, hot_keys):
        return left.join(right, on, "left")
    marked = left.join(F.broadcast(hot), on, "left")
    stay = F.col("is_hot").isNotNull() | F.col(on).isNull()
    here = marked.where(stay).drop("is_hot").join(F.broadcast(matches), on, "left")
    there = marked.where(~stay).drop("is_hot").join(right, on, "left")
    return here.unionByName(there)
