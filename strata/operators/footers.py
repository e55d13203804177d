"""Figures of a stored table from the footers of its files, without reading rows."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import col
from strata.operators import profile
from strata.session import settings
from strata.sources import tables

# Types whose bounds in a footer are exact; those of texts may be cut, and times and decimals are not pushed down.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
# Lets Spark read Parquet by the reader that pushes aggregates to the footers.
_PUSHED = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
_COLUMNS = "part string, column string, n bigint, min string, max string, nulls bigint"


def from_footers(spark: SparkSession, path: str, bounded: list[str], counted: list[str]) -> DataFrame:
    """One row with the number of rows ``n``, bounds ``i_min``, ``i_max`` and values ``i_values``, all from footers.

    The frame is planned already; ``bounded`` columns come first in the numbering ``i``, then ``counted`` ones.
    """
    with settings(spark, _PUSHED):
        df = spark.read.parquet(path)
        figures = [F.count(F.lit(1)).alias("n")]
        for i, name in enumerate([*bounded, *counted]):
            figures.append(F.count(col(name)).alias(f"{i}_values"))
            if name in bounded:
                figures += [F.min(col(name)).cast("string").alias(f"{i}_min"), F.max(col(name)).cast("string").alias(f"{i}_max")]
        found = df.agg(*figures)
        found._jdf.queryExecution().executedPlan()
    return found


def table_profile(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`strata.operators.profile.column_profile` for a whole Parquet table.

    Row counts, null counts of numbers, booleans and dates and the bounds of numbers and dates come from the footers. Only columns of other
    types, and columns that stand for folders, are read for theirs. Where a footer lacks a bound (a column that holds
    NaN, or a file of a writer without figures) the whole table is read.
    """
    df = tables.read_layer(spark, path)
    folders = _folder_columns(spark, path, df)
    bounded = [f.name for f in df.schema if isinstance(f.dataType, BOUNDED) and f.name not in folders]
    # A profile shows no bounds of these, as they have no order there.
    counted = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType) and f.name not in folders]
    rest = [name for name in df.columns if name not in bounded + counted]
    try:
        found = from_footers(spark, path, bounded, counted).first()
    except PySparkException:
        return profile.column_profile(df)
    rows = {}
    for i, name in enumerate(bounded + counted):
        bounds = (found[f"{i}_min"], found[f"{i}_max"]) if name in bounded else (None, None)
        rows[name] = (None, name, found["n"], *bounds, found["n"] - found[f"{i}_values"])
    if rest:
        rows |= {r["column"]: tuple(r) for r in profile.column_profile(df.select(*map(col, rest))).collect()}
    return spark.createDataFrame([rows[name] for name in df.columns], _COLUMNS)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from its footers."""
    return from_footers(spark, path, [], []).first()["n"]


def _folder_columns(spark: SparkSession, path: str, df: DataFrame) -> set[str]:
    relation = df._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    names = relation.partitionSchema().fieldNames()
    return set(names)
